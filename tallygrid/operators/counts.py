"""Counts per expected cell."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.functions.conditions import all_of
from tallygrid.spec import CELL


def grid_counts(scaffold: DataFrame, incidents: DataFrame, sparse: Collection[str] = ()) -> DataFrame:
    """Sum of incident weights per scaffold cell; 0 for quiet cells, no row for those of ``sparse`` controls."""
    counted = _expected_cells(scaffold, incidents)
    if sparse:
        counted = counted.where((F.col("hits") > 0) | ~F.col("control").isin(*sorted(sparse)))
    return counted.select(*CELL, "control_count")


def zero_filled_counts(scaffold: DataFrame, incidents: DataFrame) -> DataFrame:
    """A row for every scaffold cell, 0 where nothing happened."""
    return grid_counts(scaffold, incidents)


def sparse_counts(scaffold: DataFrame, incidents: DataFrame) -> DataFrame:
    """A row only for the scaffold cells that had an incident."""
    return _expected_cells(scaffold, incidents).where("hits > 0").select(*CELL, "control_count")


def _expected_cells(scaffold: DataFrame, incidents: DataFrame) -> DataFrame:
    """Hits and summed weight of every scaffold cell.

    Gives what ``scaffold LEFT JOIN incidents GROUP BY cell`` would, without a join: the scaffold
    rows enter the aggregation with weight 0 and mark their cell as expected, and cells that nothing
    marked are dropped. Neither side is broadcast, so neither has to be small. Map-side partial
    aggregation leaves at most one row per cell and task to shuffle, so a cell that owns a third of
    all incidents is no heavier than any other.

    Grouping would pair NULL keys where a join would not, so incidents with a NULL key are dropped
    first. An expected cell with a NULL detail therefore always counts 0.
    """
    kind = incidents.schema["weight"].dataType
    keyed = all_of(F.col(key).isNotNull() for key in CELL)
    found = incidents.where(keyed).select(*CELL, F.lit(False).alias("expected"), "weight", "hits")
    cells = scaffold.select(
        *CELL, F.lit(True).alias("expected"), F.lit(0).cast(kind).alias("weight"), F.lit(0).cast("bigint").alias("hits")
    )
    return (
        cells.unionByName(found)
        .groupBy(*CELL)
        .agg(
            F.bool_or("expected").alias("expected"),
            F.sum("hits").alias("hits"),
            F.coalesce(F.sum("weight"), F.lit(0)).cast(kind).alias("control_count"),
        )
        .where("expected")
    )
