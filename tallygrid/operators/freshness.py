"""Last refresh time of each control, and its lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.spec import RefreshSource

# Lookup sides are broadcast only up to this many rows; beyond it the join is left to the optimizer.
BROADCAST_ROWS = 10_000
SALTS = 16


def refresh_times(spark: SparkSession, mapping: Sequence[RefreshSource], metadata: DataFrame) -> DataFrame:
    """(control, last_refresh_time) from table metadata (dataset_id, table_id, last_modified_time in ms).

    One join serves all controls. Names match case-sensitively. A control whose table is missing from
    the metadata gets no row; one whose table is listed more than once gets the latest time.
    """
    return spark.sql(refresh_select(mapping, "{metadata}", braces=True), metadata=metadata)


def refresh_select(mapping: Sequence[RefreshSource], metadata: str, braces: bool = False) -> str:
    """The query behind ``refresh_times`` and the stored view, over the relation named ``metadata``.

    ``braces``: the text is going to be formatted, so braces inside names are doubled.
    """
    rows = [f"({_quoted(m.control)}, {_quoted(m.dataset_id)}, {_quoted(m.table_id)})" for m in mapping]
    values = ", ".join(rows) or "(CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING))"
    if braces:
        values = values.replace("{", "{{").replace("}", "}}")
    hint = "/*+ BROADCAST(wanted) */ " if len(mapping) <= BROADCAST_ROWS else ""
    return f"""
        SELECT {hint}wanted.control, timestamp_millis(max(tables.last_modified_time)) AS last_refresh_time
        FROM {metadata} AS tables
        JOIN VALUES {values} AS wanted(control, dataset_id, table_id)
        ON tables.dataset_id = wanted.dataset_id AND tables.table_id = wanted.table_id
        GROUP BY wanted.control
        """


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def file_refresh_times(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(control, last_refresh_time) from the newest file under each control's source path.

    Uses the file listing only; column pruning keeps the file contents unread. A path that several
    controls share is listed once. A path without files gives no row.
    """
    sharing: dict[str, list[str]] = {}
    for control, path in paths.items():
        sharing.setdefault(path, []).append(control)
    parts = [
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .agg(F.max("modificationTime").alias("last_refresh_time"))
        .where(F.col("last_refresh_time").isNotNull())
        .select(F.explode(F.array(*[F.lit(control) for control in controls])).alias("control"), "last_refresh_time")
        for path, controls in sharing.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def attach_refresh(rows: DataFrame, refresh: DataFrame, refresh_rows: int | None = None) -> DataFrame:
    """Adds ``last_refresh_time`` by control; NULL where the control has none.

    ``refresh_rows`` is an upper bound on the rows of ``refresh`` where the caller can prove one (the
    number of mapped controls). Only then is that side broadcast. Otherwise the rows of a control, which
    may be nearly all there are, are dealt over ``SALTS`` keys.
    """
    side = refresh.select("control", "last_refresh_time")
    if refresh_rows is not None and refresh_rows <= BROADCAST_ROWS:
        return rows.join(F.broadcast(side), "control", "left")
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(SALTS)))
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
    return dealt.join(side.select("*", copies.alias("_salt")), ["control", "_salt"], "left").drop("_salt")
