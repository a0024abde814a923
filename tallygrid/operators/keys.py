"""Key registry: the keys that derived grids take from the whole history, kept and extended from new days only."""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.spec import ControlSpec, KeysOf

#: A row without a metric stands for a detail; one with a metric says that the detail has had a value of it.
KEYS = ("control", "metric_detail", "metric")


def key_rows(source: DataFrame, spec: ControlSpec, after: dt.date | None = None) -> DataFrame:
    """The distinct keys of a control's source, or of its rows after a day.

    Rows without a date have no day to be bounded by and are always read. One scan, and one shuffle of at most one row a
    detail and task.
    """
    keys = _keys_of(spec)
    if after is not None:
        day = F.col(spec.date).cast("date")
        source = source.where((day > F.lit(after)) | F.col(spec.date).isNull())
    gated = {label: column for label, column in keys.metrics.items() if column is not None}
    details = source.select(
        keys.metric_detail.cast("string").alias("metric_detail"), *[c.isNotNull().alias(f"has_{i}") for i, c in enumerate(gated.values())]
    )
    if gated:
        details = details.groupBy("metric_detail").agg(*[F.bool_or(f"has_{i}").alias(f"has_{i}") for i in range(len(gated))])
    else:
        details = details.distinct()
    present = [F.when(F.col(f"has_{i}"), F.lit(label)) for i, label in enumerate(gated)]
    named = F.filter(F.array(*present), lambda label: label.isNotNull()) if gated else F.array().cast("array<string>")
    every = F.concat(F.array(F.lit(None).cast("string")), named)
    return details.select(F.lit(spec.control).alias("control"), "metric_detail", F.explode(every).alias("metric"))


def extended_keys(known: DataFrame | None, source: DataFrame, spec: ControlSpec, after: dt.date | None) -> DataFrame:
    """``known`` keys of the control and those of its source after a day; without known ones, those of the whole history."""
    if known is None or after is None:
        return key_rows(source, spec)
    own = known.where(F.col("control") == spec.control).select(*KEYS)
    return own.unionByName(key_rows(source, spec, after)).distinct()


def grid_of_keys(known: DataFrame, spec: ControlSpec) -> DataFrame:
    """Expected cells (control, metric, metric_detail) from stored keys: every detail with every metric that has had a value."""
    keys = _keys_of(spec)
    own = known.where(F.col("control") == spec.control)
    details = own.where(F.col("metric").isNull()).select("metric_detail").distinct()
    always = [label for label, column in keys.metrics.items() if column is None]
    gated = [label for label in keys.metrics if label not in always]
    labels = F.array(*[F.lit(label) for label in always]).cast("array<string>") if always else F.array().cast("array<string>")
    if gated:
        # At most one name for each metric of the control.
        present = own.where(F.col("metric").isin(*gated)).agg(F.collect_set("metric")).scalar()
        labels = F.concat(labels, present)
    return details.select(F.lit(spec.control).alias("control"), F.explode(labels).alias("metric"), "metric_detail")


def definition(source: DataFrame, spec: ControlSpec) -> str:
    """A name for what the keys mean: it changes with the source, the date column and the key expressions."""
    keys = _keys_of(spec)
    columns = [keys.metric_detail, *[c for c in keys.metrics.values() if c is not None]]
    shown = [spec.source, spec.date, *map(str, columns), *[f"{label}{column is None}" for label, column in keys.metrics.items()]]
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in source.select(*[_text(c, i) for i, c in enumerate(columns)]).schema.fields]
    return hashlib.sha256("\n".join([*shown, *kinds]).encode()).hexdigest()


def _text(column: Column, i: int) -> Column:
    return column.alias(f"key_{i}")


def _keys_of(spec: ControlSpec) -> KeysOf:
    if spec.static:
        raise ValueError(f"{spec.control}: its grid is a fixed list, not taken from its source")
    return spec.grid
