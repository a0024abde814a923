"""Columns to rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.spec import Rule


def unpivot_nonnull(df: DataFrame, ids: Sequence[str], columns: Mapping[str, str], name: str, value: str) -> DataFrame:
    """One row per id and non-NULL column value; ``columns`` maps each column to its label.

    Labels are explicit because engines disagree on the letter case of implied ones. NULLs are
    dropped, which ``DataFrame.unpivot`` alone does not do. One pass, no shuffle.
    """
    pairs = [F.struct(F.lit(label).alias(name), F.col(column).alias(value)) for column, label in columns.items()]
    return df.select(*ids, F.inline(F.array(*pairs))).where(F.col(value).isNotNull())


def unpivot_rules(measures: Mapping[str, str], metric_detail: Column) -> list[Rule]:
    """Rules that sum each non-NULL measure column under its label, in one pass over the source."""
    return [
        Rule(label, metric_detail, when=F.col(column).isNotNull(), measure=F.col(column))
        for column, label in measures.items()
    ]
