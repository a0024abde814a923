from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

AS_OF = dt.date(2024, 6, 11)


def day(n: int) -> dt.date:
    """Day ``n`` (1 to 5) of the five days before ``AS_OF``; 0 and 6 lie just outside."""
    return AS_OF - dt.timedelta(days=6 - n)


def at(n: int, hour: int = 12, minute: int = 0) -> dt.datetime:
    return dt.datetime.combine(day(n), dt.time(hour, minute))


def series(df: DataFrame, column: str = "control_count") -> dict[tuple, list]:
    """Values by (metric, metric_detail) in date order."""
    result: dict[tuple, list] = {}
    for row in sorted(df.collect(), key=lambda r: r.control_date):
        result.setdefault((row.metric, row.metric_detail), []).append(row[column])
    return result


def plan_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df: DataFrame) -> str:
    """What a collected frame ran at last, its subqueries included: the plan without the initial ones."""
    kept, skipped = [], None
    for line in plan_text(df).splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        if skipped is not None and indent >= skipped:
            continue
        skipped = None
        if "== Initial Plan ==" in line:
            skipped = indent
            continue
        kept.append(line)
    return "\n".join(kept)
