"""Reports as rows ``(section, metric, value)``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from evenkeel.plans.compare import Comparison

SCHEMA = "section string, metric string, value string"


def report_rows(
    comparison: Comparison,
    source_name: str,
    target_name: str,
    day: str | dt.date | None = None,
    paths: Mapping[str, str] | None = None,
) -> DataFrame:
    """Names, day, statistics, columns, differing columns, verdict and stored sets."""
    totals, columns, found = comparison.totals, comparison.columns, comparison.differing
    same = not (totals.source_only or totals.target_only or found)
    listed = [
        ("tables", "source", source_name),
        ("tables", "target", target_name),
        ("tables", "day", None if day is None else str(day)),
        ("statistics", "source_rows", totals.source_rows),
        ("statistics", "target_rows", totals.target_rows),
        ("statistics", "matched", totals.matched),
        ("statistics", "source_only", totals.source_only),
        ("statistics", "target_only", totals.target_only),
        ("statistics", "changed", totals.changed),
        ("columns", "common_columns", len(columns.common)),
        ("columns", "source_only_columns", ",".join(columns.source_only)),
        ("columns", "target_only_columns", ",".join(columns.target_only)),
        *[("column_differences", name, count) for name, count in sorted(found.items())],
        ("verdict", "status", "match" if same else "different"),
        *[("details", kind, path) for kind, path in (paths or {}).items()],
    ]
    texts = [(section, metric, None if value is None else str(value)) for section, metric, value in listed]
    return comparison.spark.createDataFrame(texts, SCHEMA)


def summary_rows(summary: DataFrame) -> DataFrame:
    """The multi-table summary as report rows."""
    plain = ("total_tables", "success_count", "failure_count", "success_percent", "failure_percent")
    entries = [
        f"struct('summary' AS section, '{name}' AS metric, CAST({name} AS STRING) AS value)" for name in plain
    ] + [
        f"struct('tables' AS section, '{name}' AS metric, array_join({name}, ',') AS value)"
        for name in ("success_tables", "failed_tables")
    ]
    return summary.selectExpr(f"inline(array({', '.join(entries)}))")


def write_report(rows: DataFrame, report_path: str, name: str, day: str | dt.date | None = None) -> str:
    """Write report rows (a few dozen) as one JSON-lines file."""
    suffix = f"_{day}" if day is not None else ""
    path = f"{report_path.rstrip('/')}/validation_report_{name}{suffix}"
    rows.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(path)


__all__: Sequence[str] = ["read_report", "report_rows", "summary_rows", "write_report"]
