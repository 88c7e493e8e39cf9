"""Column sets of the two sides: metadata only, no data is read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class ColumnSets:
    common: tuple[str, ...]
    source_only: tuple[str, ...]
    target_only: tuple[str, ...]


def column_sets(source: DataFrame, target: DataFrame) -> ColumnSets:
    """Common, source-only and target-only column names, lower case and sorted."""
    left = {name.lower() for name in source.columns}
    right = {name.lower() for name in target.columns}
    return ColumnSets(tuple(sorted(left & right)), tuple(sorted(left - right)), tuple(sorted(right - left)))


def schema_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """The column sets as rows ``(column_name, side)``."""
    sets = column_sets(source, target)
    listed = [(name, side) for side in ("common", "source_only", "target_only") for name in getattr(sets, side)]
    return source.sparkSession.createDataFrame(listed, "column_name string, side string")
