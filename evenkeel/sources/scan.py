"""One side of a comparison: a table, file set, frame or database table for one day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions.dates import check_format, day_window
from evenkeel.operators.columns import project
from evenkeel.sources.jdbc import read_jdbc


@dataclass(frozen=True)
class SideSpec:
    """Where one side's rows come from and which of them count.

    Exactly one of ``table`` (catalog name; with ``jdbc`` the database's table name),
    ``path`` (Parquet) and ``frame`` is given. ``namespace`` qualifies ``table``.
    ``where`` is an extra SQL predicate; it is evaluated by the database for JDBC.
    A JDBC read is cut by ``predicates`` (SQL conditions of which every row meets exactly one), by a text
    ``partition_column`` at ``partition_cuts``, or by a number or time column into ``num_partitions`` ranges.
    With ``check_predicates`` the database first counts the rows that don't meet exactly one predicate.
    """

    table: str | None = None
    path: str | None = None
    frame: DataFrame | None = None
    namespace: str | None = None
    jdbc: Mapping[str, str] | None = None
    columns: str | Sequence[str] = "*"
    exclude: str | Sequence[str] = ()
    date_column: str | None = None
    date_format: str = "yyyy-mm-dd"
    where: str | None = None
    partition_column: str | None = None
    partition_bounds: tuple | None = None
    partition_cuts: Sequence[str] = ()
    predicates: Sequence[str] = ()
    check_predicates: bool = True
    num_partitions: int = 10
    fetch_size: int = 10_000
    label: str | None = field(default=None, compare=False)

    def __post_init__(self) -> None:
        given = [kind for kind in ("table", "path", "frame") if getattr(self, kind) is not None]
        if len(given) != 1:
            raise ValueError(f"give exactly one of table, path and frame, not {given}")
        if self.jdbc is not None and self.table is None:
            raise ValueError("a JDBC side needs a table name")
        if (self.predicates or self.partition_cuts) and self.jdbc is None:
            raise ValueError("predicates and partition_cuts cut JDBC reads only")
        if isinstance(self.predicates, str) or isinstance(self.partition_cuts, str):
            raise ValueError("predicates and partition_cuts are lists")
        if self.predicates and (self.partition_column or self.partition_cuts):
            raise ValueError("give predicates or a partition_column, not both")
        if self.partition_cuts and not self.partition_column:
            raise ValueError("partition_cuts need a partition_column")
        check_format(self.date_format)

    @property
    def qualified_table(self) -> str | None:
        return f"{self.namespace}.{self.table}" if self.table and self.namespace else self.table

    @property
    def name(self) -> str:
        return self.label or self.qualified_table or self.path or "frame"


def scan(
    spark: SparkSession, side: SideSpec, day: str | dt.date | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Read one side: window, extra predicate, projection, all left to the scan's pushdown.

    Without ``day`` or a date column the whole table is read. The extra predicate is a
    conjunct of its own, so an OR inside it cannot reach outside the window. ``keys`` are
    columns that a database read may be cut by.
    """
    if side.jdbc is not None:
        return project(read_jdbc(spark, side, day, keys), side.columns, side.exclude)
    if side.frame is not None:
        df = side.frame
    elif side.path is not None:
        df = spark.read.parquet(side.path)
    else:
        df = spark.read.table(side.qualified_table)
    if day is not None and side.date_column:
        df = df.where(day_window(df, side.date_column, day, side.date_format))
    if side.where:
        df = df.where(F.expr(side.where))
    return project(df, side.columns, side.exclude)

