"""Database tables over JDBC, read in parallel slices."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.dates import as_day, day_window

if TYPE_CHECKING:
    from evenkeel.sources.scan import SideSpec


def relation(side: SideSpec) -> str:
    """The relation named to the database: the table, or a subquery holding the extra predicate.

    Only that predicate is passed as text, since it may use the database's own dialect.
    Window and projection are added as DataFrame operations, which Spark renders for it.
    """
    if not side.where:
        return side.qualified_table
    return f"(SELECT * FROM {side.qualified_table} WHERE ({side.where})) side_rows"


def base_options(side: SideSpec) -> dict[str, str]:
    return {
        **side.jdbc,
        "dbtable": relation(side),
        "fetchsize": str(side.fetch_size),
    }


# Types that Spark can cut a read by.
CUT_BY = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType)


def slice_column(side: SideSpec, schema: T.StructType, day: str | dt.date | None, keys: Sequence[str] = ()) -> str | None:
    """The column to cut the read by: the one given, else the window's timestamp, else the first fitting key."""
    kinds = {field.name.lower(): (field.name, field.dataType) for field in schema.fields}
    if side.partition_column:
        return side.partition_column
    column, kind = kinds.get((side.date_column or "").lower(), (None, None))
    if day is not None and isinstance(kind, T.TimestampType):
        return column
    return next((kinds[key.lower()][0] for key in keys if isinstance(kinds.get(key.lower(), (0, 0))[1], CUT_BY)), None)


def slice_options(side: SideSpec, column: str, bounds: tuple) -> dict[str, str]:
    """Options that split the read into ``num_partitions`` range queries.

    Bounds only place the cuts; rows outside them are read by the outermost slices.
    """
    return {
        "partitionColumn": column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(side.num_partitions),
    }


def text_ranges(column: str, cuts: Sequence[str]) -> list[str]:
    """Predicates that cut a text column at the given values, ascending; NULLs are in the first range.

    Each range begins where the one before it ends. The values must ascend in the database's own order of texts.
    """
    if not cuts:
        return []
    if len(set(cuts)) < len(cuts):
        raise ValueError(f"the cuts of {column} must differ")
    values = ["'" + cut.replace("'", "''") + "'" for cut in cuts]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(values, values[1:], strict=False)]
    return [f"{column} < {values[0]} OR {column} IS NULL", *inner, f"{column} >= {values[-1]}"]


def read_predicates(side: SideSpec) -> list[str]:
    """The disjoint predicates a read is cut by: the given ones, or ranges of the text column's cuts."""
    if side.predicates:
        return list(side.predicates)
    return text_ranges(side.partition_column, side.partition_cuts) if side.partition_cuts else []


def misplaced_rows(side: SideSpec, predicates: Sequence[str]) -> str:
    """The relation with one row: the number of rows that don't meet exactly one predicate (unknown counts as not met)."""
    met = " + ".join(f"CASE WHEN ({one}) THEN 1 ELSE 0 END" for one in predicates)
    return f"(SELECT COUNT(*) AS misplaced FROM {relation(side)} WHERE {met} <> 1) checked_rows"


def load_by_predicates(spark: SparkSession, side: SideSpec, predicates: Sequence[str]) -> DataFrame:
    """One task per predicate. Rows in none would be lost and rows in two read twice, so the database counts them first."""
    options = base_options(side)
    if side.check_predicates:
        counted = spark.read.format("jdbc").options(**{**options, "dbtable": misplaced_rows(side, predicates)}).load()
        misplaced = int(counted.first()[0])
        if misplaced:
            raise ValueError(f"{misplaced} rows of {side.qualified_table} don't meet exactly one of the predicates: {list(predicates)}")
    properties = {name: value for name, value in options.items() if name not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=[f"({one})" for one in predicates], properties=properties)


def given_bounds(side: SideSpec, column: str, day: str | dt.date | None) -> tuple | None:
    """Bounds that are known without asking: the given ones, or the day itself."""
    if side.partition_column:
        return side.partition_bounds
    if day is not None and column.lower() == (side.date_column or "").lower():
        first = as_day(day)
        return f"{first} 00:00:00", f"{first + dt.timedelta(days=1)} 00:00:00"
    return None


def read_jdbc(
    spark: SparkSession, side: SideSpec, day: str | dt.date | None, keys: Sequence[str] = ()
) -> DataFrame:
    """Read the table's day window in slices; the database evaluates window and predicate.

    Without known bounds the database is asked for the smallest and largest value first. A
    read that cannot be cut is one task; it must be asked for with ``num_partitions=1``. With
    ``predicates``, or a text column's ``partition_cuts``, each predicate is one task, and the window is added to it.
    """
    options = base_options(side)

    def windowed(df: DataFrame) -> DataFrame:
        if day is not None and side.date_column:
            return df.where(day_window(df, side.date_column, day, side.date_format))
        return df

    def load(**more: str) -> DataFrame:
        return windowed(spark.read.format("jdbc").options(**options, **more).load())

    predicates = read_predicates(side)
    if predicates:
        return windowed(load_by_predicates(spark, side, predicates))
    whole = load()
    if side.num_partitions == 1:
        return whole
    column = slice_column(side, whole.schema, day, keys)
    if column is None:
        raise ValueError(
            f"nothing to cut the read of {side.qualified_table} by: give partition_column (with "
            "partition_cuts where it is a text), predicates, or num_partitions=1 to read it in one task"
        )
    bounds = given_bounds(side, column, day)
    if bounds is None:
        bounds = tuple(whole.agg(F.min(column), F.max(column)).first())
    if None in bounds:  # no rows
        return whole
    return load(**slice_options(side, column, bounds))
