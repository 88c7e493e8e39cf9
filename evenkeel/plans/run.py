"""One table pair from scan to verdict, and many pairs in one session."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions.dates import relative_day
from evenkeel.operators.columns import name_list
from evenkeel.operators.ledger import COUNTS
from evenkeel.plans.compare import Comparison, Options, check_layout
from evenkeel.sinks.differences import Labels, save_differences
from evenkeel.sinks.reports import report_rows, write_report
from evenkeel.sources.scan import SideSpec, scan

OUTCOME_SCHEMA = """
    name string, day string, is_match boolean, error string,
    source_rows bigint, target_rows bigint, source_only bigint, target_only bigint,
    matched decimal(38,0), changed decimal(38,0), differing_columns bigint
"""


@dataclass(frozen=True)
class ReconcileSpec:
    """One table pair: both sides, the key, and where results go (nowhere if unset)."""

    name: str
    source: SideSpec
    target: SideSpec
    keys: str | Sequence[str]
    options: Options = field(default_factory=Options)
    output_path: str | None = None
    report_path: str | None = None
    offset_days: int = 2
    labels: Labels = field(default_factory=Labels)
    layout: str = "pairs"

    def __post_init__(self) -> None:
        if not name_list(self.keys):
            raise ValueError("at least one key column is needed")
        check_layout(self.layout)

    @classmethod
    def for_tables(
        cls,
        source_table: str,
        keys: str | Sequence[str],
        target_table: str | None = None,
        *,
        jdbc: Mapping[str, str] | None = None,
        source_namespace: str | None = None,
        target_namespace: str | None = "default",
        date_column: str | None = None,
        date_format: str = "yyyy-mm-dd",
        columns: str | Sequence[str] = "*",
        exclude: str | Sequence[str] = (),
        source_where: str | None = None,
        target_where: str | None = None,
        **rest,
    ) -> ReconcileSpec:
        """A database table (``jdbc``) or catalog table against a catalog table.

        The target has the source's table name unless another is given; the window,
        ``columns`` and ``exclude`` hold for both sides. The pair is named after the source
        table with its namespace.
        """
        shared = {"date_column": date_column, "date_format": date_format, "columns": columns, "exclude": exclude}
        source = SideSpec(
            table=source_table, namespace=source_namespace, jdbc=jdbc, where=source_where, **shared
        )
        target = SideSpec(
            table=target_table or source_table, namespace=target_namespace, where=target_where, **shared
        )
        return cls(source.name, source, target, keys, **rest)

    @property
    def is_daily(self) -> bool:
        return bool(self.source.date_column or self.target.date_column)


@dataclass(frozen=True)
class Outcome:
    """Verdict of one pair. ``is_match`` is None when the run failed; ``error`` says why."""

    name: str
    day: str | None
    is_match: bool | None
    error: str | None = None
    counts: dict[str, int] = field(default_factory=dict)
    differing: dict[str, int] = field(default_factory=dict)
    paths: dict[str, str] = field(default_factory=dict)


def open_comparison(spark: SparkSession, spec: ReconcileSpec, day: str | dt.date | None) -> Comparison:
    """Scan both sides and set up their comparison.

    A database is asked once: its rows are written to the shared folder and compared from
    there, so later steps neither load it again nor see rows that changed meanwhile.
    """
    sides = [scan(spark, side, day, name_list(spec.keys)) for side in (spec.source, spec.target)]
    plan = Comparison(sides[0], sides[1], spec.keys, spec.options)
    if spec.source.jdbc is None and spec.target.jdbc is None:
        return plan
    try:
        kept = [
            plan.store(df, part) if side.jdbc is not None else df
            for part, side, df in zip(("source", "target"), (spec.source, spec.target), sides)
        ]
        return plan.on(kept[0], kept[1])
    except BaseException:
        plan.close()
        raise


def run(
    spark: SparkSession,
    spec: ReconcileSpec,
    day: str | dt.date | None = None,
    as_of: str | dt.date | None = None,
) -> Outcome:
    """Scan, compare, save differences, report, and give the verdict.

    The day is ``day``, else ``offset_days`` before ``as_of`` (default today); pairs without
    date columns are compared whole.
    """
    day = day_of(spec, day, as_of)
    with open_comparison(spark, spec, day) as comparison:
        return _outcome(comparison, spec, day)


def day_of(spec: ReconcileSpec, day: str | dt.date | None, as_of: str | dt.date | None) -> str | dt.date | None:
    return relative_day(spec.offset_days, as_of) if day is None and spec.is_daily else day


def _outcome(comparison: Comparison, spec: ReconcileSpec, day: str | dt.date | None) -> Outcome:
    paths = {}
    if spec.output_path:
        paths = save_differences(
            comparison, spec.output_path, spec.name, day or dt.date.today(), spec.labels, spec.layout
        )
    totals, differing = comparison.totals, comparison.differing
    if spec.report_path:
        rows = report_rows(comparison, spec.source.name, spec.target.name, day, paths)
        write_report(rows, spec.report_path, spec.name, day)
    counts = {name: getattr(totals, name) for name in COUNTS}
    same = not (totals.source_only or totals.target_only or differing)
    return Outcome(spec.name, None if day is None else str(day), same, None, counts, differing, paths)


def outcome_rows(spark: SparkSession, outcomes: Sequence[Outcome]) -> DataFrame:
    """Outcomes as a DataFrame, one row per pair."""
    return spark.createDataFrame(
        [
            (
                o.name, o.day, o.is_match, o.error,
                *[_pairs(o.counts.get(c)) if c in ("matched", "changed") else o.counts.get(c) for c in COUNTS],
                None if o.error else len(o.differing),
            )
            for o in outcomes
        ],
        OUTCOME_SCHEMA,
    )


def _pairs(count: int | None) -> Decimal | None:
    return None if count is None else Decimal(count)


def run_many(
    spark: SparkSession,
    specs: Sequence[ReconcileSpec],
    max_workers: int = 3,
    day: str | dt.date | None = None,
    as_of: str | dt.date | None = None,
) -> DataFrame:
    """Reconcile many pairs in one session, ``max_workers`` at a time (1: one after another).

    The threads only submit Spark jobs. A pair that fails keeps its error and does not stop
    the others. Stored results carry the pairs' names, so these must differ.
    """
    twice = sorted(name for name, times in Counter(spec.name for spec in specs).items() if times > 1)
    if twice:
        raise ValueError(f"pairs with the same name would overwrite each other's results: {twice}")

    def attempt(spec: ReconcileSpec) -> Outcome:
        today = day_of(spec, day, as_of)
        try:
            return run(spark, spec, today)
        except Exception as error:  # noqa: BLE001 - kept as this pair's result
            return Outcome(spec.name, None if today is None else str(today), None, f"{type(error).__name__}: {error}")

    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        task = inheritable_thread_target(spark)(attempt)
        return outcome_rows(spark, list(pool.map(task, specs)))


def summarize(outcomes: DataFrame) -> DataFrame:
    """One row over all pairs: totals, percentages and the two lists of names.

    A mismatch and an error both count as failure.
    """
    success = F.coalesce(F.col("is_match") & F.col("error").isNull(), F.lit(False))

    def share(count: str):
        part = 100 * F.col(count) / F.nullif(F.col("total_tables"), F.lit(0))
        return F.round(part, 1).alias(count.replace("_count", "_percent"))

    return outcomes.agg(
        F.count("*").alias("total_tables"),
        F.count_if(success).alias("success_count"),
        F.count_if(~success).alias("failure_count"),
        F.array_sort(F.collect_list(F.when(success, F.col("name")))).alias("success_tables"),
        F.array_sort(F.collect_list(F.when(~success, F.col("name")))).alias("failed_tables"),
    ).select(
        "total_tables", "success_count", "failure_count",
        share("success_count"), share("failure_count"), "success_tables", "failed_tables",
    )
