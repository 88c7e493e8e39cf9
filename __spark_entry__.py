"""Registered queries and their SQL counterparts.

Each table pair is one of the given tables, whole, against a target that Spark derives from
it by one SQL text; the same text derives it in the counterpart. The counterparts spell out
the comparison row by row (full outer join, digest, column tests), not the way it is planned here.
"""

from __future__ import annotations

import atexit
import contextlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel import (
    Comparison,
    Options,
    ReconcileSpec,
    SideSpec,
    compare,
    read_differences,
    run,
    run_many,
    save_differences,
    scan,
    summarize,
)
from evenkeel.functions.dates import relative_day
from evenkeel.operators.columns import normalize, project, with_digest, with_key
from evenkeel.plans.run import outcome_rows
from evenkeel.sinks.reports import read_report, report_rows, summary_rows, write_report
from evenkeel.workspace import remove, shared_folder

try:  # the operators on training text, or a library they need, can be missing
    from evenkeel.llm import registry as text_operators
except ImportError:
    text_operators = None

SMOKE_DIR = "/root/testdata/sf0.001"


@dataclass(frozen=True)
class Pair:
    """A table, the SQL that derives its target, the key, and the columns by kind."""

    table: str
    target: str
    keys: tuple[str, ...]
    texts: tuple[str, ...]
    others: tuple[str, ...]
    source: str | None = None

    @property
    def columns(self) -> list[str]:
        return sorted(self.texts + self.others)

    @property
    def source_sql(self) -> str:
        return self.source or f"select * from {self.table}"


ORDERS = Pair(
    "orders",
    """
    select o_orderkey, o_custkey,
           case when o_orderstatus = 'P' and o_totalprice < 25000 then null else o_orderstatus end as o_orderstatus,
           case when o_totalprice between 100000 and 110000 then o_totalprice + 1 else o_totalprice end as o_totalprice,
           o_orderdate,
           case when o_orderdate < cast('1995-03-01' as timestamp) then 'X-CHANGED' else o_orderpriority end
               as o_orderpriority
    from orders where o_orderdate < cast('2001-07-01' as timestamp)
    union all
    select o_orderkey + 100000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    from orders where o_totalprice > 490000
    """,
    ("o_orderkey",),
    ("o_orderstatus", "o_orderpriority"),
    ("o_custkey", "o_totalprice", "o_orderdate"),
)

LINEITEM_TEXTS = ("l_returnflag", "l_linestatus")
LINEITEM_TARGET = """
    select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
           case when l_quantity = 50 then l_tax + 1 else l_tax end as l_tax,
           case when l_returnflag = 'N' and l_discount = 0.1 then null else l_returnflag end as l_returnflag,
           l_linestatus, l_shipdate
    from lineitem where l_shipdate < cast('2001-09-01' as timestamp)
    union all
    select l_orderkey, l_partkey, l_suppkey, l_linenumber + 10, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus, l_shipdate
    from lineitem where l_quantity = 1
    """
# the key occurs up to several times on both sides
LINEITEM = Pair(
    "lineitem",
    LINEITEM_TARGET,
    ("l_orderkey", "l_linenumber"),
    LINEITEM_TEXTS,
    ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"),
)
# every key holds about a sixth of all rows on both sides
HOT = Pair(
    "lineitem",
    """
    select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
           case when l_quantity = 50 then l_tax + 1 else l_tax end as l_tax, l_returnflag, l_linestatus, l_shipdate
    from lineitem where l_shipdate < cast('2001-09-01' as timestamp)
    """,
    LINEITEM_TEXTS,
    (),
    ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"),
)
# a third of the source under each key, one row per key in the target
ONE_TO_MANY_OTHERS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
)
ONE_TO_MANY = Pair(
    "lineitem",
    f"""
    select l_returnflag, max(l_linestatus) as l_linestatus, {", ".join(f"max({n}) as {n}" for n in ONE_TO_MANY_OTHERS)}
    from lineitem group by l_returnflag
    """,
    ("l_returnflag",),
    ("l_linestatus",),
    ONE_TO_MANY_OTHERS,
)
# more than 16 rows under each key on both sides (sf0.01 and up)
CROWDED = Pair(
    "customer",
    """
    select c_custkey, c_name, c_nationkey, case when c_mktsegment = 'BUILDING' then c_acctbal + 1 else c_acctbal end
           as c_acctbal, c_mktsegment from customer where c_acctbal < 9000
    """,
    ("c_nationkey",),
    ("c_name", "c_mktsegment"),
    ("c_custkey", "c_acctbal"),
)
LONG_NUMBER = "'12345678901234' || cast(o_custkey as varchar(20)) || "
# numbers that need more than 38 digits together
DECIMALS = Pair(
    "orders",
    f"""
    select o_orderkey, o_orderstatus,
           cast({LONG_NUMBER} case when o_orderstatus = 'P' then '.2' else '.1' end as decimal(38,10)) as amount
    from orders
    """,
    ("o_orderkey",),
    ("o_orderstatus",),
    ("amount",),
    f"select o_orderkey, o_orderstatus, cast({LONG_NUMBER} '.1' as decimal(38,18)) as amount from orders",
)
CUSTOMER_DRIFT = Pair(
    "customer",
    """
    select c_custkey as "C_CUSTKEY", c_name as "C_NAME", c_nationkey as "C_NATIONKEY",
           c_mktsegment as "C_MKTSEGMENT", 'web' as channel from customer
    """,
    ("c_custkey",),
    ("c_name", "c_mktsegment"),
    ("c_nationkey",),
)
CUSTOMER_TYPES = Pair(
    "customer",
    """
    select c_custkey, c_name,
           case when c_mktsegment = 'BUILDING' and c_nationkey = 7 then 'n/a'
                when c_mktsegment = 'MACHINERY' and c_nationkey = 9 then '10'
                else cast(c_nationkey as varchar(12)) end as c_nationkey,
           c_acctbal, c_mktsegment
    from customer
    """,
    ("c_custkey",),
    ("c_name", "c_mktsegment"),
    ("c_nationkey", "c_acctbal"),
)
PART = Pair(
    "part",
    """
    select p_partkey, p_name,
           case when p_size = 1 then '' when p_size = 2 and p_type = 'PROMO' then upper(p_brand) || '*' else p_brand end
               as p_brand,
           p_type, case when p_retailprice < 910 then p_size + 1 else p_size end as p_size, p_retailprice
    from part where p_size <> 50
    """,
    ("p_partkey",),
    ("p_name", "p_brand", "p_type"),
    ("p_size", "p_retailprice"),
)
SUPPLIER = Pair(
    "supplier",
    """
    select s_suppkey, s_name, s_nationkey, case when s_acctbal < 0 then null else s_acctbal end as s_acctbal
    from supplier
    """,
    ("s_suppkey",),
    ("s_name",),
    ("s_nationkey", "s_acctbal"),
)
EVENTS = Pair(
    "events",
    """
    select event_id, case when event_type = 'signup' and value < 3 then ts + interval 1 second else ts end as ts,
           user_id, event_type, value,
           case when event_type = 'error' then null else props end as props
    from events where value < 450
    """,
    ("event_id",),
    ("event_type", "props"),
    ("ts", "user_id", "value"),
)
DOCUMENTS = Pair(
    "documents",
    """
    select doc_id, case when lang = 'es' then text || ' ' when lang = 'fr' and n_chars < 2000 then ' NaN ' else text end
               as text,
           case when lang = 'de' then null else lang end as lang, source, n_chars
    from documents
    """,
    ("doc_id",),
    ("text", "lang", "source"),
    ("n_chars",),
)
EMBEDDINGS = Pair(
    "embeddings",
    """
    select vec_id, case when label = 2 then null else embedding end as embedding,
           case when label = 3 then label + 1 else label end as label
    from embeddings where label <> 7
    """,
    ("vec_id",),
    (),
    ("embedding", "label"),
)
PAGES = Pair(
    "pages",
    "select page_id, url || '/' as url, html from pages",
    ("page_id",),
    ("url", "html"),
    (),
)
CONVERSATIONS = Pair(
    "conversations",
    """
    select conv_id, turn, role, case when role = 'system' then null else text end as text
    from conversations where turn < 9
    """,
    ("conv_id", "turn"),
    ("role", "text"),
    (),
)
LABELS = Pair(
    "labels",
    "select doc_id, case when toxic = 1 then 1 - quality else quality end as quality, toxic from labels",
    ("doc_id",),
    (),
    ("quality", "toxic"),
)
BENCHMARK = Pair("benchmark", "select * from benchmark", ("item_id",), ("text",), ())
NATION = Pair("nation", "select * from nation", ("n_nationkey",), ("n_name",), ("n_regionkey",))
REGION = Pair("region", "select * from region", ("r_regionkey",), ("r_name",), ())

PAIRS = {
    "orders": ORDERS,
    "lineitem": LINEITEM,
    "customer_types": CUSTOMER_TYPES,
    "part": PART,
    "supplier": SUPPLIER,
    "events": EVENTS,
    "documents": DOCUMENTS,
    "embeddings": EMBEDDINGS,
    "pages": PAGES,
    "conversations": CONVERSATIONS,
    "labels": LABELS,
    "benchmark": BENCHMARK,
    "nation": NATION,
    "region": REGION,
}

BIG = "bigint"
DAY = "2024-01-15"
EARLIER = "2024-01-14"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sides(spark: SparkSession, sf_dir: str, pair: Pair) -> tuple[DataFrame, DataFrame]:
    """Source and target of a pair, as unread DataFrames."""
    def derived(sql: str) -> DataFrame:
        return spark.sql(sql.replace('"', "`").replace(f"from {pair.table}", "from {given}"), given=given)

    given = table(spark, sf_dir, pair.table)
    return derived(pair.source) if pair.source else given, derived(pair.target)


OPEN: list[Comparison] = []
FOLDERS: list[tuple[SparkSession, str]] = []


def opened(comparison: Comparison) -> Comparison:
    OPEN.append(comparison)
    return comparison


def output_folder(spark: SparkSession) -> str:
    FOLDERS.append((spark, shared_folder(spark)))
    return FOLDERS[-1][1]


def close_all() -> None:
    """Remove what the queries wrote; their results must not be read after. Runs by itself at exit."""
    with contextlib.suppress(Exception):  # the session may be gone
        while OPEN:
            OPEN.pop().close()
        while FOLDERS:
            remove(*FOLDERS.pop())


atexit.register(close_all)


def comparison(spark: SparkSession, sf_dir: str, pair: Pair, **options) -> Comparison:
    source, target = sides(spark, sf_dir, pair)
    return opened(compare(source, target, pair.keys, Options(**options)))


def plain_counts(counts: DataFrame) -> DataFrame:
    return counts.withColumns({name: F.col(name).cast(BIG) for name in ("matched", "changed")})


def plain_differences(rows: DataFrame) -> DataFrame:
    return rows.withColumn("differences", F.col("differences").cast(BIG))


# sources, windows, predicates


def with_date_text(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.withColumn("day_text", F.date_format(column, pattern))


def scan_text_days(date_format: str, pattern: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = with_date_text(table(spark, sf_dir, "events"), "ts", pattern)
        return scan(spark, SideSpec(frame=frame, date_column="DAY_TEXT", date_format=date_format), DAY)

    return query


def scan_day_window_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, SideSpec(path=f"{sf_dir}/events.parquet", date_column="ts"), DAY)


def scan_day_window_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return scan(spark, SideSpec(frame=frame, date_column="day", exclude="props"), DAY)


def scan_day_window_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyyMMdd").cast("int"))
    return scan(spark, SideSpec(frame=frame, date_column="day", date_format="yyyymmdd"), DAY)


def scan_catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_catalog")
    return scan(spark, SideSpec(table="orders_catalog", date_column="O_ORDERDATE"), "1995-01-16")


def scan_relative_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = relative_day(2, as_of="2024-01-17")
    return scan(spark, SideSpec(path=f"{sf_dir}/events.parquet", date_column="ts"), day)


def scan_where_conjunct(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = SideSpec(
        path=f"{sf_dir}/orders.parquet",
        date_column="o_orderdate",
        where="o_orderstatus = 'F' OR o_orderpriority LIKE '1%'",
    )
    return scan(spark, side, "1995-01-16")


def scan_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = sides(spark, sf_dir, EVENTS)
    windows = [scan(spark, SideSpec(frame=df, date_column="ts"), DAY) for df in (source, target)]
    return compare(*windows, "event_id").row_counts()


# projection, normalisation, key, digest


def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "orders"), "O_ORDERKEY, o_totalprice,O_OrderStatus")


def project_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "customer"), exclude=["C_ACCTBAL"])


def lower_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(sides(spark, sf_dir, CUSTOMER_DRIFT)[1])


def normalize_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    spelled = {"de": " NaN ", "es": "nan", "fr": "+NaN"}
    spelling = F.lit(None)
    for lang, text in spelled.items():
        spelling = F.when(F.col("lang") == lang, text).otherwise(spelling)
    return normalize(table(spark, sf_dir, "documents").withColumn("SPELLING", spelling.cast("string")))


def composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = normalize(table(spark, sf_dir, "lineitem"))
    return with_key(df, ["L_ORDERKEY", "l_linenumber"]).select("l_orderkey", "l_linenumber", "_composite_key")


def composite_key_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("first_part"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("second_part"),
    )
    return with_key(normalize(df), "first_part,second_part").select("o_orderkey", "_composite_key")


def row_digest(name: str, keys: str, drop: tuple[str, ...] = ()) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = normalize(project(table(spark, sf_dir, name), exclude=drop))
        return with_digest(with_key(df, keys), keys).select("_composite_key", "_row_hash")

    return query


def row_digest_key_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = normalize(project(table(spark, sf_dir, "orders"), "o_orderkey"))
    return with_digest(with_key(df, "o_orderkey"), "o_orderkey").select("_composite_key", "_row_hash")


# comparison of a pair


def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparison(spark, sf_dir, CUSTOMER_DRIFT).schema_diff()


def pair_counts(pair: Pair, **options) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plain_counts(comparison(spark, sf_dir, pair, **options).counts())


def column_diffs(pair: Pair, **options) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plain_differences(comparison(spark, sf_dir, pair, **options).column_differences())


def pair_metrics(pair: Pair, **options) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plain_counts(comparison(spark, sf_dir, pair, **options).metrics())


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = comparison(spark, sf_dir, ORDERS).status_counts()
    return rows.withColumn("row_count", F.col("row_count").cast(BIG))


def one_sided(side: str, pair: Pair) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: getattr(comparison(spark, sf_dir, pair), f"{side}_only")().drop("_row_hash")


def flat_pairs(rows: DataFrame, names: list[str], *lead: str) -> DataFrame:
    return rows.select(
        *lead,
        "_composite_key",
        *[F.col(side)[name].alias(f"{side}_{name}") for side in ("source", "target") for name in names],
    )


def matched_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_pairs(comparison(spark, sf_dir, ORDERS).matched(), ORDERS.columns)


def changed_pairs(pair: Pair) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: flat_pairs(comparison(spark, sf_dir, pair).changed(), pair.columns)


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_pairs(comparison(spark, sf_dir, ORDERS).classified(), ORDERS.columns, "status")


def changed_rows(pair: Pair) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: flat_pairs(
        comparison(spark, sf_dir, pair).changed("rows"), pair.columns, "side", "partners", "unequal_partners"
    )


def classified_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_pairs(comparison(spark, sf_dir, CROWDED).classified("rows"), CROWDED.columns, "status")


def verdict(pair: Pair) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: comparison(spark, sf_dir, pair).verdict()


def duplicate_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem")
    counts = opened(compare(df, df, LINEITEM.keys)).key_counts()
    return counts.where("source_rows > 1").select(
        "_composite_key", "source_rows", F.col("pairs").cast(BIG), F.col("same_pairs").cast(BIG)
    )


# results written and read back


def readback_one_sided(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = output_folder(spark)
    save_differences(comparison(spark, sf_dir, ORDERS), out, "orders", DAY)
    kinds = ("source_only", "target_only")
    parts = [read_differences(spark, out, "orders", kind, DAY).withColumn("kind", F.lit(kind)) for kind in kinds]
    return parts[0].unionByName(parts[1]).drop("dt", "_row_hash")


def readback_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = output_folder(spark)
    save_differences(comparison(spark, sf_dir, ORDERS), out, "orders", DAY)
    rows = read_differences(spark, out, "orders", "column_differences", DAY)
    return rows.select(
        "source.o_orderkey",
        F.col("source.o_totalprice").alias("source_totalprice"),
        F.col("target.o_totalprice").alias("target_totalprice"),
    )


def readback_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of one set; the first was stored without a column that the second has."""
    out = output_folder(spark)
    source, target = sides(spark, sf_dir, ORDERS)
    narrow = opened(compare(source.drop("o_orderpriority"), target.drop("o_orderpriority"), ORDERS.keys))
    save_differences(narrow, out, "orders", EARLIER)
    save_differences(comparison(spark, sf_dir, ORDERS), out, "orders", DAY)
    rows = read_differences(spark, out, "orders", "source_only")
    return rows.select("o_orderkey", "o_totalprice", "o_orderpriority", F.col("dt").cast("string").alias("dt"))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = report_rows(comparison(spark, sf_dir, ORDERS), "orders", "orders_copy", DAY)
    return read_report(spark, write_report(rows, output_folder(spark), "orders", DAY))


def day_spec(spark: SparkSession, sf_dir: str) -> ReconcileSpec:
    sides(spark, sf_dir, EVENTS)[1].createOrReplaceTempView("events_copy")
    out = output_folder(spark)
    return ReconcileSpec(
        "events",
        SideSpec(path=f"{sf_dir}/events.parquet", date_column="ts"),
        SideSpec(table="events_copy", date_column="ts"),
        "event_id",
        output_path=f"{out}/differences",
        report_path=f"{out}/reports",
    )


def run_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = run(spark, day_spec(spark, sf_dir), as_of="2024-01-17")
    return plain_counts(outcome_rows(spark, [outcome])).drop("error")


MANY = {
    "benchmark": BENCHMARK,
    "documents": DOCUMENTS,
    "nation": NATION,
    "orders": ORDERS,
    "part": PART,
    "region": REGION,
}


def many_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = []
    for name, pair in MANY.items():
        source, target = sides(spark, sf_dir, pair)
        specs.append(ReconcileSpec(name, SideSpec(frame=source), SideSpec(frame=target), pair.keys))
    specs.append(ReconcileSpec("absent", SideSpec(table="no_such_table"), SideSpec(table="no_such_table"), "id"))
    return run_many(spark, specs, max_workers=3)


def multi_pair_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = many_outcomes(spark, sf_dir)
    return plain_counts(rows).withColumn("failed", F.col("error").isNotNull()).drop("error", "day")


def multi_pair_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = ("success_tables", "failed_tables")
    return summarize(many_outcomes(spark, sf_dir)).withColumns({name: F.array_join(name, ",") for name in lists})


def multi_pair_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = summary_rows(summarize(many_outcomes(spark, sf_dir)))
    return read_report(spark, write_report(rows, output_folder(spark), "summary"))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: counts, differing columns and verdict of the orders pair."""
    return pair_metrics(ORDERS)(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return table_queries() | (text_operators.queries() if text_operators else {})


def oracle_sql() -> dict[str, str]:
    return table_sql() | (text_operators.oracle_sql() if text_operators else {})


def table_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_day_window_ts": scan_day_window_ts,
        "scan_day_window_date": scan_day_window_date,
        "scan_day_window_number": scan_day_window_number,
        "scan_day_text_iso": scan_text_days("yyyy-mm-dd", "yyyy-MM-dd HH:mm:ss"),
        "scan_day_text_compact": scan_text_days("yyyymmdd", "yyyyMMdd"),
        "scan_day_text_compact_time": scan_text_days("yyyymmdd HH24:mm:ss", "yyyyMMdd HH:mm:ss"),
        "scan_day_text_iso_time": scan_text_days("yyyy-mm-dd HH24:mm:ss", "yyyy-MM-dd HH:mm:ss"),
        "scan_catalog_table": scan_catalog_table,
        "scan_relative_day": scan_relative_day,
        "scan_where_conjunct": scan_where_conjunct,
        "scan_row_counts": scan_row_counts,
        "project_columns": project_columns,
        "project_exclude": project_exclude,
        "lower_names": lower_names,
        "normalize_strings": normalize_strings,
        "composite_key": composite_key,
        "composite_key_nulls": composite_key_nulls,
        "row_digest_orders": row_digest("orders", "o_orderkey"),
        "row_digest_documents": row_digest("documents", "doc_id"),
        "row_digest_key_only": row_digest_key_only,
        "schema_diff": schema_diff,
        **{f"pair_counts_{name}": pair_counts(pair) for name, pair in PAIRS.items()},
        **{f"column_diffs_{name}": column_diffs(pair) for name, pair in PAIRS.items()},
        "status_counts": status_counts,
        "pair_metrics": pair_metrics(ORDERS),
        "pair_metrics_typed_keys": pair_metrics(LINEITEM, key_mode="typed"),
        "pair_metrics_safe_digest": pair_metrics(DOCUMENTS, digest="safe"),
        "verdict_different": verdict(ORDERS),
        "verdict_match": verdict(NATION),
        "schema_drift_all": pair_metrics(CUSTOMER_DRIFT),
        "schema_drift_common": pair_metrics(CUSTOMER_DRIFT, digest_columns="common"),
        "source_only": one_sided("source", ORDERS),
        "target_only": one_sided("target", ORDERS),
        "source_only_lineitem": one_sided("source", LINEITEM),
        "target_only_lineitem": one_sided("target", LINEITEM),
        "matched_pairs": matched_pairs,
        "changed_pairs": changed_pairs(ORDERS),
        "changed_pairs_lineitem": changed_pairs(LINEITEM),
        "classified": classified,
        "duplicate_key_counts": duplicate_key_counts,
        "one_to_many_counts": pair_counts(ONE_TO_MANY),
        "one_to_many_column_diffs": column_diffs(ONE_TO_MANY),
        "one_to_many_changed_pairs": changed_pairs(ONE_TO_MANY),
        "hot_key_counts": pair_counts(HOT),
        "hot_key_column_diffs": column_diffs(HOT),
        "hot_key_changed_rows": changed_rows(HOT),
        "crowded_changed_pairs": changed_pairs(CROWDED),
        "crowded_changed_rows": changed_rows(CROWDED),
        "crowded_classified_rows": classified_rows,
        "pair_metrics_long_decimals": pair_metrics(DECIMALS),
        "column_diffs_long_decimals": column_diffs(DECIMALS),
        "pair_metrics_safe_arrays": pair_metrics(EMBEDDINGS, digest="safe"),
        "readback_one_sided": readback_one_sided,
        "readback_changed": readback_changed,
        "readback_days": readback_days,
        "report_rows": report,
        "run_one_day": run_one_day,
        "multi_pair_outcomes": multi_pair_outcomes,
        "multi_pair_summary": multi_pair_summary,
        "multi_pair_report": multi_pair_report,
    }


# SQL counterparts


def clean(name: str) -> str:
    return f"case when {name} is null or coalesce(isnan(try_cast({name} as double)), false) then '' else {name} end"


def sql_side(sql: str, pair: Pair, columns: list[str], safe: bool = False) -> str:
    """One side with key ``k``, digest ``h`` and the given columns, texts normalised."""
    texts = set(pair.texts) | {key for key in pair.keys if pair is HOT or pair is ONE_TO_MANY}
    value = {name: clean(name) if name in texts else name for name in (*columns, *pair.keys)}
    key = ", ".join(value[name] for name in pair.keys)
    blank = "'<null>'" if safe else "''"
    parts = ", ".join(f"coalesce(cast({value[name]} as varchar), {blank})" for name in sorted(columns))
    listed = ", ".join(f"{value[name]} as {name}" for name in (*columns, *pair.keys))
    digest = f"sha256(concat_ws('||', {parts}))" if parts else "sha256('')"
    return f"select concat_ws('||', {key}) as k, {digest} as h, {listed} from ({sql})"


def joined(pair: Pair, source_extra: tuple = (), target_extra: tuple = (), where: str = "", safe: bool = False) -> str:
    """Both sides and their full outer join as common table expressions."""
    columns = pair.columns
    source = f"select * from ({pair.source_sql}) {where}"
    target = f"select * from ({pair.target}) {where}"
    names = [*pair.keys, *columns]
    both = ", ".join(f"s.{n} as s_{n}, t.{n} as t_{n}" for n in names)
    return f"""
    with s as ({sql_side(source, pair, columns + list(source_extra), safe)}),
         t as ({sql_side(target, pair, columns + list(target_extra), safe)}),
         j as (select s.k as sk, t.k as tk, s.h as sh, t.h as th, {both} from s full outer join t on s.k = t.k)
    """


COUNT_COLUMNS = """
    (select count(*) from s) as source_rows, (select count(*) from t) as target_rows,
    count(*) filter (where tk is null) as source_only,
    count(*) filter (where sk is null) as target_only,
    count(*) filter (where sk is not null and tk is not null) as matched,
    count(*) filter (where sh <> th) as changed
"""


def sql_counts(pair: Pair) -> str:
    return f"{joined(pair)} select {COUNT_COLUMNS} from j"


def sql_differences(pair: Pair) -> str:
    parts = [f"select '{n}' as column_name, count(*) as differences from j where sh <> th and {sql_differs(pair, n)}"
             for n in pair.columns]
    return f"select * from ({' union all '.join(parts)}) where differences > 0"


def sql_differs(pair: Pair, name: str) -> str:
    if pair is DECIMALS and name == "amount":
        plain = [f"rtrim(cast({side}_{name} as varchar), '0')" for side in "st"]
        return f"{plain[0]} is distinct from {plain[1]}"
    if pair is CUSTOMER_TYPES and name == "c_nationkey":
        cast = f"try_cast(t_{name} as integer)"
        return f"(s_{name} is distinct from {cast} or (t_{name} is not null and {cast} is null))"
    return f"s_{name} is distinct from t_{name}"


def sql_common(pair: Pair) -> str:
    """How many columns both sides have, by name in lower case."""
    names = [f"select lower(column_name) from (describe {sql})" for sql in (pair.source_sql, pair.target)]
    return f"(select count(*) from ({names[0]} intersect {names[1]}))"


def sql_metrics(pair: Pair, **sides_of) -> str:
    return f"""
    {joined(pair, **sides_of)}, d as ({sql_differences(pair)}), c as (select {COUNT_COLUMNS} from j)
    select *, cast({sql_common(pair)} as bigint) as common_columns, (select count(*) from d) as differing_columns,
           source_only = 0 and target_only = 0 and (select count(*) from d) = 0 as is_match
    from c
    """


def sql_one_sided(side: str, pair: Pair) -> str:
    own, other = ("s", "t") if side == "source" else ("t", "s")
    return f"""
    {joined(pair)}
    select * exclude (h, k), k as _composite_key from {own} where k not in (select k from {other})
    """


def sql_pairs(pair: Pair, where: str, lead: str = "") -> str:
    listed = ", ".join(f"{side[0]}_{n} as {side}_{n}" for side in ("source", "target") for n in pair.columns)
    return f"{joined(pair)} select {lead} coalesce(sk, tk) as _composite_key, {listed} from j where {where}"


def hot_sides() -> str:
    """Both sides of the hot pair without their join."""
    return joined(HOT).rsplit("j as (", 1)[0].rstrip().rstrip(",")


def sql_hot_counts() -> str:
    # 10^8 pairs and more: counted from group sizes, as no engine lists them
    return f"""
    {hot_sides()},
         g as (select k, h, sum(a) as a, sum(b) as b from (
                   select k, h, 1 as a, 0 as b from s union all select k, h, 0, 1 from t) group by k, h),
         p as (select k, sum(a) as a, sum(b) as b, sum(a * b) as same from g group by k)
    select cast(sum(a) as bigint) as source_rows, cast(sum(b) as bigint) as target_rows,
           cast(coalesce(sum(a) filter (where b = 0), 0) as bigint) as source_only,
           cast(coalesce(sum(b) filter (where a = 0), 0) as bigint) as target_only,
           cast(sum(a * b) as bigint) as matched, cast(sum(a * b - same) as bigint) as changed
    from p
    """


def sql_hot_differences() -> str:
    parts = []
    for n in HOT.columns:
        cells = f"(select k, h, {n} as v, 1 as a, 0 as b from s union all select k, h, {n}, 0, 1 from t)"

        def pairs(*by: str) -> str:
            return f"(select sum(a * b) from (select sum(a) as a, sum(b) as b from {cells} group by {', '.join(by)}))"

        value = f"{pairs('k')} - {pairs('k', 'h')} - {pairs('k', 'v')} + {pairs('k', 'v', 'h')}"
        parts.append(f"select '{n}' as column_name, cast({value} as bigint) as differences")
    return f"{hot_sides()} select * from ({' union all '.join(parts)}) where differences > 0"


def sql_changed_rows(pair: Pair) -> str:
    """Every row with an unequal partner: partners by a join on the key, equal ones by key and digest."""

    def part(side: str, own: str, other: str) -> str:
        listed = ", ".join(
            f"{f'{own}.{n}' if name[0] == own else 'null'} as {name}_{n}" for name in ("source", "target") for n in pair.columns
        )
        return f"""
        select '{side}' as side, {own}.k as _composite_key, cast(p.n as bigint) as partners,
               cast(p.n - coalesce(e.n, 0) as bigint) as unequal_partners, {listed}
        from {own} join (select k, count(*) as n from {other} group by k) p on {own}.k = p.k
             left join (select k, h, count(*) as n from {other} group by k, h) e on {own}.k = e.k and {own}.h = e.h
        where p.n > coalesce(e.n, 0)
        """

    whole = joined(pair).rsplit("j as (", 1)[0].rstrip().rstrip(",")
    return f"{whole} {part('source', 's', 't')} union all {part('target', 't', 's')}"


def sql_classified_rows(pair: Pair) -> str:
    def part(side: str, own: str, other: str) -> str:
        listed = ", ".join(
            f"{f'{own}.{n}' if name[0] == own else 'null'} as {name}_{n}" for name in ("source", "target") for n in pair.columns
        )
        return f"""
        select case when {own}.k not in (select k from {other}) then '{side}_only'
                    when exists (select 1 from {other} x where x.k = {own}.k and x.h <> {own}.h) then 'changed'
                    else 'equal' end as status, {own}.k as _composite_key, {listed}
        from {own}
        """

    whole = joined(pair).rsplit("j as (", 1)[0].rstrip().rstrip(",")
    return f"{whole} {part('source', 's', 't')} union all {part('target', 't', 's')}"


DAY_OF_TS = f"ts >= timestamp '{DAY}' and ts < timestamp '{DAY}' + interval 1 day"


def sql_text_days(pattern: str) -> str:
    return f"select *, strftime(ts, '{pattern}') as day_text from events where {DAY_OF_TS}"


def sql_outcomes() -> str:
    parts = []
    for name, pair in MANY.items():
        parts.append(
            f"select '{name}' as name, is_match, source_rows, target_rows, source_only, target_only, matched, changed,"
            f" differing_columns, false as failed from ({sql_metrics(pair)})"
        )
    empty = ", ".join(
        f"null as {n}"
        for n in ("source_rows", "target_rows", "source_only", "target_only", "matched", "changed", "differing_columns")
    )
    parts.append(f"select 'absent' as name, null as is_match, {empty}, true as failed")
    return " union all ".join(parts)


def sql_summary() -> str:
    return f"""
    with o as (select name, coalesce(is_match, false) as good from ({sql_outcomes()}))
    select count(*) as total_tables, count(*) filter (where good) as success_count,
           count(*) filter (where not good) as failure_count,
           round(100.0 * count(*) filter (where good) / count(*), 1) as success_percent,
           round(100.0 * count(*) filter (where not good) / count(*), 1) as failure_percent,
           string_agg(name, ',' order by name) filter (where good) as success_tables,
           string_agg(name, ',' order by name) filter (where not good) as failed_tables
    from o
    """


def sql_summary_report() -> str:
    numbers = ("total_tables", "success_count", "failure_count", "success_percent", "failure_percent")
    parts = [f"select 'summary' as section, '{n}' as metric, cast({n} as varchar) as value from r" for n in numbers]
    parts += [f"select 'tables', '{n}', {n} from r" for n in ("success_tables", "failed_tables")]
    return f"with r as ({sql_summary()}) {' union all '.join(parts)}"


def sql_report() -> str:
    statistics = ("source_rows", "target_rows", "matched", "source_only", "target_only", "changed")
    lines = [
        ("tables", "source", "'orders'"),
        ("tables", "target", "'orders_copy'"),
        ("tables", "day", f"'{DAY}'"),
        *[("statistics", name, f"(select cast({name} as varchar) from c)") for name in statistics],
        ("columns", "common_columns", f"cast({sql_common(ORDERS)} as varchar)"),
        ("columns", "source_only_columns", "''"),
        ("columns", "target_only_columns", "''"),
        ("verdict", "status", "(select case when source_only + target_only + (select count(*) from d) = 0 then 'match' else 'different' end from c)"),
    ]
    parts = [f"select '{part}' as section, '{metric}' as metric, {value} as value" for part, metric, value in lines]
    parts.append("select 'column_differences', column_name, cast(differences as varchar) from d")
    return f"""
    {joined(ORDERS)}, d as ({sql_differences(ORDERS)}), c as (select {COUNT_COLUMNS} from j)
    {' union all '.join(parts)}
    """


def sql_digest(name: str, pair: Pair) -> str:
    return f"select k as _composite_key, h as _row_hash from ({sql_side(f'select * from {name}', pair, pair.columns)})"


def table_sql() -> dict[str, str]:
    window = f"where {DAY_OF_TS}"
    run_metrics = sql_metrics(EVENTS, where=window)
    return {
        "scan_day_window_ts": f"select * from events {window}",
        "scan_day_window_date": f"select * exclude (props), cast(ts as date) as day from events {window}",
        "scan_day_window_number": f"select *, cast(strftime(ts, '%Y%m%d') as integer) as day from events {window}",
        "scan_day_text_iso": sql_text_days("%Y-%m-%d %H:%M:%S"),
        "scan_day_text_compact": sql_text_days("%Y%m%d"),
        "scan_day_text_compact_time": sql_text_days("%Y%m%d %H:%M:%S"),
        "scan_day_text_iso_time": sql_text_days("%Y-%m-%d %H:%M:%S"),
        "scan_catalog_table": """
            select * from orders
            where o_orderdate >= timestamp '1995-01-16' and o_orderdate < timestamp '1995-01-17'""",
        "scan_relative_day": f"select * from events {window}",
        "scan_where_conjunct": """
            select * from orders
            where o_orderdate >= timestamp '1995-01-16' and o_orderdate < timestamp '1995-01-17'
              and (o_orderstatus = 'F' or o_orderpriority like '1%')""",
        "scan_row_counts": f"""
            select (select count(*) from events {window}) as source_rows,
                   (select count(*) from ({EVENTS.target}) {window}) as target_rows""",
        "project_columns": "select o_orderkey, o_totalprice, o_orderstatus from orders",
        "project_exclude": "select * exclude (c_acctbal) from customer",
        "lower_names": """
            select c_custkey, c_name, c_nationkey, c_mktsegment, 'web' as channel from customer""",
        "normalize_strings": f"""
            select doc_id, {clean('text')} as text, {clean('lang')} as lang, {clean('source')} as source, n_chars,
                   {clean('x')} as spelling
            from (select *, case lang when 'de' then ' NaN ' when 'es' then 'nan' when 'fr' then '+NaN' end as x from documents)""",
        "composite_key": """
            select l_orderkey, l_linenumber, l_orderkey || '||' || l_linenumber as _composite_key from lineitem""",
        "composite_key_nulls": """
            select o_orderkey, concat_ws('||', case when o_orderstatus <> 'P' then o_custkey end,
                   case when o_orderstatus <> 'F' then o_orderstatus else '' end) as _composite_key from orders""",
        "row_digest_orders": sql_digest("orders", ORDERS),
        "row_digest_documents": sql_digest("documents", DOCUMENTS),
        "row_digest_key_only": """
            select cast(o_orderkey as varchar) as _composite_key, sha256('') as _row_hash from orders""",
        "schema_diff": """
            with s as (select column_name from (describe customer)),
                 t as (select column_name from s where column_name <> 'c_acctbal' union all select 'channel')
            select distinct * from (
                select coalesce(s.column_name, t.column_name) as column_name,
                       case when t.column_name is null then 'source_only'
                            when s.column_name is null then 'target_only' else 'common' end as side
                from s full outer join t on s.column_name = t.column_name)""",
        **{f"pair_counts_{name}": sql_counts(pair) for name, pair in PAIRS.items()},
        **{f"column_diffs_{name}": f"{joined(pair)} {sql_differences(pair)}" for name, pair in PAIRS.items()},
        "status_counts": f"""
            {joined(ORDERS)}
            select case when tk is null then 'source_only' when sk is null then 'target_only'
                        when sh <> th then 'changed' else 'equal' end as status, count(*) as row_count
            from j group by 1""",
        "pair_metrics": sql_metrics(ORDERS),
        "pair_metrics_typed_keys": sql_metrics(LINEITEM),
        "pair_metrics_safe_digest": sql_metrics(DOCUMENTS, safe=True),
        "verdict_different": f"select is_match from ({sql_metrics(ORDERS)})",
        "verdict_match": f"select is_match from ({sql_metrics(NATION)})",
        "schema_drift_all": sql_metrics(CUSTOMER_DRIFT, source_extra=("c_acctbal",), target_extra=("channel",)),
        "schema_drift_common": sql_metrics(CUSTOMER_DRIFT),
        "source_only": sql_one_sided("source", ORDERS),
        "target_only": sql_one_sided("target", ORDERS),
        "source_only_lineitem": sql_one_sided("source", LINEITEM),
        "target_only_lineitem": sql_one_sided("target", LINEITEM),
        "matched_pairs": sql_pairs(ORDERS, "sk is not null and tk is not null"),
        "changed_pairs": sql_pairs(ORDERS, "sh <> th"),
        "changed_pairs_lineitem": sql_pairs(LINEITEM, "sh <> th"),
        "classified": sql_pairs(
            ORDERS,
            "true",
            """case when tk is null then 'source_only' when sk is null then 'target_only'
                    when sh <> th then 'changed' else 'equal' end as status,""",
        ),
        "duplicate_key_counts": """
            with r as (select l_orderkey || '||' || l_linenumber as k, lineitem as whole_row from lineitem),
                 g as (select k, whole_row, count(*) as n from r group by all)
            select k as _composite_key, cast(sum(n) as bigint) as source_rows,
                   cast(sum(n) * sum(n) as bigint) as pairs, cast(sum(n * n) as bigint) as same_pairs
            from g group by k having sum(n) > 1""",
        "one_to_many_counts": sql_counts(ONE_TO_MANY),
        "one_to_many_column_diffs": f"{joined(ONE_TO_MANY)} {sql_differences(ONE_TO_MANY)}",
        "one_to_many_changed_pairs": sql_pairs(ONE_TO_MANY, "sh <> th"),
        "hot_key_counts": sql_hot_counts(),
        "hot_key_column_diffs": sql_hot_differences(),
        "hot_key_changed_rows": sql_changed_rows(HOT),
        "crowded_changed_pairs": sql_pairs(CROWDED, "sh <> th"),
        "crowded_changed_rows": sql_changed_rows(CROWDED),
        "crowded_classified_rows": sql_classified_rows(CROWDED),
        "pair_metrics_long_decimals": sql_metrics(DECIMALS),
        "column_diffs_long_decimals": f"{joined(DECIMALS)} {sql_differences(DECIMALS)}",
        "pair_metrics_safe_arrays": sql_metrics(EMBEDDINGS, safe=True),
        "readback_one_sided": f"""
            select *, 'source_only' as kind from ({sql_one_sided('source', ORDERS)})
            union all select *, 'target_only' from ({sql_one_sided('target', ORDERS)})""",
        "readback_changed": f"""
            {joined(ORDERS)} select s_o_orderkey as o_orderkey, s_o_totalprice as source_totalprice,
                   t_o_totalprice as target_totalprice from j where sh <> th""",
        "readback_days": f"""
            select o_orderkey, o_totalprice, null as o_orderpriority, '{EARLIER}' as dt from ({sql_one_sided('source', ORDERS)})
            union all select o_orderkey, o_totalprice, o_orderpriority, '{DAY}' from ({sql_one_sided('source', ORDERS)})""",
        "report_rows": sql_report(),
        "run_one_day": f"""
            select 'events' as name, '{DAY}' as day, is_match, source_rows, target_rows, source_only, target_only,
                   matched, changed, differing_columns from ({run_metrics})""",
        "multi_pair_outcomes": sql_outcomes(),
        "multi_pair_summary": sql_summary(),
        "multi_pair_report": sql_summary_report(),
    }
