"""The plans keep the properties the design relies on."""

import re

from pyspark.sql import functions as F

from evenkeel import Options, compare
from evenkeel.operators import ledger

SF = "/root/testdata/sf0.01"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def pair(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    target = orders.where("o_totalprice > 2000").withColumn("o_custkey", F.col("o_custkey") + 1)
    return orders, target


def few_changed(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    changed = F.when(F.col("o_totalprice") < 30000, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    return orders, orders.where("o_totalprice > 2000").withColumn("o_custkey", changed)


def test_counts_pair_up_no_rows_and_shuffle_once(spark):
    comparison = compare(*pair(spark), "o_orderkey")
    sides = [comparison._digested(rows) for rows in (comparison.source, comparison.target)]
    plan = plan_of(ledger.key_sums(*sides))
    assert "Join" not in plan and "Cartesian" not in plan and "Sort" not in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and plan.count("partial_sum") >= 2
    assert "orders.parquet" not in plan_of(comparison.counts())  # counted from the ledger, which is written once


def test_row_counts_read_no_column_and_shuffle_no_row(spark):
    plan = plan_of(compare(*pair(spark), "o_orderkey").row_counts())
    assert "sha2" not in plan and "Exchange hashpartitioning" not in plan


def test_each_side_is_read_once_with_hot_keys(spark):
    lineitem = spark.read.parquet(f"{SF}/lineitem.parquet")
    target = lineitem.withColumn("l_tax", F.col("l_tax") + (F.col("l_quantity") == 50).cast("int"))
    options = Options(hot_rows=2, broadcast_bytes=0)
    comparison = compare(lineitem, target, "l_returnflag,l_linestatus", options)
    assert comparison._hot is not None
    for rows in (comparison.matched(), comparison.changed()):
        assert len(re.findall(r"Location: InMemoryFileIndex[^\n]*lineitem.parquet", plan_of(rows))) == 2
    one = compare(lineitem, target.where("l_quantity > 1"), "l_orderkey,l_linenumber", options)
    assert len(re.findall(r"Location: InMemoryFileIndex[^\n]*lineitem.parquet", plan_of(one.changed()))) == 2


def test_nothing_is_filtered_by_key_where_most_rows_differ(spark):
    orders, target = pair(spark)  # every row is changed
    plan = plan_of(compare(orders, target, "o_orderkey").changed())
    assert "LeftSemi" not in plan and len(re.findall(r"InMemoryFileIndex[^\n]*orders.parquet", plan)) == 2


def test_one_sided_rows_are_not_shuffled(spark):
    plan = plan_of(compare(*pair(spark), "o_orderkey").source_only())
    assert "LeftSemi" in plan and "Exchange hashpartitioning" not in plan


def test_large_key_lists_are_shuffled_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(compare(*pair(spark), "o_orderkey", Options(broadcast_bytes=0)).source_only())
        assert "Broadcast" not in plan and "LeftSemi" in plan
        pairs = plan_of(compare(*few_changed(spark), "o_orderkey", Options(broadcast_bytes=0)).changed())
        assert "BroadcastNestedLoop" not in pairs and "Cartesian" not in pairs
        # rows filtered by key stay where they are for the join by the same key
        assert len(re.findall(r"Exchange hashpartitioning", pairs)) == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_digest_is_not_computed_for_rows_that_are_dropped(spark):
    plan = plan_of(compare(*few_changed(spark), "o_orderkey").changed())
    assert "isnotnull(sha2" not in plan
    for line in plan.splitlines():
        if "Filter" in line or "DataFilters" in line:
            assert "sha2" not in line


def test_only_compared_columns_are_read(spark):
    orders, target = pair(spark)
    plan = plan_of(compare(orders, target.select("o_orderkey", "o_custkey"), "o_orderkey",
                           Options(digest_columns="common")).key_counts())
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert "o_orderpriority" not in schema and "o_orderstatus" not in schema


def test_kept_rows_serve_all_sets(spark):
    comparison = compare(*pair(spark), "o_orderkey")
    before = [comparison.source_only().count(), comparison.changed().count()]
    comparison.keep_differing_rows()
    for rows in (comparison.source_only(), comparison.target_only(), comparison.changed()):
        assert "orders.parquet" not in plan_of(rows)
    assert [comparison.source_only().count(), comparison.changed().count()] == before
    assert comparison.matched().count() == comparison.totals.matched
    shuffled = compare(*pair(spark), "o_orderkey", Options(broadcast_bytes=0))
    shuffled.keep_differing_rows()
    assert "orders.parquet" in plan_of(shuffled.source_only())


def test_pairs_of_few_rows_are_made_by_several_tasks(spark):
    rows = spark.range(2500).selectExpr("CAST(id < 5000 AS INT) AS nation", "id AS number", "'a' AS name").coalesce(1)
    pairs = compare(rows, rows, "nation").matched()
    per_task = pairs.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(row["count"] for row in per_task) == 6_250_000
    assert len(per_task) > 1


def test_pairs_of_crowded_keys_are_dealt_with_few_copies_of_their_rows(spark, monkeypatch):
    rows = spark.range(1600).selectExpr("id % 4 AS nation", "id AS number")
    target = rows.where("number >= 1").unionAll(spark.range(8).selectExpr("id + 4 AS nation", "id AS number"))
    source = rows.unionAll(spark.range(8).selectExpr("id + 4 AS nation", "id + 1 AS number"))
    dealt = []
    for name in ("repartition", "repartitionById"):
        deal = getattr(type(rows), name)
        monkeypatch.setattr(type(rows), name, lambda self, *by, deal=deal: (dealt.append(self), deal(self, *by))[1])
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        comparison = compare(source, target, "nation", Options(hot_pairs=10_000))
        pairs = comparison.changed()
        # 16 cells for each of four keys, 4 x 4: four copies of each row
        assert sum(df.count() for df in dealt) <= 5 * (1608 + 1607)
        per_task = [row["count"] for row in pairs.groupBy(F.spark_partition_id().alias("task")).count().collect()]
        assert sum(per_task) == comparison.totals.changed == 1600 * 400 - 400 - 1599 + 8
        assert len(per_task) == 64 and max(per_task) <= 2 * min(per_task)
        found = pairs.where("source.nation < 4").selectExpr("source.number AS s", "target.number AS t")
        assert found.distinct().count() == 1600 * 400 - 400 - 1599
    finally:
        spark.conf.unset("spark.sql.shuffle.partitions")


def test_many_pairs_are_made_by_many_tasks_whatever_the_partitions(spark):
    rows = spark.range(1600).selectExpr("id % 4 AS nation", "id AS number")  # the session has 4 partitions
    pairs = compare(rows, rows, "nation", Options(hot_pairs=40_000)).matched()
    per_task = [row["count"] for row in pairs.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert sum(per_task) == 640_000 and len(per_task) == 16


def test_rows_of_repeated_keys_are_digested_and_shuffled_once(spark, monkeypatch):
    monkeypatch.setattr(ledger, "key_sums", None)  # for nearly unique keys only
    rows = spark.range(200).selectExpr("id % 50 AS shelf", "id AS box")
    comparison = compare(rows, rows.where("box < 190"), "shelf", Options(broadcast_bytes=0))
    stored = []
    monkeypatch.setattr(comparison, "store", lambda df, name, store=comparison.store: (stored.append(name), store(df, name))[1])
    counts = comparison.counts().first()
    assert (counts.source_rows, counts.target_rows, int(counts.matched), int(counts.changed)) == (200, 190, 760, 570)
    assert stored == ["key_counts"]
    plan = plan_of(comparison.key_counts())
    assert "Sort" not in plan and "Join" not in plan and len(re.findall(r"Exchange hashpartitioning", plan)) == 2


def test_values_are_counted_without_storing_rows(spark, monkeypatch):
    rows = spark.range(400).selectExpr("id % 2 = 0 AS even", "id AS box", "IF(id < 5, 'a|', 'b') AS note", "id % 7 AS day")
    target = rows.withColumn("day", F.when(F.col("box") < 30, F.col("day") + 1).otherwise(F.col("day")))
    for source, other, looked_into in ((rows, target, True), (rows.drop("note"), target.drop("note"), False)):
        comparison = compare(source, other, "even")
        stored = []
        monkeypatch.setattr(comparison, "store", lambda df, name, store=comparison.store: (stored.append(name), store(df, name))[1])
        found = {r.column_name: int(r.differences) for r in comparison.column_differences().collect()}
        pairs = source.alias("s").join(other.alias("t"), "even").where("NOT (s.box <=> t.box AND s.day <=> t.day)")
        names = [name for name in source.columns if name != "even"]
        plain = pairs.agg(*[F.count_if(F.expr(f"NOT (s.{name} <=> t.{name})")).alias(name) for name in names]).first().asDict()
        assert found == plain
        assert "distinct_rows" not in stored and ("ambiguous_digests" in stored) is looked_into


def test_listed_rows_are_joined_by_numbers_first(spark):
    rows = spark.range(40).selectExpr("id % 2 AS shelf", "id AS digest", "id * 2 AS high")
    listed = compare(rows, rows.where("digest > 3"), "shelf").matched("rows")
    assert {(r.source.digest, r.source.high) for r in listed.where("side = 'source'").collect()} == {(n, 2 * n) for n in range(40)}
    for keys in re.findall(r"HashAggregate\(keys=\[([^\]]*)\], functions=\[sum\(source_rows", plan_of(listed)):
        assert keys.startswith("high")
