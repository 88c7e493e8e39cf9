import math
import random
import uuid
from collections import Counter
from itertools import product

import pytest
from pyspark.sql import functions as F

from evenkeel import Options, compare

TIGHT = Options(pair_rows=1, hot_rows=1, broadcast_bytes=0)
HOT = Options(hot_rows=2, broadcast_bytes=0)
HOT_SMALL = Options(pair_rows=2, hot_rows=2)


def numbers(comparison):
    row = comparison.metrics().first().asDict()
    return {name: value if isinstance(value, bool) else int(value) for name, value in row.items()}


def found(comparison):
    return {r.column_name: int(r.differences) for r in comparison.column_differences().collect()}


def test_a_table_against_itself(spark):
    df = spark.range(40).selectExpr("id AS shelf", "concat('box ', id % 7) AS content", "id * 1.5 AS weight")
    comparison = compare(df, df, "shelf")
    assert numbers(comparison) == {
        "source_rows": 40, "target_rows": 40, "source_only": 0, "target_only": 0, "matched": 40, "changed": 0,
        "common_columns": 3, "differing_columns": 0, "is_match": True,
    }
    assert comparison.verdict().first().is_match is True
    assert comparison.changed().count() == comparison.changed("rows").count() == 0


def test_lost_gained_and_altered_rows(spark):
    source = spark.range(12).selectExpr("CAST(id AS INT) AS SHELF", "concat('box ', id) AS Content", "CAST(id AS INT) AS WEIGHT")
    target = spark.range(3, 14).selectExpr(
        "id AS shelf", "IF(id = 5, 'crate', concat('box ', id)) AS content", "IF(id IN (5, 8), -id, id) AS weight"
    )
    comparison = compare(source, target, "Shelf")
    got = numbers(comparison)
    assert (got["source_rows"], got["target_rows"], got["source_only"], got["target_only"]) == (12, 11, 3, 2)
    assert got["differing_columns"] == 2 and found(comparison) == {"content": 1, "weight": 2} and not got["is_match"]
    assert sorted(r.shelf for r in comparison.source_only().collect()) == [0, 1, 2]
    assert sorted(r.shelf for r in comparison.target_only().collect()) == [12, 13]
    pairs = {r.source.shelf: (r.source.weight, r.target.weight) for r in comparison.changed().collect()}
    assert pairs == {5: (5, -5), 8: (8, -8)}
    statuses = {r.status: r["count"] for r in comparison.classified().groupBy("status").count().collect()}
    assert statuses == {"equal": 7, "changed": 2, "source_only": 3, "target_only": 2}


def test_columns_of_one_side_only(spark):
    source = spark.range(4).selectExpr("id AS shelf", "'a' AS content", "id AS weight")
    target = spark.range(4).selectExpr("id AS shelf", "'a' AS content", "'north' AS hall")
    comparison = compare(source, target, "shelf")
    assert comparison.columns.common == ("content", "shelf")
    assert comparison.columns.source_only == ("weight",) and comparison.columns.target_only == ("hall",)
    got = numbers(comparison)
    assert got["changed"] == 4 and got["differing_columns"] == 0 and got["is_match"]
    assert numbers(compare(source, target, "shelf", Options(digest_columns="common")))["changed"] == 0


def test_missing_value_against_a_value(spark):
    source = spark.range(3).selectExpr("CAST(id AS INT) AS shelf", "IF(id = 1, NULL, 'lid') AS cover")
    target = spark.range(3).selectExpr("id AS shelf", "'lid' AS cover")
    assert found(compare(source, target, "shelf")) == {"cover": 1}


def test_null_and_empty_text_are_equal(spark):
    source = spark.createDataFrame([(1, None), (None, "x")], "id int, name string")
    target = spark.createDataFrame([(1, ""), (None, "x")], "id int, name string")
    got = numbers(compare(source, target, "id"))
    assert got["matched"] == 2 and got["is_match"]


def test_key_modes(spark):
    source = spark.createDataFrame([(1, None, "a")], "k1 int, k2 int, v string")
    target = spark.createDataFrame([(None, 1, "a")], "k1 bigint, k2 int, v string")
    assert numbers(compare(source, target, "k1,k2"))["matched"] == 1
    typed = numbers(compare(source, target, "k1,k2", Options(key_mode="typed")))
    assert (typed["matched"], typed["source_only"], typed["target_only"]) == (0, 1, 1)
    same = numbers(compare(source, source, "k1,k2", Options(key_mode="typed")))
    assert same["matched"] == 1 and same["is_match"]
    with pytest.raises(ValueError, match="same kind of type"):
        compare(source, source.withColumn("k1", F.lit("x")), "k1", Options(key_mode="typed"))


def test_separator_collision(spark):
    source = spark.createDataFrame([(1, "p||q", "r")], "id int, a string, b string")
    target = spark.createDataFrame([(1, "p", "q||r")], "id int, a string, b string")
    assert numbers(compare(source, target, "id"))["changed"] == 0
    assert numbers(compare(source, target, "id", Options(digest="safe")))["changed"] == 1


def test_equal_values_with_other_digest(spark):
    source = spark.sql("select 1 as id, cast(100 as decimal(10,2)) as v")
    target = spark.sql("select 1 as id, 100 as v")
    got = numbers(compare(source, target, "id"))
    assert got["changed"] == 1 and got["differing_columns"] == 0 and got["is_match"]
    null_number = spark.sql("select 1 as id, cast(null as int) as v")
    empty_text = spark.sql("select 1 as id, '' as v")
    assert numbers(compare(null_number, empty_text, "id"))["changed"] == 0


def test_text_against_number(spark):
    source = spark.createDataFrame([(1, 5), (2, 5), (3, 5), (4, None)], "id int, v int")
    target = spark.createDataFrame([(1, "5"), (2, "05"), (3, "five"), (4, "x")], "id int, v string")
    comparison = compare(source, target, "id")
    assert numbers(comparison)["changed"] == 3 and found(comparison) == {"v": 2}


def test_key_only_table(spark):
    source = spark.createDataFrame([(1,), (2,)], "id int")
    got = numbers(compare(source, source.where("id = 1"), "id"))
    assert (got["matched"], got["changed"], got["source_only"], got["differing_columns"]) == (1, 0, 1, 0)


def test_empty_sides(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    none = df.where("id > 1")
    assert numbers(compare(none, none, "id"))["is_match"]
    assert numbers(compare(df, none, "id"))["source_only"] == 1
    assert compare(none, df, "id").target_only().count() == 1
    assert compare(none, none, "id").counts().first().source_rows == 0


def test_duplicate_keys_multiply(spark):
    source = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    target = spark.createDataFrame([(1, "a"), (1, "a"), (1, "c")], "id int, v string")
    comparison = compare(source, target, "id")
    got = numbers(comparison)
    assert (got["matched"], got["changed"]) == (6, 4) and found(comparison) == {"v": 4}
    assert comparison.matched().count() == 6 and comparison.changed().count() == 4
    for options in (Options(), TIGHT, HOT):
        listed = compare(source, target, "id", options)
        assert numbers(listed)["matched"] == 6 and found(listed) == {"v": 4}
        assert listed.matched().count() == 6 and listed.changed().count() == 4
        rows = Counter(
            (r.side, (r.source or r.target).v, r.partners, r.unequal_partners) for r in listed.changed("rows").collect()
        )
        assert rows == {("source", "a", 3, 1): 1, ("source", "b", 3, 3): 1, ("target", "a", 2, 1): 2, ("target", "c", 2, 2): 1}
    with pytest.raises(ValueError, match="layout"):
        comparison.matched("columns")


@pytest.mark.parametrize("rows", [16, 17, 300])
def test_layouts_are_the_same_for_any_number_of_rows(spark, rows):
    source = spark.range(rows).selectExpr("1 AS id", "id % 4 AS v")
    target = spark.range(rows).selectExpr("1 AS id", "IF(id = 0, 9, id % 4) AS v")
    comparison = compare(source, target, "id")
    per_value = Counter(n % 4 for n in range(rows))
    other = per_value + Counter({9: 1})
    other[0] -= 1
    same = sum(n * other[v] for v, n in per_value.items())
    pairs = comparison.changed()
    assert pairs.columns == ["_composite_key", "source", "target"]
    assert pairs.count() == rows * rows - same and comparison.matched().count() == rows * rows
    statuses = {r.status: r["count"] for r in comparison.classified().groupBy("status").count().collect()}
    assert statuses == {"equal": same, "changed": rows * rows - same}
    listed = comparison.changed("rows").collect()
    assert len(listed) == 2 * rows and all(r.partners == rows for r in listed)
    assert all(r.unequal_partners == rows - (other[r.source.v] if r.side == "source" else per_value[r.target.v]) for r in listed)
    by_row = {r.status: r["count"] for r in comparison.classified("rows").groupBy("status").count().collect()}
    assert by_row == {"changed": 2 * rows}


def test_equal_digests_of_unequal_rows_in_crowded_keys(spark):
    rows = [(1, "p||q", "r"), (1, "p", "q||r"), (1, "p||q", "r"), (1, "x", "r")]
    source = spark.createDataFrame(rows, "id int, a string, b string")
    target = spark.createDataFrame([(1, "p", "q||r"), (1, "p", "q||r"), (1, "y", "r")], "id int, a string, b string")
    expected = {"a": 6, "b": 3}  # of 12 pairs, 6 have equal digests
    assert found(compare(source, target, "id")) == expected
    assert found(compare(source, target, "id", TIGHT)) == expected


# every rule against the plain definition, pair by pair, on random tables

FIELDS = ("k1", "k2", "a", "b", "c", "m")
SOURCE_SCHEMA = "k1 int, k2 string, a int, b string, c double, m string, only_s string"
TARGET_SCHEMA = "k1 bigint, k2 string, a bigint, b string, c double, m int"


def random_rows(rng, count, target):
    hot = rng.random() < 0.7
    made = []
    for _ in range(count):
        k1 = 7 if hot and rng.random() < 0.4 else rng.choice([1, 2, 3, 4, 5, 6, None])
        row = [
            k1,
            rng.choice(["x", "x", "x", "NaN", None, "y"]),
            rng.choice([1, 2, None]),
            rng.choice(["p", "q", "", None, "p||", " nan "]),
            rng.choice([0.5, 0.0, -0.0, float("nan"), None]),
        ]
        row.append(rng.choice([1, 2, None]) if target else rng.choice(["1", "2", "01", "z", None]))
        made.append(tuple(row) if target else (*row, "s"))
    if made and rng.random() < 0.6:
        made += [rng.choice(made)] * 6  # copies of one row
    return made


def text(value):
    if value is None:
        return ""
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else str(value)
    return str(value)


def cleaned(value):
    if isinstance(value, str) and value.strip().lower() == "nan":
        return ""
    return value


def prepared(rows, names, texts):
    out = []
    for row in rows:
        record = {n: cleaned("" if v is None and n in texts else v) for n, v in zip(names, row)}
        key = "||".join(text(record[n]) for n in ("k1", "k2") if record[n] is not None)
        digest = "||".join(text(record[n]) for n in sorted(names) if n not in ("k1", "k2"))
        out.append((key, digest, record))
    return out


def unequal(name, left, right):
    if name == "m":  # text against number
        if left.strip().lstrip("0").isdigit():
            return int(left) != right
        return True
    if isinstance(left, float) and isinstance(right, float):
        return not (left == right or (math.isnan(left) and math.isnan(right)))
    return left != right


def copied(rng, source):
    """Some source rows as the target holds them: same digest where the text survives."""
    picked = rng.sample(source, len(source) // 2)
    return [(*row[:5], int(row[5]) if row[5] and row[5].isdigit() else None) for row in picked]


def by_definition(source, target, names):
    left = prepared(source, names, {"k2", "b", "m", "only_s"})
    right = prepared(target, FIELDS, {"k2", "b"})
    left_keys, right_keys = {k for k, _, _ in left}, {k for k, _, _ in right}
    pairs = [(s, t) for s, t in product(left, right) if s[0] == t[0]]
    changed = [(s, t) for s, t in pairs if s[1] != t[1]]
    differing = Counter(n for s, t in changed for n in ("a", "b", "c", "m") if unequal(n, s[2][n], t[2][n]))
    return {
        "source_rows": len(left), "target_rows": len(right),
        "source_only": sum(k not in right_keys for k, _, _ in left),
        "target_only": sum(k not in left_keys for k, _, _ in right),
        "matched": len(pairs), "changed": len(changed),
        "common_columns": 6, "differing_columns": len(differing),
        "is_match": left_keys == right_keys and not differing,
    }, dict(differing), changed


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("options", [Options(), TIGHT, HOT, HOT_SMALL], ids=["default", "tight", "hot", "hot_small"])
def test_against_definition(spark, seed, options):
    rng = random.Random(seed)
    source = random_rows(rng, rng.choice([8, 25]), target=False)
    target = random_rows(rng, rng.choice([8, 25]), target=True) + copied(rng, source)
    names = (*FIELDS, "only_s") if seed == 0 else FIELDS
    source = [row[: len(names)] for row in source]
    expected, differing, changed = by_definition(source, target, names)
    frame = spark.createDataFrame(source, ", ".join(SOURCE_SCHEMA.split(", ")[: len(names)]))
    comparison = compare(frame, spark.createDataFrame(target, TARGET_SCHEMA), "k1,k2", options)
    lazily = {n: int(v) for n, v in comparison.counts().first().asDict().items()}
    assert lazily == {n: expected[n] for n in lazily}
    assert numbers(comparison) == expected
    assert found(comparison) == differing
    if seed:
        assert 0 < expected["changed"] < expected["matched"]
    assert comparison.source_only().count() == expected["source_only"]
    assert comparison.target_only().count() == expected["target_only"]
    statuses = Counter(r.status for r in comparison.classified().collect())
    assert statuses["source_only"] == expected["source_only"] and statuses["target_only"] == expected["target_only"]
    assert comparison.changed().count() == expected["changed"]
    assert comparison.matched().count() == expected["matched"]
    assert statuses["changed"] == expected["changed"] and statuses["equal"] == expected["matched"] - expected["changed"]
    pairs = [(r.source, r.target) for r in comparison.changed().collect()]
    got = Counter((text(s.a), s.b, text(t.a), t.b) for s, t in pairs)
    assert got == Counter((text(s[2]["a"]), s[2]["b"], text(t[2]["a"]), t[2]["b"]) for s, t in changed)
    listed = Counter((r.side, r._composite_key, (r.source or r.target)._row_hash, r.partners, r.unequal_partners)
                     for r in comparison.matched("rows").collect())
    assert sum(n * unequal for (side, _, _, _, unequal), n in listed.items() if side == "source") == expected["changed"]
    assert sum(n * partners for (side, _, _, partners, _), n in listed.items() if side == "target") == expected["matched"]
    assert Counter({k: n for k, n in listed.items() if k[4]}) == Counter(
        (r.side, r._composite_key, (r.source or r.target)._row_hash, r.partners, r.unequal_partners)
        for r in comparison.changed("rows").collect()
    )
    comparison.close()


# fixed pairs on the given tables

F1 = """
select o_orderkey, o_custkey,
       case when o_orderkey % 41 = 0 then null else o_orderstatus end as o_orderstatus,
       case when o_orderkey % 53 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice,
       o_orderdate,
       case when o_orderkey % 59 = 0 then 'X-CHANGED' else o_orderpriority end as o_orderpriority
from {orders} where o_orderkey % 97 <> 0
union all
select o_orderkey + 100000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
from {orders} where o_orderkey % 89 = 0
"""
F1_NUMBERS = {
    "sf0.001": ((1500, 1501, 16, 17, 1484, 89), (36, 28, 25)),
    "sf0.01": ((15000, 15014, 155, 169, 14845, 879), (362, 281, 252)),
    "sf0.1": ((150000, 150139, 1547, 1686, 148453, 8761), (3621, 2801, 2516)),
}


@pytest.mark.parametrize("sf", F1_NUMBERS)
def test_orders_fixture(spark, sf):
    orders = spark.read.parquet(f"/root/testdata/{sf}/orders.parquet")
    comparison = compare(orders, spark.sql(F1, orders=orders), "o_orderkey")
    counts, columns = F1_NUMBERS[sf]
    assert tuple(int(v) for v in comparison.counts().first()) == counts
    assert found(comparison) == dict(zip(("o_orderstatus", "o_totalprice", "o_orderpriority"), columns))
    swapped = numbers(compare(spark.sql(F1, orders=orders), orders, "o_orderkey"))
    assert (swapped["source_only"], swapped["target_only"], swapped["changed"]) == (counts[3], counts[2], counts[5])
    assert counts[0] == counts[2] + counts[4] and counts[1] == counts[3] + counts[4]


def test_part_fixture(spark):
    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    target = spark.sql(
        """
        select p_partkey, p_name,
               case when p_partkey % 25 = 0 then '' when p_partkey % 37 = 0 then upper(p_brand) || '*' else p_brand end
                   as p_brand,
               p_type, case when p_partkey % 31 = 0 then p_size + 1 else p_size end as p_size, p_retailprice
        from {part} where p_partkey % 101 <> 0
        """,
        part=part,
    )
    comparison = compare(part, target, "p_partkey")
    got = numbers(comparison)
    assert (got["source_rows"], got["target_rows"], got["source_only"], got["changed"]) == (2000, 1980, 20, 192)
    assert found(comparison) == {"p_brand": 131, "p_size": 64}


def test_duplicate_key_fixture(spark):
    lineitem = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    for options in (Options(), Options(pair_rows=1, hot_rows=3, broadcast_bytes=0)):
        comparison = compare(lineitem, lineitem, "l_orderkey,l_linenumber", options)
        assert numbers(comparison)["matched"] == 93792
        assert comparison.key_counts().where("source_rows > 1").count() == 11785
        assert comparison.matched().count() == 93792
        assert comparison.matched("rows").count() == 2 * lineitem.count()


def test_numbers_that_need_more_than_38_digits_together(spark):
    source = spark.sql("select 1 as id, cast('12345678901234567.1' as decimal(38,18)) as v")
    target = spark.sql("select 1 as id, cast('12345678901234567.2' as decimal(38,10)) as v")
    assert not numbers(compare(source, target, "id"))["is_match"] and found(compare(source, target, "id", TIGHT)) == {"v": 1}
    same = spark.sql("select 1 as id, cast('12345678901234567.1' as decimal(38,10)) as v")
    got = numbers(compare(source, same, "id"))
    assert got["changed"] == 1 and got["is_match"]


def test_more_pairs_than_64_bits_hold(spark, monkeypatch):
    big = 5 * 10**9
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    comparison = compare(df, df, "id")
    records = spark.sql(f"""
        select '1' as _composite_key, false as plain, {big}L as source_rows, {big}L as target_rows,
               cast(0 as decimal(38,0)) as same_pairs, cast({big}L as decimal(19,0)) * {big}L as pairs""")
    records = records.withColumn("pairs", F.col("pairs").cast("decimal(38,0)"))
    monkeypatch.setitem(comparison.__dict__, "records", records)
    monkeypatch.setattr(comparison, "column_differences", lambda: spark.createDataFrame([("v", 1)], "column_name string, differences int"))
    row = comparison.metrics().first()
    assert int(row.matched) == int(row.changed) == big * big and row.is_match is False
    assert comparison.verdict().first().is_match is False and int(comparison.counts().first().matched) == big * big


def test_safe_digest_tells_nested_values_apart(spark):
    for one, other in (
        ("array('a, b')", "array('a', 'b')"),
        ("map('a', 'b, c -> d')", "map('a', 'b', 'c', 'd')"),
        ("named_struct('x', 'a, b', 'y', cast(null as string))", "named_struct('x', 'a', 'y', 'b')"),
    ):
        source, target = spark.sql(f"select 1 as id, {one} as v"), spark.sql(f"select 1 as id, {other} as v")
        assert numbers(compare(source, target, "id", Options(digest="safe")))["changed"] == 1
        assert numbers(compare(source, source, "id", Options(digest="safe")))["changed"] == 0
    maps = [spark.sql(f"select 1 as id, map({text}) as v") for text in ("'a', 1, 'b', 2", "'b', 2, 'a', 1")]
    assert numbers(compare(*maps, "id", Options(digest="safe")))["changed"] == 0
    assert numbers(compare(*maps, "id"))["changed"] == 0
    nulls = [spark.sql(f"select 1 as id, cast({text} as array<string>) as v") for text in ("null", "array()")]
    assert numbers(compare(*nulls, "id", Options(digest="safe")))["changed"] == 1


def test_what_was_written_is_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("evenkeel.plans.compare.shared_folder", lambda _: f"{tmp_path}/{uuid.uuid4().hex}")
    df = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    with compare(df, df, "id", TIGHT) as comparison:
        assert comparison.changed("rows").count() == 4 and comparison.metrics().count() == 1
        assert list(tmp_path.iterdir())
    assert not list(tmp_path.iterdir())
