import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from evenkeel.llm import contamination

DOCS = "doc_id long, text string, items string, size string"
ITEMS = "item_id long, text string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    return [tuple(words[n : n + 5]) for n in range(len(words) - 4)]


def similarity(one, other):
    a, b = Counter(one), Counter(other)
    return sum((a & b).values()) / sum((a | b).values())


def best(text, item):
    """The best similarity of any item-sized window, all windows tried."""
    held, wanted = shingles(text), shingles(item)
    if not held or not wanted:
        return 0.0
    size = len(wanted)
    return max(similarity(held[n : n + size], wanted) for n in range(max(1, len(held) - size + 1)))


def judged(spark, docs, items, **options):
    frame = spark.createDataFrame([(*row, "x", "y") for row in docs], DOCS)
    bench = spark.createDataFrame(items, ITEMS)
    return contamination.judge(frame, bench), contamination.contaminated(frame, bench, **options)


def sample(seed=4):
    rng = random.Random(seed)
    words = [f"w{n}" for n in range(500)]
    items = [(n, " ".join(rng.choice(words) for _ in range(rng.randint(3, 60)))) for n in range(40)]
    docs = []
    for n in range(160):
        parts = [rng.choice(words) for _ in range(rng.randint(0, 150))]
        if n % 2:
            passage = rng.choice(items)[1].split()
            kind = n % 10
            if kind == 3:
                passage = passage[: len(passage) * 2 // 3]
            if kind == 5:
                passage[rng.randrange(len(passage))] = "changed"
            if kind == 7:
                del passage[-2:]
            if kind == 9:
                passage = [w.upper() + "," for w in passage]
            at = rng.randint(0, len(parts))
            parts[at:at] = passage
        docs.append((n, " ".join(parts)))
    return docs, items


def test_against_all_windows(spark):
    docs, items = sample()
    out = {row.doc_id: row for row in judged(spark, docs, items)[0].collect()}
    assert len(out) == len(docs)
    for doc_id, text in docs:
        wanted = {item: best(text, passage) for item, passage in items}
        sure = {item for item, value in wanted.items() if value >= 0.9}
        near = {item for item, value in wanted.items() if value >= 0.8}
        assert sure <= set(out[doc_id].items) <= near
        assert out[doc_id].contaminated == bool(out[doc_id].items) and out[doc_id].n_items == len(out[doc_id].items)
        if sure:
            assert out[doc_id].similarity == pytest.approx(max(wanted.values()))


def test_benchmark_in_several_parts(spark):
    docs, items = sample(7)
    whole, _ = judged(spark, docs, items)
    _, parts = judged(spark, docs, items, broadcast_shingles=100)
    found = {(row.doc_id, row.item) for row in parts.collect()}
    assert found == {(row.doc_id, item) for row in whole.collect() for item in row.items} and found


def test_all_pairs_within_the_radius_are_found(spark):
    rng = random.Random(3)
    prints = [rng.getrandbits(64) - 2**63 for _ in range(60)]
    windows = []
    for n, base in enumerate(prints):
        for bits in (0, 1, 5, 10, 14, 15, 16, 20):
            mask = sum(1 << bit for bit in rng.sample(range(64), bits))
            value = (base ^ mask) & (2**64 - 1)
            windows.append((n * 100 + bits, 7, value - 2**64 if value >= 2**63 else value))
    items = spark.createDataFrame([(n, 7 + n % 2, value) for n, value in enumerate(prints)], "item long, size int, item_print long")
    frame = spark.createDataFrame(windows, "window long, size int, print long")
    found = sorted((row.window, row.item) for row in contamination.near_items(frame, items).collect())
    wanted = sorted(
        (window, item) for window, _, value in windows for item, base in enumerate(prints)
        if item % 2 == 0 and bin((value ^ base) & (2**64 - 1)).count("1") <= contamination.RADIUS
    )
    assert found == wanted


def test_bag_similarity(spark):
    rng = random.Random(1)
    pairs = [([rng.randrange(9) for _ in range(rng.randint(1, 12))], [rng.randrange(9) for _ in range(rng.randint(1, 12))]) for _ in range(200)]
    frame = spark.createDataFrame(pairs, "a array<long>, b array<long>")
    for row in frame.select("a", "b", contamination.bag_similarity(F.col("a"), F.col("b")).alias("s")).collect():
        assert row.s == pytest.approx(similarity(row.a, row.b))


def test_edge_cases(spark):
    item = "one two three four five six seven eight nine ten"
    items = [(1, item), (2, None), (3, ""), (4, "too few words"), (5, "a a a a a a a a"), (1, item)]
    docs = [(None, item), (None, "clean words only here and now"), (1, item), (1, "other text under the same id here"), (2, None), (3, ""),
            (4, "a " * 9), (5, "four five six seven eight nine"), (6, ("filler " * 30_000) + item), (7, "one two"), (1, item)]
    out = judged(spark, docs, items)[0].collect()
    hits = sorted(((row.doc_id, row.items) for row in out if row.contaminated), key=repr)
    assert len(out) == len(docs)
    assert hits == sorted([(None, [1]), (1, [1]), (1, [1]), (4, [5]), (6, [1])], key=repr)
    assert judged(spark, [], items)[0].count() == 0
    assert [row.contaminated for row in judged(spark, docs[:1], [])[0].collect()] == [False]


def test_items_without_an_id_count(spark):
    one, other = "one two three four five six seven eight nine ten", "red orange yellow green blue indigo violet black white"
    docs = [(1, one), (2, f"before it {other} and after"), (3, f"{one} {other}"), (4, "clean words only here and now")]
    out = judged(spark, docs, [(None, one), (None, other), (7, other)])[0].orderBy("doc_id").collect()
    assert [(r.contaminated, r.n_items, r["items"]) for r in out] == [(True, 1, []), (True, 2, [7]), (True, 2, [7]), (False, 0, [])]


def test_stage_drops_contaminated_rows_only(spark, tmp_path):
    docs, items = sample()
    spark.createDataFrame(items, ITEMS).write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = spark.createDataFrame([(*row, "x", "y") for row in docs], DOCS)
    kept = contamination.drop_contaminated(spark, frame, str(tmp_path))
    clean = {row.doc_id for row in judged(spark, docs, items)[0].where("not contaminated").collect()}
    assert kept.columns == frame.columns and {row.doc_id for row in kept.collect()} == clean and len(clean) < len(docs)
