import hashlib
import random

import pytest
from pyspark.sql import functions as F

from evenkeel.llm import fingerprints

SCHEMA = "doc_id long, text string, stretch int, held string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return text.translate(UPPER).replace("\t", " ").replace("\n", " ").replace("\x0c", " ").split(" ")


def shingle_set(text):
    words = [w for w in words_of(text) if w]
    width = min(5, len(words))
    return {tuple(words[n : n + width]) for n in range(len(words) - width + 1)} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for n, (doc_id, text) in enumerate(order):
        following = order[(n + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        sets = [shingle_set(x) for x in (text, edited, following)]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), jaccard(sets[0], sets[1]), jaccard(sets[0], sets[2]), len(sets[0])))
    return sorted(out, key=repr)


def found(spark, rows):
    frame = spark.createDataFrame([(*row, 1, "x") for row in rows], SCHEMA)
    out = fingerprints.fingerprint_documents(frame.repartition(3)).collect()
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next, r.n_shingles, r.fingerprint) for r in out), key=repr)


def sample(count=150, longest=100):
    rng = random.Random(6)
    words = ["é", "😀", *(f"W{n}" for n in range(300))]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, longest))) for _ in range(count)]
    return [(n * 3, text) for n, text in enumerate(texts)]


def test_exact_while_sets_fit_into_the_sketch(spark):
    rows = sample(150, 60)
    out, wanted = found(spark, rows), brute(rows)
    for a, b in zip(out, wanted, strict=True):
        assert a[:3] == b[:3] and a[3:6] == pytest.approx(b[3:6])


def test_estimates_for_long_texts(spark):
    rows = sample(80, 1_500)
    out, wanted = found(spark, rows), brute(rows)
    assert [a[:3] for a in out] == [b[:3] for b in wanted]
    assert max(abs(a[3] - b[3]) for a, b in zip(out, wanted, strict=True)) < 0.2
    assert sum(abs(a[3] - b[3]) for a, b in zip(out, wanted, strict=True)) / len(out) < 0.05
    assert sum(abs(a[5] / max(1, b[5]) - 1) for a, b in zip(out, wanted, strict=True)) / len(out) < 0.1


def test_edge_cases(spark):
    rows = [(None, "a b c"), (None, None), (5, "x y z u v w"), (5, "x y z u v w"), (5, "A"), (-7, ""), (9, "long " * 40_000), (10, "\t\n")]
    out, wanted = found(spark, rows), brute(rows)
    for a, b in zip(out, wanted, strict=True):
        assert a[:3] == b[:3] and a[3:6] == pytest.approx(b[3:6])
    same = [a[6] for a in out if a[0] == 5 and a[1] == 11]
    assert same[0] == same[1]
    assert found(spark, []) == []
    assert [row[3:5] for row in found(spark, [(1, "one two")])] == [(brute([(1, "one two")])[0][3], 1.0)]


def test_many_stretches(spark):
    rows = [(n * n, f"text {n} of some words {n % 7} in it") for n in range(400)]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = found(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert [row[:3] for row in out] == [row[:3] for row in brute(rows)]


def test_merged_parts_are_the_sketch_of_the_whole(spark):
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(200)}" for _ in range(120)) for _ in range(30)]
    frame = spark.createDataFrame([(n % 3, text) for n, text in enumerate(texts)], "part int, text string")
    parts = frame.select("part", fingerprints.sketch(F.col("text")).alias("held"))
    whole = frame.groupBy("part").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(fingerprints.shingles(F.col("text")))))).alias("all"))
    merged = fingerprints.merged(parts, "held", "part").join(whole, "part").select("held", F.slice("all", 1, 128)).collect()
    assert len(merged) == 3 and all(row[0] == row[1] for row in merged)
    two = parts.limit(2).agg(F.collect_list("held").alias("x")).select(fingerprints.merge(F.col("x")[0], F.col("x")[1]).alias("m"), "x").first()
    assert two.m == sorted(set(two.x[0]) | set(two.x[1]))[:128]
