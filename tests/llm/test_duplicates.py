import random
from collections import defaultdict

import pytest

from evenkeel.llm import duplicates

SCHEMA = "doc_id long, text string, lang string, node string, size long"


def brute_set(text, width):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    width = min(width, len(words))
    return {tuple(words[n : n + width]) for n in range(len(words) - width + 1)} if words else set()


def brute(rows, width, percent=80):
    sets = [brute_set(row[1], width) for row in rows]
    parent = list(range(len(rows)))

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                parent[root(a)] = root(b)
    groups = defaultdict(list)
    for n, row in enumerate(rows):
        groups[root(n)].append(row[0])
    named = {key: min((i for i in ids if i is not None), default=None) for key, ids in groups.items()}
    return sorted(((row[0], len(sets[n]), named[root(n)], row[0] == named[root(n)]) for n, row in enumerate(rows)), key=repr)


def found(spark, rows, width=4):
    frame = spark.createDataFrame([(*row, "x", "y", 1) for row in rows], SCHEMA)
    out = duplicates.near_duplicates(frame, width=width)
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out.collect()), key=repr)


def prose(rng, count, words):
    return [" ".join(rng.choice(words) for _ in range(rng.randint(1, 90))) for _ in range(count)]


def edited(rng, text, words, edits):
    parts = text.split()
    for _ in range(edits):
        parts[rng.randrange(len(parts))] = rng.choice(words)
    return " ".join(parts)


def test_against_brute_force(spark):
    rng = random.Random(11)
    words = [f"w{n}" for n in range(400)]
    texts = prose(rng, 150, words)
    hub = " ".join(rng.choice(words) for _ in range(120))
    texts += [edited(rng, hub, words, rng.randint(1, 7)) for _ in range(60)]  # similarities around 0.8
    texts += [edited(rng, rng.choice(texts), words, rng.randint(0, 2)) for _ in range(80)]
    texts += [hub] * 20 + [hub.upper()] * 3
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    assert found(spark, rows) == brute(rows, 4)


def test_a_chain_without_a_common_centre(spark):
    rng = random.Random(2)
    words = [f"w{n}" for n in range(5000)]
    text = [rng.choice(words) for _ in range(300)]
    rows = [(n, " ".join(text[n * 12 : n * 12 + 120])) for n in range(15)]  # each like its neighbour only
    assert found(spark, rows) == brute(rows, 4)
    assert {row[2] for row in found(spark, rows)} == {0}


def test_buckets_full_of_unlike_texts_are_searched_to_the_end(spark):
    rng = random.Random(5)
    words = [f"w{n}" for n in range(3000)]
    shared = [rng.choice(words) for _ in range(100)]
    rows = []
    for pair in range(25):  # all share a long passage at about 0.6; pairs are linked
        own = [rng.choice(words) for _ in range(38)]
        rows += [(100 + 2 * pair, " ".join(shared + own)), (101 + 2 * pair, " ".join(shared + own[:-3]))]
    assert found(spark, rows) == brute(rows, 4)
    assert len({row[2] for row in found(spark, rows)}) == 25


def test_a_large_group_around_the_threshold(spark):
    rng = random.Random(7)
    words = [f"w{n}" for n in range(5000)]
    base = [rng.choice(words) for _ in range(120)]
    texts = [edited(rng, " ".join(base), words, rng.randint(3, 11)) for _ in range(700)]  # most at 0.5 to 0.8
    texts += [edited(rng, rng.choice(texts), words, 1) for _ in range(100)]
    rows = list(enumerate(texts))
    assert found(spark, rows) == brute(rows, 4)


def test_rare_shingles_find_every_link_and_few_other_pairs(spark):
    rng = random.Random(8)
    words = [f"w{n}" for n in range(5000)]
    base = " ".join(rng.choice(words) for _ in range(150))
    texts = [edited(rng, base, words, 9) for _ in range(150)]  # around 0.6
    texts += [edited(rng, text, words, 2) for text in texts[:40]]
    sets = {f"{n:03}": {x.item() for x in duplicates.shingle_set(text, 4).view("int64")} for n, text in enumerate(texts)}
    links = {(a, b) for a in sets for b in sets if a > b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    flags = {name: duplicates.parity(duplicates.shingle_set(text, 4)).tolist() for name, text in zip(sets, texts, strict=True)}
    rows = [(name, sorted(held), flags[name]) for name, held in sets.items()]
    frame = spark.createDataFrame(rows, "node string, shingles array<long>, parity array<long>")
    nodes = frame.selectExpr("node", "node AS root")
    pairs = {tuple(row) for row in duplicates.by_rare_shingles(nodes, frame, 80).collect()}
    assert len(links) >= 40 and links <= pairs
    assert len(pairs) < len(sets) * (len(sets) - 1) / 20


def test_edge_cases(spark):
    long = "a b c d e f g h " * 20_000
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE\ttwo "), (None, "one two"), (None, None), (7, long),
            (8, long + "x"), (9, "one"), (9, "one"), (10, "é É"), (11, "é é"), (12, "one two three"), (12, "other words here now")]
    assert found(spark, rows) == brute(rows, 4)
    assert found(spark, []) == []


@pytest.mark.parametrize("size", [1, 2, 5, 40, 600])
def test_signature_agrees_as_often_as_the_sets_are_similar(size):
    rng = random.Random(size)
    agreed = total = 0
    for _ in range(60):
        one = " ".join(f"u{rng.random()}" for _ in range(size + 3))
        other = one.rsplit(" ", max(1, size // 6))[0] if size > 1 else one
        a, b = duplicates.shingle_set(one, 4), duplicates.shingle_set(other, 4)
        agreed += (duplicates.signature(a) == duplicates.signature(b)).sum()
        total += duplicates.BINS * len(set(a) & set(b)) / len(set(a) | set(b))
    assert abs(agreed / total - 1) < 0.08


def test_stage_keeps_one_row_of_each_group(spark):
    text = "some words that are the same in all of these documents here"
    rows = [(5, text), (3, text), (3, text), (None, text), (8, "different words " * 9), (9, None), (9, None), (None, "lone words in a row of their own"),
            (None, "lone words in a row of their own")]
    docs = spark.createDataFrame([(*row, "x", "y", 1) for row in rows], SCHEMA)
    kept = duplicates.keep_one_of_each(spark, docs, "")
    assert kept.columns == docs.columns
    wanted = [(3, text), (8, rows[4][1]), (9, None), (9, None), (None, rows[7][1])]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(wanted, key=repr)
