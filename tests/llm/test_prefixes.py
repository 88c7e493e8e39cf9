import hashlib
import random
import zlib

import pytest

from evenkeel.llm import prefixes

SCHEMA = "turn long, conv_id long, role string, text string, depth int, name string, token string"


def brute(rows):
    held = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            held.setdefault(conv, []).append((turn is not None, turn or 0, (role or "", text or "")))
    own = {conv: [x[2] for x in sorted(turns, key=lambda x: x[:2])] for conv, turns in held.items()}
    nodes = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        family = conv - (abs(conv) % 100) * (1 if conv >= 0 else -1)
        path = tuple(own.get(family, [])[:h] + turns[h:])
        for depth in range(len(path) + 1):
            nodes.setdefault(path[:depth], []).append((conv, len(path) == depth))
    out = []
    for path, convs in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        children = sum(len(p) == len(path) + 1 for p in below)
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below)
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(map(str, sorted(c for c, end in convs if end)))
        parent = min(c for c, _ in nodes[path[:-1]]) if path else None
        out.append((min(c for c, _ in convs), len(path), parent, len(convs), children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows):
    frame = spark.createDataFrame([(t, c, r, x, 1, "n", "t") for c, t, r, x in rows], SCHEMA).repartition(3)
    return sorted((tuple(row) for row in prefixes.conversation_trie(frame, rebuilt=True).collect()), key=repr)


def sample(count, longest, seed, words="ab"):
    rng = random.Random(seed)
    ids = rng.sample(range(-150, 450), count)
    return [(c, n, rng.choice(["user", None]), rng.choice(words) * rng.randint(1, 2)) for c in ids for n in range(rng.randint(1, longest))]


@pytest.mark.parametrize("longest", [7, 40])
def test_random_tries(spark, longest):
    rows = sample(30, longest, longest)
    assert found(spark, rows) == brute(rows)


def test_copies_of_long_conversations(spark):
    rng = random.Random(3)
    turns = [(n, "user", rng.choice(["é", "😀x"])) for n in range(75)]
    rows = [(100 * c, *turn) for c in range(4) for turn in turns[: 75 - c // 3 * 11]] + [(205, 0, "user", "é")]
    assert found(spark, rows) == brute(rows)


def test_edge_cases(spark):
    rows = [(None, 1, "user", "x"), (7, None, None, None), (7, 0, "user", ""), (8, 5, "a", "long " * 50_000), (0, 1, "user", "x"), (0, 1, "user", "x")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_hot_children_and_id_texts(spark, monkeypatch):
    rows = [(100 * c, n, "u", f"{c % 3 if n else 0}") for c in range(60) for n in range(2)]
    monkeypatch.setattr(prefixes, "HOT_CHILDREN", 1)
    monkeypatch.setattr(prefixes, "ID_BITS", 9)
    assert found(spark, rows) == brute(rows)
