import math
import random

import numpy as np
import pytest

from evenkeel.llm import quantize

SCHEMA = "label int, vec_id long, embedding array<float>, code string, n long"


def brute(rows, entries):
    """Every part of every vector against every entry, in whole numbers of Python."""
    kept = []
    for vec_id, vector, label in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, [math.floor(1024 * float(np.float32(x))) for x in vector], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[v[p * len(v) // 4 : (p + 1) * len(v) // 4] for p in range(4)] for _, v, _ in kept]
    books = [[list(parts[p]) for parts in cut[:entries]] for p in range(4)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), n) for n, entry in enumerate(book))

    for _ in range(4):
        for p in range(4):
            held = {}
            for parts in cut:
                held.setdefault(nearest(parts[p], books[p])[1], []).append(parts[p])
            for n, members in held.items():
                books[p][n] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    found = [[nearest(parts[p], books[p]) for p in range(4)] for parts in cut]
    out = [(r[0], "".join(f"{n:02x}" for _, n in f), sum(d for d, _ in f), r[2]) for r, f in zip(kept, found, strict=True)]
    return sorted(((i, c, e, sum(x[2] for x in out if x[3] == l)) for i, c, e, l in out), key=repr), books


def found(spark, rows, entries):
    frame = spark.createDataFrame([(label, vec_id, vector, "x", 1) for vec_id, vector, label in rows], SCHEMA).repartition(3)
    out, books = quantize.product_codes(frame, entries=entries)
    out = quantize.with_label_error(out).select("vec_id", "code", "error", "label_error").collect()
    return sorted(map(tuple, out), key=repr), [book.tolist() for book in books]


def sample(count, size, seed, spread=0.02):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(6)]
    return [(n * 7 % 1009, [x + rng.gauss(0, spread) for x in rng.choice(centres)], rng.choice([None, 1, 2])) for n in range(count)]


@pytest.mark.parametrize("spread", [0.0, 0.02, 1.0])
def test_same_as_comparing_all(spark, spread, monkeypatch):
    monkeypatch.setattr(quantize, "HOT_ROWS", 40)
    rows = sample(300, 8, 5, spread)
    assert found(spark, rows, 16) == brute(rows, 16)


def test_edge_cases(spark):
    whole = [0.5, -0.25, 0.0, 1.0]
    rows = [(1, None, 1), (2, [0.1, None, 0.2, 0.3], 1), (3, [0.1, float("nan"), 0.2, 0.3], None), (4, [float("-inf"), 0.0, 0.0, 0.0], 2)]
    assert found(spark, rows, 256) == ([], [])
    rows += [(None, whole, None), (9, whole, None), (9, whole, None), (5, [-0.0001, 0.0001, -1.0, 30_000.0], 3)]
    assert found(spark, rows, 256) == brute(rows, 256)
    with pytest.raises(ValueError, match="one length"):
        found(spark, [(1, [0.0] * 4, 1), (2, [0.0] * 8, 1)], 4)
    with pytest.raises(ValueError, match="one length"):
        found(spark, [(1, [], 1)], 4)


def test_whole_subtrees_are_assigned():
    rng = np.random.default_rng(4)
    centres = rng.integers(-9000, 9000, (5, 6))
    points = centres[rng.integers(0, 5, 1500)] + rng.integers(-40, 40, (1500, 6))
    tree = quantize.CoverTree.build(points)
    ranges = []
    tree.assign(centres, lambda start, end, entry: ranges.extend(zip(start, end, strict=True)))
    assert len(ranges) < 60 and sorted(n for start, end in ranges for n in range(start, end)) == list(range(1500))
    for n, (start, end, first, past) in enumerate(tree.nodes):
        far = np.sqrt(((tree.points[start:end] - tree.points[start]) ** 2).sum(1))
        assert far.max() <= tree.radius[n]
        if past > first:
            heads = tree.points[tree.nodes[first:past, 0]]
            apart = np.sqrt(((heads[:, None] - heads[None]) ** 2).sum(2))
            assert apart[~np.eye(len(heads), dtype=bool)].min(initial=np.inf) > tree.radius[n] / quantize.BASE
            assert tree.nodes[first:past, 0].min() == start and tree.nodes[first:past, 1].max() == end


def test_large_components_are_exact():
    rng = np.random.default_rng(2)
    points, entries = rng.integers(-(2**26) + 1, 2**26, (50, 16)), rng.integers(-(2**26) + 1, 2**26, (9, 16))
    assert quantize.squared(points, entries).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, e, strict=True)) for e in entries] for p in points]
