import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evenkeel.llm import scoring, trie
from evenkeel.llm.trie import EliasFano, TrieLevel, ranked

SCHEMA = "doc_id long, text string, held boolean, score string"


def tokens_of(text):
    return (text or "").encode().lower().split() + [b""]


def brute(rows, order, discount=scoring.DISCOUNT):
    """(n_tokens, n_known, N, base, score) by the formulas, one token at a time."""
    one, many = Counter(), [defaultdict(Counter) for _ in range(order + 1)]
    for _, text, held in rows:
        if not held:
            words = tokens_of(text)
            one.update(words)
            for at, word in enumerate(words):
                for k in range(2, order + 1):
                    many[k][tuple(([None] * k + words[:at])[-(k - 1) :])][word] += 1
    total, different = sum(one.values()), len(one)
    out = []
    for doc_id, text, held in rows:
        words = tokens_of(text)
        base = score = 0.0
        for at, word in enumerate(words):
            p = (one[word] + 0.5) / (total + 0.5 * (different + 1))
            base += math.log10(p)
            for k in range(2, order + 1):
                follow = many[k].get(tuple(([None] * k + words[:at])[-(k - 1) :]))
                if follow:
                    c = sum(follow.values())
                    p = max(follow[word] - discount, 0) / c + discount * len(follow) / c * p
            score += math.log10(p)
        out.append((doc_id, held, len(words), sum(one[w] > 0 for w in words), total, base, score))
    return sorted(out, key=repr)


def scored(spark, rows, **options):
    frame = spark.createDataFrame([(*row, "x") for row in rows], SCHEMA)
    out = scoring.score_documents(frame, ~F.col("held"), **options).collect()
    return sorted(((r.doc_id, not r.training, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in out), key=repr)


def same(found, wanted):
    assert len(found) == len(wanted)
    for a, b in zip(found, wanted, strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9)
        assert a[6] == pytest.approx(b[6], rel=5e-3, abs=0.05)  # quantised


def sample(count=120, seed=8):
    rng = random.Random(seed)
    words = ["the", "The", "é", "of", *(f"w{n}" for n in range(150))]
    weights = [40, 10, 10, 20, *(1 for _ in range(150))]
    return [(n, " ".join(rng.choices(words, weights, k=rng.randint(0, 60))), n % 5 == 1) for n in range(count)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_the_formulas(spark, order):
    rows = sample()
    same(scored(spark, rows, order=order, chunk_tokens=300, shard_chars=2_000), brute(rows, order))


def test_hot_contexts_dealt_by_word_give_the_same(spark, monkeypatch):
    rows = sample()
    monkeypatch.setattr(scoring, "HOT_COUNT", 30)
    same(scored(spark, rows, order=3, chunk_tokens=300, shard_chars=500), brute(rows, 3))


def test_edge_cases(spark):
    rows = [(1, None, False), (2, "", True), (None, "a b", False), (3, "A\tb\n", False), (3, "A\tb\n", False), (4, "zz " * 30_000, False), (5, "new", True)]
    same(scored(spark, rows), brute(rows, 2))
    assert scored(spark, []) == []
    same(scored(spark, [(1, "a b", True)]), brute([(1, "a b", True)], 2))


def test_held_out_text_is_likelier_than_by_single_words(spark):
    rng = random.Random(1)
    after = {w: [rng.choice(range(40)) for _ in range(3)] for w in range(40)}

    def walk():
        at, out = rng.randrange(40), []
        for _ in range(60):
            out.append(f"w{at}")
            at = rng.choice(after[at])
        return " ".join(out)

    found = scored(spark, [(n, walk(), n % 5 == 1) for n in range(200)])
    held = [row for row in found if row[1]]
    assert all(row[6] > row[5] for row in held) and sum(r[6] for r in held) > 0.5 * sum(r[5] for r in held)


@pytest.mark.parametrize("universe", [10, 3_000, 2**40, 2**64])
def test_sequence_round_trip_and_search(universe):
    rng = np.random.default_rng(universe % 97)
    for size in (0, 1, 5, 511, 512, 513, 3_000):
        values = np.unique(rng.integers(0, universe, size, dtype=np.uint64, endpoint=False))
        held = EliasFano(EliasFano.build(values))
        assert (held.slice(0, len(values)) == values).all()
        for begin in (0, len(values) // 3, len(values) // 2 + 1):
            assert (held.slice(begin, begin + 700) == values[begin : begin + 700]).all()
        asked = np.unique(np.concatenate([values[::3], rng.integers(0, universe, 200, dtype=np.uint64, endpoint=False)]))
        wanted = {int(v): n for n, v in enumerate(values)}
        assert held.find(asked).tolist() == [wanted.get(int(v), -1) for v in asked]


def test_repeated_values_and_size():
    values = np.sort(np.random.default_rng(3).integers(0, 500, 20_000)).astype(np.uint64)
    words = EliasFano.build(values)
    assert (EliasFano(words).slice(0, 20_000) == values).all() and words.nbytes < 20_000 / 2


def test_level_is_searched_in_a_mapped_file(tmp_path):
    rng = np.random.default_rng(5)
    pairs = np.unique(rng.integers(0, 300, (5_000, 2)).astype(np.uint64) * np.uint64(2**55 + 12345), axis=0)
    counts = rng.integers(1, 5_000, len(pairs))
    path = tmp_path / "level"
    path.write_bytes(TrieLevel.build(pairs[:, 0], pairs[:, 1], counts, 0.75, exact=False))
    level = TrieLevel.open(str(path))
    contexts, place = np.unique(pairs[:, 0], return_inverse=True)
    number, totals, kinds = level.find_contexts(contexts)
    assert (totals == np.bincount(place, counts)).all() and (kinds == np.bincount(place)).all()
    found = level.find(number[place], pairs[:, 1])
    logs = level.low + (level.values[found].astype(float) - 1) * level.step
    assert np.abs(logs - np.log10((counts - 0.75) / totals[place])).max() <= level.step / 2 + 1e-9
    assert (level.find(number[place], pairs[:, 1] + np.uint64(1)) == -1).all()


def test_registered_scores_depend_on_two_words_before(spark, tmp_path):
    rows = [(n, text, zlib.crc32(str(n).encode()) % 5 == 1) for n, text, _ in sample()]
    spark.createDataFrame([row[:2] for row in rows], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = sorted((tuple(row) for row in scoring.language_model_scores(spark, str(tmp_path)).collect()), key=repr)
    same(out, brute(rows, 3))


def test_n_grams_of_a_chunk_cut_from_slices_without_sorts_by_two_keys(monkeypatch):
    rows = [(n, None if n == 7 else f" {text}\t" if n % 9 == 0 else text, not held) for n, text, held in sample(60)]
    batch = pa.RecordBatch.from_pydict({"doc_id": [n for n, *_ in rows], "text": [x for _, x, _ in rows], "training": [t for *_, t in rows]})

    def slow(*_):
        raise AssertionError("sorted by two keys")

    monkeypatch.setattr(np, "lexsort", slow)
    ids, chunk = scoring._cut([batch.slice(3, 2), batch.slice(11, 40)])
    rows = rows[3:5] + rows[11:51]
    assert ids == [n for n, *_ in rows]
    for order, (contexts, words, counts, place) in enumerate(chunk.levels(3), 1):
        wanted, held = Counter(), []
        for _, text, training in rows:
            spelt = [b" "] * order + tokens_of(text)
            first = order - 1 if order == 1 else order  # only order 1 counts the beginning
            for at in range(first, len(spelt)):
                held.append(tuple(spelt[at - order + 1 : at + 1]))
                wanted[held[-1]] += training
        assert len(words) == len(wanted) and len(set(zip(contexts.tolist(), words.tolist(), strict=True))) == len(words)
        assert counts[place].tolist() == [wanted[gram] for gram in held]
        assert scoring.starts(contexts).sum() == len({gram[:-1] for gram in wanted})
    asks = scoring._messages([scoring._message("ask", "0-0", 0, scoring._asked(contexts, words, counts))])
    (answer, total) = scoring.answers(3, 0.75, np.empty(0, np.uint64), False)(asks).to_pylist()
    assert len(scoring.unpack(answer["payload"])[0]) == len(words) and total["total"] == sum(wanted.values())


@pytest.mark.parametrize("bits", [64, 40, 12, 1])
def test_sorts_of_single_numbers(bits):
    """Hashes, hashes whose first bits are alike, and small numbers are ranked, summed and dealt as NumPy's full sorts do."""
    random_numbers = np.random.default_rng(bits)
    for count in (0, 1, 2, 700, 5_000):
        values = random_numbers.integers(0, 2**64, count, np.uint64) >> np.uint64(64 - bits)
        values = np.concatenate([values, values[: count // 3]])
        distinct, place = ranked(values)
        wanted, wanted_place = np.unique(values, return_inverse=True)
        assert (distinct == wanted).all() and (place == wanted_place).all() and distinct.dtype == np.uint64
        small = (values % np.uint64(300)).astype(np.int64)
        held, order = scoring.ordered(small)
        assert (order == np.argsort(small, kind="stable")).all() and (held == small[order]).all() and held.dtype == small.dtype
        weights = values % np.uint64(7)
        sums = scoring._sums(weights[order], scoring.starts(held))
        assert sums.tolist() == [int(weights[small == one].sum()) for one in np.unique(small)]
        by, bounds = scoring.by_shard(small, 300)
        assert (by == order).all() and (bounds == np.searchsorted(held, np.arange(301))).all()


def test_counts_only_where_they_are_sent():
    """A question needs the counts of its own order, a score none; the n-grams are the same."""
    chunk = scoring.Chunk.of(pa.array(["a b a b c", "", "b a b"]), np.array([True, True, False]))
    full = list(chunk.levels(3))
    for counted in (1, 2, 3, 4):
        for order, (held, wanted) in enumerate(zip(chunk.levels(3, counted), full, strict=True), 1):
            assert all((x == y).all() for x, y in ((held[0], wanted[0]), (held[1], wanted[1]), (held[3], wanted[3])))
            assert held[2] is None if order < counted else (held[2] == wanted[2]).all()


def test_packed_values_of_every_width():
    for bits in range(1, 65):
        values = np.sort(np.random.default_rng(bits).integers(0, 2**64, 300, np.uint64) >> np.uint64(64 - bits))
        packed = trie._packed(values, bits)
        assert (trie._unpacked(packed, np.arange(300), bits) == values).all()
