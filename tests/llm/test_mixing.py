import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from evenkeel.llm import mixing

SCHEMA = "doc_id long, text string, source string, lang string, weight string, topic string"


def sample(count=3_000, seed=5):
    rng = random.Random(seed)
    parts = ["plain words only", "MIT License", "a | b | c", "token = x", "odd *** signs"]
    out = []
    for n in range(count):
        source = rng.choices(["s0", "s1", "s2", None], [60, 20, 15, 5])[0]
        out.append((n, " ".join([rng.choice(parts)] * rng.randint(1, 12)), source, rng.choices(["en", "de", "fr"], [7, 2, 1])[0]))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*row, "w", "t") for row in rows], SCHEMA)


def topic(text):
    return next((name for name, words in mixing.TOPICS.items() if any(w in text for w in words)), mixing.OTHER_TOPIC)


def brute(rows, targets, rounds=400):
    """Raked share of each cell, on a dense table."""
    cells = defaultdict(int)
    for _, text, source, lang in rows:
        cells[source, lang, topic(text or "")] += len((text or "").split())
    axes = [sorted({key[n] for key in cells}, key=repr) for n in range(3)]
    table = np.zeros([len(axis) for axis in axes])
    for key, tokens in cells.items():
        table[tuple(axis.index(part) for axis, part in zip(axes, key, strict=True))] = tokens
    table /= table.sum()
    wanted = []
    for n, target in enumerate(targets):
        present = table.sum(axis=tuple(x for x in range(3) if x != n))
        raw = present**target if isinstance(target, float) else np.array([target.get(name, p) for name, p in zip(axes[n], present, strict=True)])
        wanted.append(raw / raw.sum())
    start = table.copy()
    for _ in range(rounds):
        for n, target in enumerate(wanted):
            shape = [-1 if x == n else 1 for x in range(3)]
            table = table * (target / table.sum(axis=tuple(x for x in range(3) if x != n))).reshape(shape)
    return {(a, b, c): table[i, j, k] / start[i, j, k] for i, a in enumerate(axes[0]) for j, b in enumerate(axes[1]) for k, c in enumerate(axes[2]) if start[i, j, k]}


def mixed(spark, rows, **options):
    out, names = mixing.mix(frame(spark, rows), **options)
    return [(row, *(row[name] for name in names)) for row in out.collect()], out.columns


@pytest.mark.parametrize("targets", [{}, {"source": {"s0": 0.2, "s1": 0.3, "s2": 0.4}, "language": {"en": 0.5, "de": 0.3, "fr": 0.2, "xx": 0.9}}])
def test_weights_against_a_dense_table(spark, targets):
    rows = sample()
    wanted = brute(rows, [targets.get(name, mixing.FLATTEN[name]) for name in mixing.DIMENSIONS] if not targets else
                   [targets["source"], {k: v for k, v in targets["language"].items() if k != "xx"}, mixing.FLATTEN["topic"]])
    out, columns = mixed(spark, rows, targets=targets)
    assert columns[:6] == ["doc_id", "text", "source", "lang", "weight", "topic"] and len(out) == len(rows)
    for row, *_, weight, _, _, _ in out:
        assert weight == pytest.approx(wanted[row.source, row.lang, topic(row.text)], rel=1e-3)


def test_budget_and_marginals_of_the_sample(spark):
    rows = sample(12_000)
    out, _ = mixed(spark, rows, budget=0.4)
    tokens = {row.doc_id: len(row.text.split()) for row, *_ in out}
    total = sum(tokens.values())
    expected = sum(tokens[row.doc_id] * p for row, *_, p, _, _ in out)
    assert expected == pytest.approx(0.4 * total, rel=1e-6)
    chosen = [(row, p) for row, *_, p, _, selected in out if selected]
    assert sum(tokens[row.doc_id] for row, _ in chosen) == pytest.approx(expected, rel=0.05)
    if max(p for *_, p, _, _ in out) < 1:
        shares = Counter()
        for row, p in chosen:
            shares[row.lang] += tokens[row.doc_id]
        present = Counter()
        for row, *_ in out:
            present[row.lang] += tokens[row.doc_id]
        raw = {k: (v / total) ** mixing.FLATTEN["language"] for k, v in present.items()}
        for k, v in raw.items():
            assert shares[k] / sum(shares.values()) == pytest.approx(v / sum(raw.values()), rel=0.15)


def test_draws_depend_on_the_row_alone(spark):
    rows = sample(300) + [(7, "again", "s0", "en"), (7, "again", "s0", "en")]
    first, _ = mixed(spark, rows)
    random.Random(2).shuffle(rows)
    second, _ = mixed(spark, rows)
    def picked(out):
        return sorted((row.doc_id, row.text, p, d, s) for row, *_, p, d, s in out)

    assert [x[:2] + x[3:] for x in picked(first)] == [x[:2] + x[3:] for x in picked(second)]


def test_edge_cases(spark):
    rows = [(1, None, None, None), (2, "", "s", "en"), (None, "words here", "s", None), (4, "long " * 50_000, "s", "en"), (4, "long " * 50_000, "s", "en")]
    out, _ = mixed(spark, rows)
    assert len(out) == 5 and all(0 <= p <= 1 for *_, p, _, _ in out)
    assert mixed(spark, [])[0] == []
    kept = mixing.mix_stage(spark, frame(spark, rows), "")
    assert kept.columns[:6] == ["doc_id", "text", "source", "lang", "weight", "topic"] and len(kept.columns) == 8


def test_plans_of_raking_stay_small(spark, monkeypatch):
    plans, write = [], mixing.written

    def noted(df, folder, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString().count("Join ")))
        return write(df, folder, name)

    monkeypatch.setattr(mixing, "written", noted)
    mixing.mix(frame(spark, sample(300)))
    assert plans and max(joins for _, joins in plans) <= len(mixing.DIMENSIONS), plans
