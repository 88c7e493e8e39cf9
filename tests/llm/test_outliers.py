import random
import re

import numpy as np

from evenkeel.llm import outliers

SCHEMA = "doc_id long, text string, lang string, source string, language string, n_words int, kept int, n int"
WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore".split()


def base(text):
    """The fixed rules, window by window and line by line."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = {}
    for n in range(len(words) - 4):
        windows.setdefault(tuple(words[n : n + 5]), []).append(n)
    inside = {n + k for at in windows.values() if len(at) > 1 for n in at for k in range(5)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed


def found(spark, rows):
    frame = spark.createDataFrame([(*row, "x", 1, 1, 1) for row in rows], SCHEMA).repartition(3)
    return outliers.judge_quality(frame).collect()


def counts(rows):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows), key=repr)


def sentence(rng, size):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "", ".", "\n"]) + str(rng.randrange(10**5)) * (rng.random() < 0.4) for _ in range(size))


def test_planted_outliers_and_edge_cases(spark):
    rng = random.Random(8)
    clean = [(n, sentence(rng, rng.randint(40, 300)), rng.choice(["en", None]), rng.choice(["a", None])) for n in range(400)]
    junk = [(1000 + n, " ".join(w + "###" for w in sentence(rng, 80).split()), "en", "a") for n in range(15)]
    odd = [
        (None, None, None, None),
        (2000, "", "en", "a"),
        (2001, "a b c d e f g h i j k l " * 4_000, "en", "a"),
        (2002, "one line of words\none line of words\n \n \nand é 😀", "xx", "rare"),
        (2003, sentence(rng, 60), "xx", "rare"),
        (0, clean[0][1], "en", "a"),
    ]
    out = found(spark, clean + junk + odd)
    assert counts(out) == sorted(((r[0], *base(r[1])) for r in clean + junk + odd), key=repr)
    verdict = [(r.doc_id, r.kept) for r in out if not r.base_failed]
    assert not any(kept for doc_id, kept in verdict if doc_id and 1000 <= doc_id < 1015)
    assert sum(kept for doc_id, kept in verdict if doc_id is not None and doc_id < 400) >= 398
    assert (2003, True) in verdict and not any(r.kept for r in out if r.base_failed)
    assert found(spark, []) == []


def test_estimate_against_sorted_rows(spark, tmp_path):
    """Concentration over all rows in order of distance, from many starts, finds no smaller determinant worth naming."""
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(5, 5)) * 300
    points = np.rint(np.vstack([rng.normal(size=(300, 5)) @ mix, rng.normal(size=(50, 5)) * 40 + 6000])).astype(int)
    frame = spark.createDataFrame([("l", "o", *map(int, p)) for p in points], "language string, origin string, " + ", ".join(f"z{i} int" for i in range(5)))
    got = outliers.minimum_determinant(frame, str(tmp_path)).first()
    floor = np.eye(5) * (outliers.FLOOR * outliers.SCALE) ** 2
    best = np.inf
    for _ in range(30):
        near = rng.choice(350, 10, replace=False)
        for _ in range(40):
            centre, spread = points[near].mean(0), np.cov(points[near].T, bias=True) + floor
            away = points - centre
            near = np.argsort((away @ np.linalg.inv(spread) * away).sum(1))[: int(np.ceil(350 * outliers.SHARE))]
        best = min(best, np.linalg.slogdet(np.cov(points[near].T, bias=True) + floor)[1])
    assert got.logdet < best + 0.2
    assert abs(got.m0) < 1500 and all(abs(got[f"m{i}"] - points[:300, i].mean()) < 250 for i in range(5))
