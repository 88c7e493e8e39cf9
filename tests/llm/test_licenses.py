import random
import re

import pytest
from pyspark.sql import functions as F

from evenkeel.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPLIT = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def scanned(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [row.found for row in licenses.scan_licenses(frame, F.col("text"), "found").orderBy("doc_id").collect()]


def brute(text):
    words = WORD.findall((text or "").translate(SPLIT))
    places = [
        (at, label)
        for phrase, label in licenses.PHRASES.items()
        for at in range(len(words))
        if words[at : at + len(phrase.split())] == phrase.split()
    ]
    return len(words), len(places), min(places)[0] if places else None, max(places)[0] if places else None, ",".join(sorted({p[1] for p in places}))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_phrases_against_brute_force(spark):
    rng = random.Random(3)
    parts = ["MIT", "license", "License,", "apache", "general", "public", "é", "a-b", "\n", "mit\x0clicense", "ünder", "12", "%%"]
    texts = ["".join(rng.choice(parts) + rng.choice([" ", ". ", "-", "", "\n\n"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += [None, "", "mit license" * 3, "mit license " * 20_000, "émit license", "mit licenseé"]
    for text, row in zip(texts, scanned(spark, texts), strict=True):
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == brute(text)
        assert set(row.base_labels.split(",")) <= set(row.labels.split(",")) and 0 <= row.score <= 1


@pytest.mark.parametrize("notice", list(licenses.NOTICES))
def test_every_notice_with_edits_is_found(notice):
    rng = random.Random(notice)
    search = licenses.NoticeSearch({notice: "x"})
    for edits in range(licenses.edits_allowed(notice) + 1):
        for _ in range(10):
            letters = list(notice)
            for _ in range(edits):
                at = rng.randrange(1, len(letters) - 1)
                kind = rng.choice("ids")
                if kind == "i":
                    letters.insert(at, "q")
                elif kind == "s":
                    letters[at] = "q"
                else:
                    del letters[at]
            changed = "".join(letters).split()
            found = search.find([*"some words before it".split(), *changed, *"and some more".split()])
            if distance(" ".join(changed), notice) <= licenses.edits_allowed(notice):  # blanks may be lost too
                assert found, "".join(letters)
            for span in found:
                words = [*"some words before it".split(), *changed, *"and some more".split()][span.start : span.end]
                assert distance(" ".join(words), notice) == span.edits


def test_too_many_edits_and_likest_notice(spark):
    rows = scanned(spark, ["Licensed under CC BY-NC 4.0.", "Licensed under CC-BY 4.0", "Relaesde undre hte TIM Licenses", "lisensed under the Apache Licence, version 2.0"])
    assert [row.labels for row in rows] == ["cc-by-nc", "cc-by", "", "apache"]
    assert rows[3].base_labels == "" and [(s.start, s.end, s.edits) for s in rows[3].spans] == [(0, 8, 2)]


def test_notices_close_together(spark):
    good, bad = "released under the mit license", "released undr the mit license"
    for text in (f"{bad} {good}", f"{good} {bad}", f"{bad} {good} {bad}", f"{bad} and {bad} {good} {good} x {bad}"):
        search = licenses.NoticeSearch({good: "mit"})
        spans = search.find(text.split())
        words = text.split()
        wanted = [n for n in range(len(words) - 4) if " ".join(words[n : n + 5]) in (good, bad)]
        assert [(span.start, span.end, span.edits) for span in spans] == [(n, n + 5, int(words[n + 1] == "undr")) for n in wanted]


def test_empty_table_and_clashing_names(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, labels string, score string")
    out = licenses.scan_licenses(frame, F.col("text"), "found")
    assert out.count() == 0 and out.columns == [*frame.columns, "found"]
