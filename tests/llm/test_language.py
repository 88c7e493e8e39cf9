import random

import numpy as np
from pyspark.sql import functions as F

from evenkeel.llm import language

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ein", "ung", "ver"], "cc": ["ció", "que", "ado", "ñe"]}
SCHEMA = "doc_id long, text string, lang string"


def sentence(rng, name, words):
    return " ".join("".join(rng.choices(SYLLABLES[name], k=rng.randint(1, 3))) for _ in range(words))


def rows(count=240, seed=1):
    rng = random.Random(seed)
    return [(n, sentence(rng, name, rng.randint(4, 40)), name) for n, name in ((n, "abc"[n % 3] * 2) for n in range(count))]


def learn(spark, data):
    return language.train(spark.createDataFrame(data, SCHEMA), F.col("text"), F.col("lang"))


def test_held_out_accuracy(spark):
    names, table = learn(spark, rows())
    held_out = spark.createDataFrame(rows(seed=2), SCHEMA)
    found = language.identify(held_out, F.col("text"), names, table, "found").select("lang", "found.*").collect()
    assert names == ["aa", "bb", "cc"]
    assert sum(row.lang == row.lang_pred for row in found) >= 0.98 * len(found)
    assert all(0 <= row.score <= 1 for row in found)


def test_profile_is_the_sum_over_trigrams_one_by_one(spark):
    data = rows(30)
    names, table = learn(spark, data)
    for place, name in enumerate(names):
        total = np.zeros(table.shape[1])
        for _, text, lang in data:
            if lang == name:
                padded = f" {text} "
                for at in range(len(padded) - 2):
                    a, b, c = (language._letter_vector(ord(x), 1024).astype(float) for x in padded[at : at + 3])
                    total += np.roll(a, 2) * np.roll(b, 1) * c
        assert np.allclose(table[place], total / np.linalg.norm(total), atol=1e-5)


def test_edge_cases(spark):
    data = [*rows(60), (900, None, "aa"), (901, "kalomi", None), (902, "", "bb")]
    names, table = learn(spark, data)
    assert names == ["aa", "bb", "cc"]
    asked = [(1, None), (2, ""), (3, "12 34 !?"), (4, "KA-LO mi" + " lotu" * 30_000), (5, "ka"), (5, "ka")]
    frame = spark.createDataFrame([(n, text, "own", 0.5) for n, text in asked], "doc_id long, text string, lang_pred string, score double")
    found = language.identify(frame, F.col("text"), names, table, "found").orderBy("doc_id").collect()
    assert [row.found.lang_pred for row in found[:3]] == ["und"] * 3 and [row.found.score for row in found[:3]] == [0.0] * 3
    assert found[3].found.lang_pred == "aa" and found[4].found == found[5].found
    assert found[0].lang_pred == "own" and found[0].score == 0.5


def test_nothing_to_learn_from(spark):
    names, table = learn(spark, [(1, None, None)])
    frame = spark.createDataFrame([(1, "kalo")], "doc_id long, text string")
    assert names == []
    assert language.identify(frame, F.col("text"), names, table, "found").first().found.lang_pred == "und"
    assert language.identify(frame.limit(0), F.col("text"), names, table, "found").count() == 0


def test_ties_go_to_the_first_name(spark):
    names, table = learn(spark, [(1, "kalo", "zz"), (2, "kalo", "aa")])
    frame = spark.createDataFrame([(1, "kalo")], "doc_id long, text string")
    assert language.identify(frame, F.col("text"), names, table, "found").first().found.lang_pred == "aa"


def test_stage_rejects_only_texts_without_letters(spark):
    data = [(n, text, lang, "x") for n, text, lang in rows(30)] + [(100, "12 !!", "aa", "x"), (101, None, "aa", "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, found string")
    kept = language.keep_identified(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(row.doc_id for row in kept.collect()) == list(range(30))


def test_stage_keeps_texts_with_letters_where_nothing_is_labelled(spark):
    data = [(1, "kalo mitu", None), (2, "12 !!", None), (3, None, None), (4, "é", None)]
    kept = language.keep_identified(spark, spark.createDataFrame(data, SCHEMA), "")
    assert sorted(row.doc_id for row in kept.collect()) == [1, 4]


def test_stage_identifies_texts_that_have_no_label(spark):
    data = [(n, "kalo mitu sane lomi kalo", "aa") for n in range(4)] + [(n, "wexy quzz vybe wexy", "bb") for n in range(4, 8)]
    data += [(8, "kalo sane mitu", None), (9, "quzz wexy", None), (10, "12 !!", None), (11, None, "aa")]
    kept = language.keep_identified(spark, spark.createDataFrame(data, SCHEMA), "")
    assert kept.columns == ["doc_id", "text", "lang"]
    assert {row.doc_id: row.lang for row in kept.collect()} == {n: "aa" if n < 4 or n == 8 else "bb" for n in range(10)}
