import random

import corpus_pipeline
from evenkeel.llm import contamination, duplicates, language, mixing, registry, secrets

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(folder, spark, count=60):
    rng = random.Random(12)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi") for b in ("ra", "tu", "ne", "so", "vi")]
    items = [(n, " ".join(rng.choice(words) for _ in range(30))) for n in range(4)]
    rows = [(n, " ".join(rng.choice(words) for _ in range(rng.randint(20, 80))), "aa", f"s{n % 4}") for n in range(count)]
    rows += [(100, "123 456 !!", "aa", "s0"), (101, None, "aa", "s0")]  # no letters
    rows += [(102, rows[3][1], "aa", "s1"), (103, rows[3][1] + " more", "aa", "s2")]  # copies
    rows += [(104, rows[5][1][:60] + " " + items[2][1] + " end of it", "aa", "s1")]  # a leak
    rows += [(105, "different sort of text token=fedcba9876543210 here", "aa", "s3")]
    spark.createDataFrame([(*row, len(row[1] or "")) for row in rows], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows


def test_stages_one_after_the_other(spark, tmp_path):
    corpus(str(tmp_path), spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns[:5] == COLUMNS and (name == "mixing" or out.columns == COLUMNS)
        out.write.parquet(f"{tmp_path}/stage_{n}")
        docs = spark.read.parquet(f"{tmp_path}/stage_{n}")
        seen[name] = {row.doc_id: row.text for row in docs.collect()}
    everything = set(range(60)) | {102, 103, 104, 105}
    assert set(seen["language"]) == everything
    assert set(seen["near_duplicates"]) == everything - {102, 103}
    assert set(seen["decontamination"]) == everything - {102, 103, 104}
    assert set(seen["secrets"]) == set(seen["decontamination"])
    assert seen["secrets"][105] == "different sort of text token=[secret] here"
    assert set(seen["mixing"]) < set(seen["secrets"]) and len(seen["mixing"]) > 10
    again = {row.doc_id: row.text for row in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert again == seen["mixing"]


def test_stages_are_the_operators():
    functions = [stage for _, stage in corpus_pipeline.STAGES]
    assert functions == [language.keep_identified, duplicates.keep_one_of_each, contamination.drop_contaminated, secrets.mask_stage, mixing.mix_stage]
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.queries() if name != "pipeline")
    assert numbers == list(range(1, 11)) and registry.PLAIN["pipeline"] is corpus_pipeline.run


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
