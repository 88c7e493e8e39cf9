"""The corpus pipeline: from raw documents to a training mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the
columns of ``documents``. Every stage's result is written to the shared folder and read again, so
a lost executor costs at most one stage's work. The stages look whole iterations of data over and
loop until nothing changes (groups of near-duplicates, raking), which SQL can't express;
the tests hold them against brute force instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evenkeel.llm.common import read_table, shared_folder, written
from evenkeel.llm.contamination import drop_contaminated
from evenkeel.llm.duplicates import keep_one_of_each
from evenkeel.llm.language import keep_identified
from evenkeel.llm.mixing import mix_stage
from evenkeel.llm.secrets import mask_stage

STAGES = [
    ("language", keep_identified),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("secrets", mask_stage),
    ("mixing", mix_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each over all that the one before kept."""
    docs = read_table(spark, sf_dir, "documents")
    folder = shared_folder(spark)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), folder, name)
    return docs
