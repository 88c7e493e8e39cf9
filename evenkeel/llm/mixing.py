"""Mixing sources to target weights by iterative proportional fitting.

The token counts of all (source, language, topic) cells are raked: in turn, each dimension's
cells are scaled so that its categories get their target shares, until all three marginals hold
together (Deming, Stephan 1940). A document's weight is its cell's raked over its present tokens. It is
kept with probability min(1, factor x weight), the factor chosen so that the expected number of
tokens is the budget. DataFrame functions only; the driver sees single rows of sums.

Cases: NULL sources and languages are a category of their own. A NULL or empty text has no
tokens; its cell's weight may be NULL and then counts as 1. Categories with a target but without
tokens are left out and the other shares grow in proportion; categories without a target keep
their present share. Where the marginals contradict each other (a cell that can't be filled), the last
round's weights hold after ``ROUNDS``. The draw is a hash of id, text and seed, so repeated rows share it, and a
repeated task draws the same. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import read_table, shared_folder, unused, word_array, written

DIMENSIONS = ("source", "language", "topic")
#: exponents that flatten the present shares where no targets are given: 1 keeps them, 0 makes them equal
FLATTEN = {"source": 0.5, "language": 0.7, "topic": 0.8}
BUDGET = 0.5
SEED = 20_240_101
ROUNDS = 30
#: largest deviation of a share from its target that ends the fitting
TOLERANCE = 1e-5
#: rounds between two looks at the deviation
ROUNDS_PER_CHECK = 2
BROADCAST_CELLS = 200_000

#: the first topic one of whose words occurs in the text
TOPICS = {
    "legal": ("license", "Licence", "copyright", "Copyright", "License"),
    "credentials": ("password", "token", "secret", "AKIA", "api_key"),
    "table": (" | ", "\t"),
    "symbols": ("***", "%%%", "###", "!!", "$$$"),
}
OTHER_TOPIC = "prose"


def topic_of(text: Column) -> Column:
    out = F.lit(OTHER_TOPIC)
    for name, words in reversed(TOPICS.items()):
        out = F.when(reduce(lambda a, b: a | b, (F.contains(text, F.lit(word)) for word in words)), name).otherwise(out)
    return out


def category(value: Column) -> Column:
    """A value as a category that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


def token_count(text: Column) -> Column:
    return F.size(word_array(text)).cast("long")


def present_shares(cells: DataFrame, dimension: str) -> DataFrame:
    """(dimension, share) of the tokens in the cells."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").alias("tokens"))
    return sums.select(dimension, (F.col("tokens") / F.lit(_total(cells, "tokens"))).alias("share"))


def _total(table: DataFrame, column: str) -> float:
    """The sum of a column, or 1 where there is nothing to sum."""
    return float(table.agg(F.sum(column)).first()[0] or 1)


def target_shares(cells: DataFrame, dimension: str, targets: dict[str, float] | DataFrame | float) -> DataFrame:
    """(dimension, target), summing to 1 over the categories that have tokens.

    ``targets`` is an exponent for the present shares, or wanted shares by category.
    """
    present = present_shares(cells, dimension).where("share > 0")
    if isinstance(targets, (int, float)):
        raw = present.withColumn("raw", F.pow("share", F.lit(float(targets))))
    else:
        if isinstance(targets, dict):
            rows = [(name, float(share)) for name, share in targets.items()]
            targets = cells.sparkSession.createDataFrame(rows, "category string, wanted double")
        wanted = targets.select(category(F.col("category")).alias(dimension), "wanted")
        raw = present.join(wanted, dimension, "left").withColumn("raw", F.coalesce("wanted", "share"))
    return raw.select(dimension, (F.col("raw") / F.lit(_total(raw, "raw"))).alias("target"))


def _scaled(cells: DataFrame, dimension: str) -> DataFrame:
    """Scale the cells so that this dimension's categories have their targets."""
    joined = cells.join(cells.groupBy(dimension).agg(F.sum("weight").alias("held")), dimension)
    factor = F.when(F.col("held") > 0, F.col(f"target_{dimension}") / F.col("held"))
    return joined.withColumn("weight", F.coalesce(F.col("weight") * factor, F.lit(0.0))).drop("held")


def _largest_deviation(cells: DataFrame, dimensions: Iterable[str]) -> float:
    """Of a category's share from its target, over those that have one."""
    worst = 0.0
    for dimension in dimensions:
        sums = cells.groupBy(dimension).agg(F.sum("weight").alias("held"), F.max(f"target_{dimension}").alias("target"))
        worst = max(worst, sums.agg(F.max(F.abs(F.col("held") - F.col("target")))).first()[0] or 0.0)
    return worst


def rake(
    cells: DataFrame, targets: dict[str, dict[str, float] | DataFrame | float], rounds: int = ROUNDS, tolerance: float = TOLERANCE
) -> DataFrame:
    """Adds ``weight`` to (source, language, topic, tokens) cells: shares of the whole that meet all targets.

    The cells are a table whatever their number: sums, joins and a write to the shared
    folder each time they are scaled. They carry their targets. Without the write every scaling
    would hold the plan before it twice, as the cells and in their sums.
    """
    folder = shared_folder(cells.sparkSession)
    held = cells.withColumn("weight", F.col("tokens") / F.lit(_total(cells, "tokens")))
    for name, target in targets.items():
        held = held.join(target_shares(cells, name, target).withColumnRenamed("target", f"target_{name}"), name, "left")
    held = written(held, folder, "cells_0")
    for done in range(1, rounds + 1):
        for dimension in targets:
            held = written(_scaled(held, dimension), folder, f"cells_{done}_{dimension}")
        if done % ROUNDS_PER_CHECK == 0 and _largest_deviation(held, targets) <= tolerance:
            break
    return held.select(*cells.columns, "weight")


def probabilities(raked: DataFrame, budget: float = BUDGET) -> DataFrame:
    """(source, language, topic, weight, probability): ``budget`` is the share of all tokens to keep.

    The factor is found by raising it until the tokens of the cells kept whole and those of all
    others add up to the budget. It ends, as no cell that is kept whole stops being so.
    """
    totals = _total(raked, "tokens")
    ratio = F.when(F.col("tokens") > 0, F.col("weight") * totals / F.col("tokens"))
    cells = raked.withColumn("ratio", ratio)
    factor, whole = budget, -1
    while True:
        kept_whole = F.col("ratio") * factor >= 1
        row = cells.agg(
            F.sum(F.when(kept_whole, F.col("tokens")).otherwise(0)).alias("whole"),
            F.sum(F.when(~kept_whole, F.col("tokens") * F.col("ratio"))).alias("rest"),
            F.count(F.when(kept_whole, 1)).alias("cells"),
        ).first()
        if row.cells == whole or not row.rest:
            break
        whole, factor = row.cells, max(factor, (budget * totals - row.whole) / row.rest)
    share = F.coalesce(F.least(F.lit(1.0), F.col("ratio") * factor), F.lit(min(1.0, budget)))
    return cells.select(*DIMENSIONS, F.coalesce("ratio", F.lit(1.0)).alias("weight"), share.alias("probability"))


def draw(*parts: Column, seed: int = SEED) -> Column:
    """A number from 0 to 1 that depends on the parts and the seed alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11) / F.lit(2.0**53)


def with_cells(documents: DataFrame, text: str, source: str, language: str, names: list[str]) -> DataFrame:
    """The documents with their source, language and topic categories under the given names."""
    values = (category(F.col(source)), category(F.col(language)), category(topic_of(F.coalesce(F.col(text), F.lit("")))))
    return documents.withColumns(dict(zip(names, values, strict=True)))


def mix(
    documents: DataFrame,
    targets: dict[str, dict[str, float] | DataFrame | float] | None = None,
    budget: float = BUDGET,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    language: str = "lang",
) -> tuple[DataFrame, list[str]]:
    """All documents with weight, probability, draw and selected; also the names these four columns got.

    Targets are wanted shares by category, or an exponent for the present shares, by dimension.
    """
    names = unused(documents, *DIMENSIONS)
    placed = with_cells(documents, text, source, language, names)
    counted = placed.groupBy(*(F.col(name).alias(dimension) for name, dimension in zip(names, DIMENSIONS, strict=True)))
    cells = written(
        counted.agg(F.sum(token_count(F.col(text))).alias("tokens")), shared_folder(documents.sparkSession), "cells"
    )
    chances = written(
        probabilities(rake(cells, FLATTEN | (targets or {})), budget), shared_folder(documents.sparkSession), "chances"
    )
    added = unused(placed, "weight", "probability", "draw", "selected")
    keys = unused(placed, *(f"cell_{dimension}" for dimension in DIMENSIONS))
    keyed = chances.select(
        *(F.col(dimension).alias(key) for dimension, key in zip(DIMENSIONS, keys, strict=True)),
        F.col("weight").alias(added[0]),
        F.col("probability").alias(added[1]),
    )
    keyed = F.broadcast(keyed) if chances.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS else keyed
    same = reduce(lambda a, b: a & b, (F.col(name) == F.col(key) for name, key in zip(names, keys, strict=True)))
    drawn = placed.join(keyed, same).drop(*keys)
    drawn = drawn.withColumn(added[2], draw(F.col(doc_id), F.coalesce(F.col(text), F.lit(""))))
    return drawn.withColumn(added[3], F.col(added[2]) < F.col(added[1])), [*names, *added]


def mixture(spark, sf_dir: str) -> DataFrame:
    """``op7``: cell, weight, probability and draw of every document."""
    mixed, (*_, topic, weight, probability, drawn, selected) = mix(read_table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        F.substring(F.col(topic), 2, 100).alias("topic"),
        token_count(F.col("text")).alias("tokens"),
        F.col(weight).alias("weight"),
        F.col(probability).alias("probability"),
        F.col(selected).alias("selected"),
    )


def mix_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the sampled documents, with the weight and probability of their cell."""
    mixed, (*cell, weight, probability, drawn, selected) = mix(docs)
    return mixed.where(F.col(selected)).drop(*cell, drawn, selected)
