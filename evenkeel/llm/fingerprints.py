"""Document fingerprints: the k smallest hashes of a text's word shingles.

Such a sketch is a uniform sample of the distinct shingles. Two sketches give the resemblance
and the containment of their sets, one gives the number of distinct shingles, and the sketch
of a union is made from the sketches of its parts (Broder 1997; Beyer et al. 2007). A set of at
most k shingles is held whole, so all estimates are exact there. DataFrame functions only.

Cases: a NULL text is the empty text, whose sketch is empty. A text of fewer words than a
shingle has is one shingle. Two empty sketches resemble each other fully, an empty and another
one not at all. Documents follow each other by doc_id, NULL first, repeated ids by text; after
the last comes the first. A table of one row follows itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import read_table, unused, word_array

SIZE = 128
WIDTH = 5
#: half the range of the signed 64-bit hashes
HALF = 2.0**63


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def shingles(text: Column, width: int = WIDTH) -> Column:
    """Hashes of all shingles of ``width`` words, in order, with repeats."""

    def rolled(hashes: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(hashes) - width)
        parts = F.transform(places, lambda at: F.xxhash64(*(F.get(hashes, at + n) for n in range(width))))
        short = F.when(F.size(hashes) > 0, F.array(F.xxhash64(hashes)))
        return F.when(F.size(hashes) >= width, parts).otherwise(F.coalesce(short, F.array().cast("array<bigint>")))

    return let(F.transform(word_array(text), lambda word: F.xxhash64(word)), rolled)


def sketch(text: Column, size: int = SIZE, width: int = WIDTH) -> Column:
    """The sorted ``size`` smallest distinct shingle hashes of a text."""
    return F.slice(F.sort_array(F.array_distinct(shingles(text, width))), 1, size)


def merge(one: Column, other: Column, size: int = SIZE) -> Column:
    """The sketch of the union of two sets, from their sketches."""
    return F.slice(F.sort_array(F.array_union(one, other)), 1, size)


def merged(sketches: DataFrame, column: str, *keys: str, size: int = SIZE) -> DataFrame:
    """One sketch per group of keys: the smallest distinct hashes of all sketches in the group.

    Hashes are made distinct before they are ranked, and each hash value is a shuffle key of
    its own, so a large group is not held by one task before it has shrunk.
    """
    hash_, slice_, place = unused(sketches, "hash", "slice", "place")
    hashes = sketches.select(*keys, F.explode(column).alias(hash_)).distinct()
    spread = hashes.withColumn(slice_, F.pmod(F.col(hash_), F.lit(64)))
    order = Window.partitionBy(*keys, slice_).orderBy(hash_)
    least = spread.withColumn(place, F.row_number().over(order)).where(F.col(place) <= size)
    return least.groupBy(*keys).agg(F.slice(F.sort_array(F.collect_list(hash_)), 1, size).alias(column))


def distinct_count(held: Column, size: int = SIZE) -> Column:
    """The number of distinct shingles: exact below ``size``, else from the place of the largest hash kept."""
    share = (F.element_at(held, -1).cast("double") + F.lit(HALF)) / F.lit(2 * HALF)
    return F.when(F.size(held) < size, F.size(held).cast("double")).otherwise((size - 1) / share)


def resemblance(one: Column, other: Column, size: int = SIZE) -> Column:
    """Share of the union's smallest hashes that both sets have; the Jaccard similarity."""
    both = let(
        merge(one, other, size),
        lambda union: F.size(F.array_intersect(F.array_intersect(union, one), other)) / F.size(union),
    )
    return F.when((F.size(one) == 0) & (F.size(other) == 0), F.lit(1.0)).otherwise(both)


def containment(one: Column, other: Column, size: int = SIZE) -> Column:
    """Share of the first set's shingles that the second has too."""
    alike = resemblance(one, other, size)
    common = alike / (1 + alike) * (distinct_count(one, size) + distinct_count(other, size))
    return F.when(F.size(one) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_count(one, size)))


def as_text(held: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits per hash."""
    return F.array_join(F.transform(held, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def _stretches(ids: DataFrame, count: int) -> list[int]:
    """First ids of about ``count`` equally large stretches of the id order."""
    shares = F.array(*(F.lit(n / count) for n in range(1, count)))
    row = ids.agg(F.min("key").alias("least"), F.percentile_approx("key", shares, 20 * count).alias("cuts")).first()
    return [] if row.least is None else sorted({row.least, *(row.cuts or [])})


def _stretch_of(key: Column, firsts: list[int]) -> Column:
    """Number of the stretch a key is in: a binary search in the sorted first keys."""
    table = F.lit(firsts).cast("array<bigint>")

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"] + 1) / 2).cast("int")
        fits = F.get(table, middle) <= key
        low = F.when(fits, middle).otherwise(state["low"])
        return F.struct(low.alias("low"), F.when(fits, state["high"]).otherwise(middle - 1).alias("high"))

    begin = F.struct(F.lit(0).alias("low"), F.lit(len(firsts) - 1).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(max(1, len(firsts).bit_length())))
    return F.aggregate(steps, begin, halve, lambda state: state["low"])


def in_stretches(documents: DataFrame, key: Column, count: int) -> DataFrame:
    """Adds ``key``, ``stretch`` and ``ahead``: rows grouped so that each has its follower in its group.

    The first row of each stretch of the order is added to the stretch before it (the very
    first to the last one) with ``ahead`` true. So a window over a stretch sees every row's follower,
    the texts are shuffled once, and no task holds more than a stretch.
    """
    keyed = documents.withColumn("key", F.coalesce(key.cast("long"), F.lit(-(2**63))))
    firsts = _stretches(keyed, count)
    if not firsts:
        return keyed.withColumns({"stretch": F.lit(0), "ahead": F.lit(False)})
    placed = keyed.withColumn("stretch", _stretch_of(F.col("key"), firsts))
    is_first = F.get(F.lit(firsts).cast("array<bigint>"), F.col("stretch")) == F.col("key")
    before = F.when(F.col("stretch") == 0, len(firsts) - 1).otherwise(F.col("stretch") - 1)
    here = F.struct(F.col("stretch"), F.lit(False).alias("ahead"))
    places = F.when(is_first, F.array(here, F.struct(before.alias("stretch"), F.lit(True).alias("ahead")))).otherwise(F.array(here))
    rows = placed.withColumn("places", places).drop("stretch")
    return rows.select("*", F.inline("places")).drop("places")


def fingerprint_documents(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, width: int = WIDTH
) -> DataFrame:
    """Sketches of every text and of its edited text, and their likeness to each other and to the next document's."""
    spark = documents.sparkSession
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    count = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    follow = Window.partitionBy("stretch").orderBy("ahead", "key", "text")
    paired = in_stretches(rows, F.col("doc_id"), count).withColumn("next_text", F.lead("text").over(follow))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substr("text", F.lit(1), F.length("text") - half), F.substr("next_text", F.lit(1), half)
    )
    sketched = paired.withColumn("held", sketch(F.col("text"), size, width)).withColumn(
        "next_held", F.lead("held").over(follow)
    )
    own = sketched.where("not ahead").withColumn("edited", edited)
    both = own.withColumn("edited_held", sketch(F.col("edited"), size, width))
    return both.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("held")).alias("fingerprint"),
        as_text(F.col("edited_held")).alias("edited_fingerprint"),
        resemblance(F.col("held"), F.col("edited_held"), size).alias("near_edited"),
        resemblance(F.col("held"), F.col("next_held"), size).alias("near_next"),
        distinct_count(F.col("held"), size).alias("n_shingles"),
        containment(F.col("edited_held"), F.col("held"), size).alias("edited_in_text"),
    )


def document_fingerprints(spark, sf_dir: str) -> DataFrame:
    """``op9``: fingerprints of all documents and of their edited texts."""
    return fingerprint_documents(read_table(spark, sf_dir, "documents"))
