"""Benchmark decontamination: item-sized windows of documents that are near copies of an item.

An item and a window are bags of five-word shingles; a document is contaminated where one of
its windows, as long as the item, has a weighted Jaccard similarity of at least 0.8 with it (the
weight of a shingle is its number of occurrences). DataFrame functions only. The steps:

1. Windows. Similarity 0.8 needs a shared shingle, and the window worth looking at lies as the
   item does around it. So windows are cut where a document shingle is one of the benchmark's and
   the one before it doesn't continue the same alignment: one window per run of agreement.
   The shingles are looked up where they are made, so nothing of clean documents is shuffled.
2. SimHash. Each window and item gets 64 bits, the signs of its summed shingle hash bits.
3. Multi-index Hamming search. The 64 bits are cut into four blocks. Two fingerprints at most
   ``RADIUS`` = 15 bits apart agree up to three bits in one block, so an item is stored
   under all values within three bits of each of its blocks, and a window looks up its own four.
   All pairs of equal size within the radius are found. Pairs at similarity 0.8 are within it with a
   probability of about 0.97, at 0.9 of more than 0.999, equal bags always.
4. The exact similarity of each pair found decides.

The benchmark's shingles are broadcast; a benchmark above ``BROADCAST_SHINGLES`` is taken in
several parts of its items, each with a pass over the documents.

Cases: NULL and empty texts, and those of fewer than five words, have no shingles and match
nothing. Words are runs of letters and digits, A-Z in lower case, so punctuation and white space
don't matter. A document shorter than the item is one window. Verdicts belong to a row's id and text,
so rows with equal ids and different texts, or NULL ids, are told apart, and repeated rows agree. Items with a NULL id count like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import lower_ascii, read_table, shared_folder, unused, written
from evenkeel.llm.fingerprints import let

WIDTH = 5
LEAST_SIMILARITY = 0.8
BLOCKS = 4
BLOCK_BITS = 16
BLOCK_RADIUS = 3
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
BROADCAST_SHINGLES = 2_000_000
#: shingles of a document that are looked up together
SEGMENT = 1024
NOT_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def shingle_array(text: Column) -> Column:
    """Hashes of the five-word shingles of a text in order; empty below five words."""
    words = F.array_remove(F.split(lower_ascii(text), NOT_WORDS), "")

    def rolled(hashes: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(hashes) - WIDTH)
        parts = F.transform(places, lambda at: F.xxhash64(*(F.get(hashes, at + n) for n in range(WIDTH))))
        return F.when(F.size(hashes) >= WIDTH, parts).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda word: F.xxhash64(word)), rolled)


def simhash(shingles: Column) -> Column:
    """64 bits: bit n is set where more shingle hashes of the bag have it set than not."""

    def bit(n: Column) -> Column:
        ones = F.aggregate(shingles, F.lit(0), lambda total, x: total + F.call_function("getbit", x, n).cast("int"))
        return F.when(ones * 2 > F.size(shingles), F.call_function("shiftleft", F.lit(1).cast("long"), n)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda held, n: held.bitwiseOR(bit(n)))


def distance(one: Column, other: Column) -> Column:
    return F.bit_count(one.bitwiseXOR(other))


def block(fingerprint: Column, number: int) -> Column:
    return F.shiftrightunsigned(fingerprint, number * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("long"))


def _address(size: Column, number: int, value: Column) -> Column:
    """Where fingerprints meet: bag size, block number and block value in one integer."""
    return F.shiftleft(size.cast("long") * BLOCKS + number, BLOCK_BITS).bitwiseOR(value)


def _masks() -> Column:
    """All block values with at most ``BLOCK_RADIUS`` bits set."""
    values = F.sequence(F.lit(0).cast("long"), F.lit((1 << BLOCK_BITS) - 1).cast("long"))
    return F.filter(values, lambda value: F.bit_count(value) <= BLOCK_RADIUS)


def item_index(items: DataFrame) -> DataFrame:
    """(address, number, item, item_print): each item under every address within the radius of its blocks."""
    entries = [
        F.struct(F.lit(number).alias("number"), _address(F.col("size"), number, value.bitwiseXOR(F.col("mask"))).alias("address"))
        for number, value in ((number, block(F.col("item_print"), number)) for number in range(BLOCKS))
    ]
    spread = items.select("item", "size", "item_print", F.explode(_masks()).alias("mask"))
    return spread.select("item", "item_print", F.inline(F.array(*entries)))


def near_items(windows: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of windows and items of one size whose fingerprints are within the radius, each pair once."""
    addresses = F.array(*(_address(F.col("size"), number, block(F.col("print"), number)) for number in range(BLOCKS)))
    met = windows.withColumn("address", F.explode(addresses)).join(item_index(items), "address")
    differing = F.col("print").bitwiseXOR(F.col("item_print"))
    within = [F.bit_count(block(differing, number)) <= BLOCK_RADIUS for number in range(BLOCKS)]
    first = F.when(within[0], 0).when(within[1], 1).when(within[2], 2).otherwise(3)
    return met.where((F.bit_count(differing) <= RADIUS) & (first == F.col("number"))).drop("address", "number", "item_print")


def bag_similarity(one: Column, other: Column) -> Column:
    """Weighted Jaccard similarity of two bags: sum of smaller over sum of larger counts."""

    def count(bag: Column, value: Column) -> Column:
        return F.size(F.filter(bag, lambda x: x == value))

    plain = (F.size(F.array_distinct(one)) == F.size(one)) | (F.size(F.array_distinct(other)) == F.size(other))
    counted = F.aggregate(
        F.array_intersect(one, other), F.lit(0), lambda total, x: total + F.least(count(one, x), count(other, x))
    )
    # where either bag has no repeats, every common shingle counts once
    common = F.when(plain, F.size(F.array_intersect(one, other))).otherwise(counted)
    return common / (F.size(one) + F.size(other) - common)


def prepare_items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, bag, size, item_print) of every item with at least five words."""
    bags = benchmark.select(F.col(item_id).alias("item"), shingle_array(F.col(text)).alias("bag"))
    sized = bags.where(F.size("bag") > 0).withColumn("size", F.size("bag"))
    return sized.withColumn("item_print", simhash(F.col("bag")))


def segments(shingles: Column, largest: int) -> Column:
    """The array in pieces that overlap, so that every window of up to ``largest`` shingles lies in one."""
    step = max(SEGMENT, largest)
    last = F.greatest(F.lit(0), F.ceil((F.size(shingles) - largest) / step).cast("int") - 1)
    return F.transform(F.sequence(F.lit(0), last), lambda n: F.slice(shingles, n * step + 1, step + largest))


def windows_of(documents: DataFrame, items: DataFrame, largest: int) -> DataFrame:
    """(doc_id, text_hash, size, bag, print): item-sized windows of documents around shared shingles.

    ``documents`` has doc_id, text_hash and shingles. The items' shingles are few enough to be sent out. Each
    shingle travels with its segment, not its document, which bounds the rows of very long texts.
    """
    documents = documents.withColumn("shingles", F.explode(segments(F.col("shingles"), largest)))
    before = F.get(F.col("bag"), F.col("offset") - 1)
    places = items.select("size", "bag", F.posexplode("bag").alias("offset", "shingle"))
    lookup = places.select("shingle", "size", "offset", before.alias("before")).distinct()
    spread = documents.select("doc_id", "text_hash", "shingles", F.posexplode("shingles").alias("at", "shingle"))
    met = spread.join(F.broadcast(lookup), "shingle")
    goes_on = F.get(F.col("shingles"), F.col("at") - 1).eqNullSafe(F.col("before")) & F.col("before").isNotNull()
    start = F.greatest(F.lit(0), F.least(F.col("at") - F.col("offset"), F.size("shingles") - F.col("size")))
    cut = met.where(~goes_on).select(
        "doc_id", "text_hash", "size", F.slice("shingles", start + 1, F.col("size")).alias("bag")
    )
    return cut.distinct().withColumn("print", simhash(F.col("bag")))


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    broadcast_shingles: int = BROADCAST_SHINGLES,
) -> DataFrame:
    """(doc_id, text_hash, item, similarity): every item that a document holds, with its best window."""
    folder = shared_folder(documents.sparkSession)
    # items go by a number of their own, as ids may be NULL or repeated
    numbered = prepare_items(benchmark, item_id, item_text).withColumnRenamed("item", "item_id")
    items = written(numbered.withColumn("item", F.monotonically_increasing_id()), folder, "items")
    size = items.agg(F.sum("size").alias("all"), F.max("size").alias("largest")).first()
    parts = -(-(size["all"] or 0) // broadcast_shingles) or 1
    shingled = documents.select(
        F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("text_hash"), shingle_array(F.col(text)).alias("shingles")
    )
    found = None
    for part in range(parts):
        some = items.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part) if parts > 1 else items
        windows = written(windows_of(shingled, some, size["largest"] or 1), folder, f"windows_{part}")
        pairs = near_items(windows, some.drop("bag", "item_id"))
        bags = some.select("item", "item_id", F.col("bag").alias("item_bag"))
        checked = pairs.join(bags, "item").withColumn("similarity", bag_similarity(F.col("bag"), F.col("item_bag")))
        hits = checked.where(F.col("similarity") >= LEAST_SIMILARITY).select(
            "doc_id", "text_hash", F.col("item_id").alias("item"), "similarity"
        )
        found = hits if found is None else found.unionAll(hits)
    return found.groupBy("doc_id", "text_hash", "item").agg(F.max("similarity").alias("similarity"))


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def judge(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, items (ids in order), similarity (of the best window).

    Items without an id count as one in ``n_items`` and aren't listed in ``items``.
    """
    hits = contaminated(documents, benchmark, doc_id, text)
    per_document = hits.groupBy(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).agg(
        F.sort_array(F.collect_set("item")).alias("items"), F.count("*").alias("n_items"), F.max("similarity").alias("similarity")
    )
    rows = documents.select(F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    joined = rows.join(per_document, same, "left")
    return joined.select(
        "doc_id",
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast(per_document.schema["items"].dataType)).alias("items"),
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
    )


def contamination_report(spark, sf_dir: str) -> DataFrame:
    """``op1``: which benchmark items each document holds."""
    return judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def drop_contaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go."""
    hit_id, hit_hash = unused(docs, "hit_id", "hit_hash")
    hits = contaminated(docs, read_table(spark, sf_dir, "benchmark"))
    gone = hits.select(F.col("doc_id").alias(hit_id), F.col("text_hash").alias(hit_hash)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(hit_id)) & (text_key(F.col("text")) == F.col(hit_hash))
    return docs.join(gone, same, "left_anti")
