"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidate edges.

1. A document's set is its distinct word shingles as 64-bit hashes. Documents with the same
   set are one node from here on, whatever their number.
2. One permutation: each hash falls into one of ``BINS`` bins by its top bits, and a bin's value
   is its smallest hash. An empty bin takes the value of another, chosen by a fixed random sequence
   per bin (optimal densification, Shrivastava 2017), so two sets agree in a bin with a
   probability equal to their similarity. ``BANDS`` bands of ``ROWS`` bins give the buckets. Two
   sets at similarity 0.8 share none with a probability of 5e-8.
3. Each bucket is a star: its members are tested against its smallest node only. A test is exact,
   on the full sets. Confirmed links give components (alternating large-star and small-star).
4. A star can miss links between two members that aren't linked to the centre. Sets in buckets whose
   members still lie in different components are therefore searched by their rarest shingles: shingles are ordered by the
   number of such sets that hold them, and two sets at similarity 0.8 share one among the first ninth of
   the smaller and the first fifth of the larger (prefix filter; exact). Pairs that share one are tested. Unlike texts
   of one large bucket have only common shingles in common, so they aren't paired at all. Nothing is capped.
5. Components are kept as (node, root). New links are contracted to roots before the next search for components.

Cases: NULL and empty texts, and those without words, have no shingle and stand alone. A text of
fewer words than a shingle has is one shingle. Repeated rows are copies of each other. Rows with one
id and different texts are separate documents with one name. A NULL id is never the smallest;
a component of NULL ids alone has component_id NULL, and of it one row per different set is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import hash_words, mixed, read_table, shared_folder, ship_package, unused, written

BINS = 1024
ROWS = 4
BANDS = 32
#: bits of two signatures that may differ: sets at similarity 0.8 differ in 102 of 1024 on average with a
#: standard deviation of 10, so in more than this with a probability of about 1e-5
MOST_BITS = 145
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: bytes of text whose sets a task holds at once (or one text)
PART_BYTES = 1_000_000


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of all shingles of ``width`` words; of the whole where there are fewer words."""
    words = hash_words((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not len(words):
        return words
    width = min(width, len(words))
    rolled = np.zeros(len(words) - width + 1, np.uint64)
    with np.errstate(over="ignore"):
        for place in range(width):
            rolled = rolled * MULTIPLIER + words[place : len(words) - width + 1 + place]
    return np.unique(mixed(rolled + np.uint64(width)))


def _preferences() -> np.ndarray:
    """For each bin, the other bins in the order in which it takes a value from them: a random order per bin."""
    numbers = np.random.Generator(np.random.PCG64(20_240_101)).random((BINS, BINS))
    return numbers.argsort(axis=1).astype(np.uint16)


PREFERENCES = _preferences()
RANKS = PREFERENCES.argsort(axis=1).astype(np.uint16)
FEW_BINS = 64
TOP = np.uint64(64 - (BINS - 1).bit_length())
NUMBERS = np.arange(BINS, dtype=np.uint64)
EDGES = NUMBERS << TOP


def signature(hashes: np.ndarray) -> np.ndarray:
    """The densified bin values of a sorted, non-empty set."""
    first = np.searchsorted(hashes, EDGES)
    values = hashes[np.minimum(first, len(hashes) - 1)]
    filled = (first < len(hashes)) & (values >> TOP == NUMBERS)
    empty, held = np.flatnonzero(~filled), np.flatnonzero(filled)
    if len(held) <= FEW_BINS:
        values[empty] = values[held[RANKS[empty[:, None], held].argmin(axis=1)]]
        return values
    for attempt in range(BINS):
        if not len(empty):
            break
        other = PREFERENCES[empty, attempt]
        found = filled[other]
        values[empty[found]] = values[other[found]]
        empty = empty[~found]
    return values


def buckets(values: np.ndarray) -> np.ndarray:
    """One 64-bit bucket per band of a signature; bands take bins that are spread evenly."""
    values = values[:: BINS // (BANDS * ROWS)].reshape(BANDS, ROWS)
    held = np.arange(1, BANDS + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for place in range(ROWS):
            held = mixed(held * MULTIPLIER + values[:, place])
    return held.view(np.int64)


def bits(values: np.ndarray) -> np.ndarray:
    """One bit per bin as 64-bit words: equal where the bins agree, else by chance."""
    with np.errstate(over="ignore"):
        one = (mixed(values + NUMBERS * MULTIPLIER) & np.uint64(1)).astype(np.uint8)
    return np.packbits(one).view(np.int64)


def parity(hashes: np.ndarray) -> np.ndarray:
    """For each of ``BINS`` residues whether a set has an odd number of hashes there, as 64-bit words.

    Each hash in only one of two sets flips one bit, so two sets differ in at least as many hashes as bits.
    """
    odd = np.bincount((hashes % np.uint64(BINS)).astype(np.int64), minlength=BINS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def text_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``PART_BYTES`` of their column ``text``, a row at least."""
    for batch in batches:
        read = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        ends = [*(np.flatnonzero(np.diff(read // PART_BYTES)) + 1).tolist(), batch.num_rows]
        for begin, end in zip([0, *ends[:-1]], ends, strict=True):
            if end > begin:
                yield batch.slice(begin, end - begin)


def sketch(hashes: np.ndarray) -> tuple[int, str | None, np.ndarray | None, np.ndarray | None]:
    """Size, name, buckets and bits of a set; its signature, 16 times as long as these, isn't kept."""
    if not len(hashes):
        return 0, None, None, None
    values = signature(hashes)
    return len(hashes), set_name(hashes), buckets(values), bits(values)


def sketches(documents: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, bands, bits): node names the set, NULL where it is empty."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), _text_hash(F.col(text)).alias("text_hash"), F.col(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_parts(batches):
            sizes, names, bands, signs = zip(*(sketch(shingle_set(one, width)) for one in batch["text"].to_pylist()), strict=True)
            columns = [
                batch["doc_id"],
                batch["text_hash"],
                pa.array(sizes, pa.int64()),
                pa.array(names, pa.string()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(signs, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_shingles", "node", "bands", "bits"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        work, f"doc_id {kind}, text_hash long, n_shingles long, node string, bands array<long>, bits array<long>"
    )


def set_name(hashes: np.ndarray) -> str | None:
    return xxhash.xxh3_128_hexdigest(hashes.tobytes()) if len(hashes) else None


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def full_sets(documents: DataFrame, wanted: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """(node, shingles) of the wanted (doc_id, text_hash) rows, read from the documents again."""
    rows = documents.select(_text_hash(F.col(text)).alias("row_hash"), F.col(doc_id).alias("row_id"), F.col(text).alias("text"))
    same = F.col("row_id").eqNullSafe(F.col("doc_id")) & (F.col("row_hash") == F.col("text_hash"))
    texts = rows.join(wanted, same, "left_semi").select("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_parts(batches):
            sets = [shingle_set(one, width) for one in batch["text"].to_pylist()]
            columns = [
                pa.array([set_name(one) for one in sets], pa.string()),
                pa.array([one.view(np.int64) for one in sets], pa.list_(pa.int64())),
                pa.array([parity(one) for one in sets], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["node", "shingles", "parity"])

    return texts.mapInArrow(work, "node string, shingles array<long>, parity array<long>").dropDuplicates(["node"])


def components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """(node, root) for every node of the (a, b) edges: the smallest node it is connected with.

    Alternating large-star and small-star (Kiveris et al. 2014): each round is two group-bys and two
    joins on a node, whatever the sizes of the components.
    """
    held = written(edges.where("a <> b").select("a", "b").distinct(), folder, f"{name}_0")
    seen = None
    for step in range(1, 200):
        both = held.unionAll(held.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        down = large.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("least"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = small.unionAll(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct()
        held = written(small, folder, f"{name}_{step}")
        state = held.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return held.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(held.select("b", "b").distinct())


def confirm(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) edges whose full sets are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    other = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    united = F.size("set_a") + F.size("set_b") - common
    return edges.join(one, "a").join(other, "b").where(common * 100 >= united * percent).select("a", "b")


def _fits(a: str, b: str, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough at all."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _unlike(a: str, b: str) -> Column:
    """The number of bits in which two arrays of words differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda held, x: held + x)


def alike(edges: DataFrame, sketched: DataFrame) -> DataFrame:
    """The (a, b) edges whose signatures differ in few enough bits."""
    one = sketched.select(F.col("node").alias("a"), F.col("bits").alias("bits_a"))
    other = sketched.select(F.col("node").alias("b"), F.col("bits").alias("bits_b"))
    return edges.join(one, "a").join(other, "b").where(_unlike("bits_a", "bits_b") <= MOST_BITS).select("a", "b")


def merged(roots: DataFrame, links: DataFrame, folder: str, name: str) -> DataFrame:
    """(node, root) after new (a, b) links between nodes of ``roots``: only links between different roots count."""
    held = written(_apart(links, roots), folder, f"{name}_new")
    if held.isEmpty():
        return roots
    top = components(held.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")), folder, name)
    top = top.select(F.col("node").alias("root"), F.col("root").alias("top"))
    joined = roots.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return written(joined, folder, f"{name}_roots")


def _apart(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """The (a, b) edges whose ends aren't connected yet, with both roots."""
    a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    return edges.join(a, "a").join(b, "b").where("root_a <> root_b")


def _first(size: Column, share: str) -> Column:
    """How many shingles of a set can't all be missing in a set that has ``share`` of them, a fraction "x/y"."""
    over, under = share.split("/")
    return size - F.ceil(size * F.lit(int(over)) / F.lit(int(under)) - 1e-9) + 1


def by_rare_shingles(open_nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) pairs of (node, root) rows with different roots, among them every link.

    A set's shingles are ordered by the number of sets that hold them, ties by hash. A link's sets have
    2 * percent / (100 + percent) of the smaller set in common and ``percent`` of the larger, so the first shingle in
    common stands among the first of both. Shingles of one set alone meet nothing and don't travel on. A pair gets out
    of the join only where the bits of ``parity`` that differ leave enough to be in common, which loses no link either.
    """
    held = open_nodes.join(sets, "node").select("node", F.explode("shingles").alias("shingle"))
    common = held.groupBy("shingle").agg(F.count("*").alias("holders")).where("holders > 1")
    nodes = open_nodes.join(sets, "node").select("node", "root", F.size("shingles").alias("size"), "parity")
    by_node = Window.partitionBy("node")
    # shingles of one set alone come first in its order: only their number matters
    ranked = held.join(common, "shingle").select(
        "node", "shingle", F.row_number().over(by_node.orderBy("holders", "shingle")).alias("rank"), F.count("*").over(by_node).alias("held")
    )
    ranked = ranked.join(nodes, "node").withColumn("place", F.col("size") - F.col("held") + F.col("rank"))
    ranked = ranked.where(F.col("place") <= _first(F.col("size"), f"{percent}/100")).drop("rank", "held")
    smaller = ranked.where(F.col("place") <= _first(F.col("size"), f"{2 * percent}/{100 + percent}"))
    other = ranked.select("shingle", *(F.col(name).alias(f"{name}_b") for name in ("node", "root", "size", "place", "parity")))
    # what can still be common from these places on, and by the hashes that are known to differ
    both = F.col("size") + F.col("size_b")
    rest = 1 + F.least(F.col("size") - F.col("place"), F.col("size_b") - F.col("place_b"))
    pairs = smaller.join(other, "shingle").where(
        (F.struct("size", "node") < F.struct(F.col("size_b").alias("size"), F.col("node_b").alias("node")))
        & (F.col("root") != F.col("root_b"))
        & _fits("size", "size_b", percent)
        & (rest * (100 + percent) >= both * percent)
        & ((both - _unlike("parity", "parity_b")) * (100 + percent) >= both * 2 * percent)
    )
    return pairs.select(F.greatest("node", "node_b").alias("a"), F.least("node", "node_b").alias("b")).distinct()


def linked(nodes: DataFrame, documents: DataFrame, doc_id: str, text: str, width: int, percent: int, folder: str) -> DataFrame:
    """(node, root) of all nodes that share a bucket with another one."""
    spread = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    stars = spread.groupBy("bucket").agg(
        F.min("node").alias("centre"), F.min_by("size", "node").alias("centre_size"), F.count("*").alias("members")
    )
    shared = written(spread.join(stars.where("members > 1"), "bucket"), folder, "members")
    wanted = shared.select("node").distinct().join(nodes, "node")
    sketched = written(wanted.select("node", "doc_id", "text_hash", "bits"), folder, "shared_nodes")
    sets = written(full_sets(documents, sketched.select("doc_id", "text_hash"), doc_id, text, width), folder, "sets")
    roots = sketched.select("node", F.col("node").alias("root"))

    edges = shared.where("node <> centre").where(_fits("size", "centre_size", percent))
    counted = edges.groupBy(F.col("node").alias("a"), F.col("centre").alias("b")).agg(F.count("*").alias("buckets"))
    # first each node with the centre it shares most buckets with, then the other centres it isn't connected with yet
    counted = written(counted, folder, "edges")
    best = counted.groupBy("a").agg(F.max_by("b", F.struct("buckets", "b")).alias("b"))
    roots = merged(roots, confirm(best, sets, percent), folder, "best")
    rest = _apart(counted.join(best, ["a", "b"], "left_anti"), roots).select("a", "b")
    roots = merged(roots, confirm(alike(rest, sketched), sets, percent), folder, "star")

    labelled = shared.select("bucket", "node").join(roots, "node")
    split = labelled.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    left = labelled.join(split.select("bucket"), "bucket").select("node", "root").distinct()
    left = written(left, folder, "open_nodes")
    if left.isEmpty():
        return roots
    pairs = written(by_rare_shingles(left, sets, percent), folder, "rare_pairs")
    return merged(roots, confirm(alike(pairs, sketched), sets, percent), folder, "rare")


def near_duplicates(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, component_id, kept, keeper.

    ``kept`` marks the rows whose id names the group. ``keeper`` marks the row the group goes
    by also where ids are NULL or repeated: the smallest id (NULL last), then text hash.
    """
    folder = shared_folder(documents.sparkSession)
    rows = written(sketches(documents, doc_id, text, width), folder, "sketches")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    # one row per different set; the copies of a set meet only after a partial aggregate
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.min(order).alias("first"),
        F.first("n_shingles").alias("size"),
        F.first("bands").alias("bands"),
        F.first("bits").alias("bits"),
    )
    nodes = nodes.select("node", "first", "first.doc_id", "first.text_hash", "size", "bands", "bits")
    nodes = written(nodes, folder, "nodes")
    roots = written(linked(nodes, documents, doc_id, text, width, percent, folder), folder, "roots")
    rooted = nodes.select("node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = rooted.groupBy("root").agg(F.min("first").alias("group"))
    named = rows.where("node is not null").join(rooted.join(groups, "root").select("node", "group"), "node")
    out = named.unionByName(rows.where("node is null").withColumn("group", order))
    return out.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.col("group.doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("group.doc_id")).alias("kept"),
        (order == F.col("group")).alias("keeper"),
    )


def duplicate_report(spark, sf_dir: str) -> DataFrame:
    """``op4``: the group of every document, by sets of four-word shingles."""
    return near_duplicates(read_table(spark, sf_dir, "documents"), width=4).drop("text_hash", "keeper")


def keep_one_of_each(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near-duplicates (five-word shingles) one row stays.

    Rows without any word have no copies and stay.
    """
    ship_package(spark)
    gone_id, gone_hash = unused(docs, "gone_id", "gone_hash")
    judged = written(near_duplicates(docs), shared_folder(spark), "judged")
    names = [F.col("doc_id").alias(gone_id), F.col("text_hash").alias(gone_hash)]
    same = F.col("doc_id").eqNullSafe(F.col(gone_id)) & (_text_hash(F.col("text")) == F.col(gone_hash))
    left = docs.join(judged.where("not keeper").select(names).distinct(), same, "left_anti")
    again = judged.where("keeper and n_shingles > 0").groupBy("doc_id", "text_hash").count().where("count > 1").select(names)
    if again.isEmpty():
        return left
    # keepers that occur in several rows alike in id and text
    one_each = left.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(again, same, "left_anti").unionByName(one_each)
