"""Product codes of vectors by Lloyd's rounds over cover trees (after Lang and Schubert's cover-tree k-means).

Vectors become whole numbers and are cut into equal consecutive parts; each part has a codebook. All sums,
distances and comparisons are exact, so no result depends on how rows are dealt.

1. Tasks put their vectors into chunks of at most ``CHUNK`` rows and build a cover tree per chunk and part:
   a node covers its points within a radius, its children cover theirs within 1 / ``BASE`` of that and
   their centres lie further apart than that. The points of a subtree stand together, so cumulative sums along the chunk give the
   sum of any subtree. The trees are stored once, one row per chunk.
2. A round goes down each tree. Where a node's nearest entry stays nearest for everything within its radius,
   by the triangle inequality with some room for rounding, the whole subtree is assigned through its sums; only ambiguous
   nodes are opened, and points are compared one by one only at the bottom. Tasks return a sum and count per entry.
3. The codebooks (entries x length of a vector, at most 256 by default) are all that passes through the driver.

Cases: rows whose vector is NULL or holds NULL or non-finite components are dropped. Codebooks start from the
smallest ids, NULL ids last, equal ids by vector; with fewer rows than entries they are shorter. Ties go to the
lower entry, entries without points stay. Repeated rows count as often as they occur. NULL labels are one label. No
kept row: an empty result. Vectors of several lengths, of a length that the parts don't divide, or with components of 2^26
and more after scaling raise a ValueError. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm.common import read_table, shared_folder, written

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
CHUNK = 2048
BASE = 1.3
#: nodes of so few points are compared point by point
FEW = 4
#: squared distances of components below this are exact in 64 bits
LARGEST = 2**26
#: a bound must hold by this share, far above the rounding of square roots
ROOM = 1e-9
#: labels with more rows are hot; at most HOT_SHARE of them can be
HOT_ROWS = 1_000
HOT_SHARE = 20_000
TREE = "points:binary,place:binary,nodes:binary,radius:binary"


def kept_rows(rows: DataFrame, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """(vec_id, label, v): vectors of whole numbers."""
    value = F.col(vector)
    whole = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    large = F.exists(value, lambda x: F.abs(x.cast("double")) * scale >= LARGEST)
    error = F.raise_error(F.lit(f"a component of {LARGEST} / {scale} or more")).cast("array<int>")
    scaled = F.transform(value, lambda x: F.floor(x.cast("double") * scale).cast("int"))
    rows = rows.where(value.isNotNull() & ~whole)
    return rows.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.when(large, error).otherwise(scaled).alias("v"))


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, points x entries."""
    largest = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    if points.shape[1] * 4 * int(largest) ** 2 < 2**52:  # every sum is a whole number that a double holds
        a, b = points.astype(np.float64), entries.astype(np.float64)
        return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
    out = np.zeros((len(points), len(entries)), np.int64)
    for i in range(points.shape[1]):
        out += (points[:, i, None].astype(np.int64) - entries[None, :, i].astype(np.int64)) ** 2
    return out


class CoverTree:
    """Points in the order of the tree; nodes as (start, end, first child, past the last child); a node's centre is its first point."""

    def __init__(self, points: np.ndarray, place: np.ndarray, nodes: np.ndarray, radius: np.ndarray):
        self.points, self.place, self.nodes, self.radius = points, place, nodes, radius
        self.upto = np.concatenate([np.zeros((1, points.shape[1]), np.int64), points.cumsum(0, dtype=np.int64)])

    @classmethod
    def build(cls, points: np.ndarray) -> CoverTree:
        place = np.arange(len(points))
        nodes, radius = [[0, len(points), 0, 0]], []
        at = 0
        while at < len(nodes):
            start, end = nodes[at][:2]
            held = points[place[start:end]]
            away = np.sqrt(squared(held, held[:1])[:, 0])
            radius.append(away.max(initial=0.0))
            if end - start > FEW and radius[at] > 0:
                nodes[at][2] = len(nodes)
                for first, past in cls._split(held, place[start:end], away, radius[at] / BASE):
                    nodes.append([start + first, start + past, 0, 0])
                nodes[at][3] = len(nodes)
            at += 1
        return cls(points[place], place, np.array(nodes, np.int64), np.array(radius))

    @staticmethod
    def _split(held: np.ndarray, place: np.ndarray, away: np.ndarray, reach: float) -> list[tuple[int, int]]:
        """Reorders ``place`` by greedily chosen centres, each with what is left within its reach."""
        order, spans, left, done = [], [], np.arange(len(held)), 0
        while len(left):
            far = away if done == 0 else np.sqrt(squared(held[left], held[left[:1]])[:, 0])
            near = far <= reach
            order.append(left[near])
            spans.append((done, done + len(order[-1])))
            done += len(order[-1])
            left = left[~near]
        place[:] = place[np.concatenate(order)]
        return spans

    def assign(self, entries: np.ndarray, settle: Callable[[np.ndarray, np.ndarray, np.ndarray], None]) -> None:
        """Calls ``settle(starts, ends, entry)`` for ranges of points that all have that nearest entry."""
        front = np.array([0]) if len(self.points) else np.array([], int)
        while len(front):
            start, end, first, past = self.nodes[front].T
            far = squared(self.points[start], entries)
            best = far.argmin(1)
            nearest = np.sqrt(far[np.arange(len(front)), best].astype(np.float64))
            far[np.arange(len(front)), best] = np.iinfo(np.int64).max
            second = np.sqrt(far.min(1).astype(np.float64))
            radius = self.radius[front]
            clear = (nearest + 2 * radius) * (1 + ROOM) < second * (1 - ROOM)
            clear |= (radius == 0) | (len(entries) == 1)  # equal points: the comparison above is exact
            settle(start[clear], end[clear], best[clear])
            opened, bottom = ~clear & (past > first), ~clear & (past == first)
            points = _ranges(start[bottom], end[bottom])
            if len(points):
                settle(points, points + 1, squared(self.points[points], entries).argmin(1))
            front = _ranges(first[opened], past[opened])

    def sums(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum and count of the points per entry."""
        total, count = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)

        def settle(start: np.ndarray, end: np.ndarray, entry: np.ndarray) -> None:
            np.add.at(total, entry, self.upto[end] - self.upto[start])
            np.add.at(count, entry, end - start)

        self.assign(entries, settle)
        return total, count

    def codes(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance of every point, in the order the points were given."""
        found = np.zeros(len(self.points), np.int64)

        def settle(start: np.ndarray, end: np.ndarray, entry: np.ndarray) -> None:
            found[_ranges(start, end)] = np.repeat(entry, end - start)

        self.assign(entries, settle)
        off = ((self.points.astype(np.int64) - entries[found]) ** 2).sum(1)
        out = np.empty((2, len(found)), np.int64)
        out[:, self.place] = found, off
        return out[0], out[1]

    def row(self) -> dict[str, bytes]:
        arrays = {"points": (self.points, "<i4"), "place": (self.place, "<i4"), "nodes": (self.nodes, "<i4"), "radius": (self.radius, "<f8")}
        return {name: values.astype(kind).tobytes() for name, (values, kind) in arrays.items()}

    @classmethod
    def of_row(cls, row: dict[str, bytes], width: int) -> CoverTree:
        place = np.frombuffer(row["place"], "<i4").astype(np.int64)
        points = np.frombuffer(row["points"], "<i4").reshape(len(place), width)
        nodes = np.frombuffer(row["nodes"], "<i4").astype(np.int64).reshape(-1, 4)
        return cls(points, place, nodes, np.frombuffer(row["radius"], "<f8"))


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges, one range after the other."""
    size = end - start
    return np.repeat(start - np.concatenate([[0], size.cumsum()[:-1]])[: len(size)], size) + np.arange(size.sum())


def planted(kept: DataFrame, parts: int, folder: str) -> DataFrame:
    """One row per chunk: ids, labels and a stored tree per part."""
    ids, labels = (kept.schema[name].dataType.simpleString() for name in ("vec_id", "label"))

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for first in range(0, len(frame), CHUNK):
                rows = frame.iloc[first : first + CHUNK]
                cut = np.split(np.stack(rows["v"].to_list()).astype(np.int64), parts, axis=1)
                trees = [CoverTree.build(np.ascontiguousarray(one)).row() for one in cut]
                held = rows["rows"].to_list()
                yield pd.DataFrame({"rows": [held], "trees": [trees]})

    rows = kept.select(F.struct("vec_id", "label").alias("rows"), "v")
    return written(rows.mapInPandas(build, f"rows array<struct<vec_id:{ids},label:{labels}>>, trees array<struct<{TREE}>>"), folder, "chunks")


def moved(chunks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: each entry the floor of the mean of its points."""
    width = books[0].shape[1]

    def add_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [(np.zeros(book.shape, np.int64), np.zeros(len(book), np.int64)) for book in books]
        for frame in frames:
            for trees in frame["trees"]:
                for (total, count), row, book in zip(held, trees, books, strict=True):
                    more, points = CoverTree.of_row(row, width).sums(book)
                    total += more
                    count += points
        for part, (total, count) in enumerate(held):
            used = np.flatnonzero(count)
            yield pd.DataFrame({"part": part, "entry": used, "n": count[used], "sums": list(total[used])})

    found = chunks.select("trees").mapInPandas(add_up, "part int, entry int, n long, sums array<long>")
    wide = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)))
    books = [book.copy() for book in books]
    for part, entry, n, *sums in wide.collect():  # at most parts x entries rows
        books[part][entry] = [total // n for total in sums]
    return books


def coded(chunks: DataFrame, books: list[np.ndarray], ids: str, labels: str) -> DataFrame:
    """(vec_id, label, code, error) of every vector."""
    width = books[0].shape[1]

    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for rows, trees in zip(frame["rows"], frame["trees"], strict=True):
                found = [CoverTree.of_row(row, width).codes(book) for row, book in zip(trees, books, strict=True)]
                entries = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8)
                yield pd.DataFrame({"row": list(rows), "code": [line.tobytes().hex() for line in entries], "error": sum(off for _, off in found)})

    out = chunks.mapInPandas(code, f"row struct<vec_id:{ids},label:{labels}>, code string, error long")
    return out.select("row.*", "code", "error")


def with_label_error(rows: DataFrame) -> DataFrame:
    """Adds the error summed over equal labels; sums of labels with very many rows are sent to them, others are joined."""
    sums = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    least = max(HOT_ROWS, rows.count() // HOT_SHARE)
    hot = F.broadcast(sums.where(F.col("n") > least).drop("n"))  # at most HOT_SHARE rows
    others = sums.where(F.col("n") <= least).drop("n")
    same: Column = F.col("label").eqNullSafe(F.col("of"))
    return rows.join(hot, same).unionByName(rows.join(hot, same, "left_anti").join(others, same)).drop("of")


def checksum(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def product_codes(
    rows: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) per kept vector, and the codebooks; ``entries`` of at most 256."""
    if not 1 <= entries <= 256:
        raise ValueError("codes have two hex digits: at most 256 entries")
    spark: SparkSession = rows.sparkSession
    folder = shared_folder(spark)
    kept = kept_rows(rows, vec_id, vector, label, scale)
    sizes = kept.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if sizes[0] is None:
        return kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).limit(0), []
    if sizes[0] != sizes[1] or sizes[0] % parts or sizes[0] == 0:
        raise ValueError(f"vectors of one length that {parts} divides are wanted, found {sizes[0]} to {sizes[1]}")
    first = kept.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.split(np.array([row.v for row in first], np.int64), parts, axis=1)
    chunks = planted(kept, parts, folder)
    for _ in range(rounds):
        books = moved(chunks, books)
    ids, labels = (kept.schema[name].dataType.simpleString() for name in ("vec_id", "label"))
    return written(coded(chunks, books, ids, labels), folder, "codes"), books


def code_report(spark, sf_dir: str) -> DataFrame:
    """``op11``: codes and errors of every kept vector, with the digest of the final codebooks."""
    rows, books = product_codes(read_table(spark, sf_dir, "embeddings"))
    return with_label_error(rows).select("vec_id", "code", "error", "label_error", F.lit(checksum(books)).alias("codebooks_sha256"))
