"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import evenkeel
from evenkeel import workspace
from evenkeel.workspace import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: ASCII white space as a character class, the same in Java, Python and DuckDB
BLANKS = r"[\x20\x09-\x0D]+"

__all__ = [
    "BLANKS", "batches", "hash_words", "lower_ascii", "mixed", "read_table", "remainder", "shared_folder",
    "ship_package", "unused", "word_array", "written",
]


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table and go on from it; what was shuffled for it isn't needed again and goes at once."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return workspace.written(df, folder, name)
    finally:
        conf.set(CLEANUP, before)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package also where it isn't on their path; once per session."""
    context = spark.sparkContext
    if getattr(context, "_evenkeel_shipped", False):
        return
    root = Path(evenkeel.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="evenkeel-code-")) / "evenkeel.zip"  # Spark hands it on from the driver
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._evenkeel_shipped = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names near the wanted ones that no column of ``df`` has, whatever its case."""
    taken = {column.lower() for column in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is; NULL is the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def word_array(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text in order, A-Z in lower case."""
    return F.array_remove(F.split(lower_ascii(text), BLANKS), "")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def hash_words(words: list[bytes]) -> np.ndarray:
    """One 64-bit hash per word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the SplitMix64 finaliser)."""
    with np.errstate(over="ignore"):
        values = values.astype(np.uint64, copy=True)
        values ^= values >> np.uint64(30)
        values *= np.uint64(0xBF58476D1CE4E5B9)
        values ^= values >> np.uint64(27)
        values *= np.uint64(0x94D049BB133111EB)
        values ^= values >> np.uint64(31)
    return values


def batches(frames: Iterable[pd.DataFrame], size: Callable[[tuple], int], most: int) -> Iterator[list[tuple]]:
    """Rows of the frames in lists whose sizes add up to about ``most``."""
    held, total = [], 0
    for frame in frames:
        for row in frame.itertuples(index=False, name=None):
            held.append(row)
            total += size(row)
            if total >= most:
                yield held
                held, total = [], 0
    if held:
        yield held
