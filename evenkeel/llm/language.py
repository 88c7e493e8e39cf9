"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter trigram is the product of its three
letter vectors, the first rotated by two places and the second by one. A text is the sum
of its trigram vectors, a language the sum of its training texts, and a text gets the
language whose vector has the largest cosine with its own (Joshi, Halseth, Kanerva 2016).

Cases: a NULL text, or one without letters, is ``und`` with score 0. A NULL language is not
learned from. Equal cosines go to the language that sorts first. With no training text at
all every text is ``und``. Extra columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import batches, read_table, remainder, ship_package, unused

UNDETERMINED = "und"
BLANK = 32
#: characters that are encoded together; bounds the memory of a task
CHUNK_CHARS = 400_000
CHUNK_TEXTS = 96
#: distinct trigrams whose vectors are in memory at once; a chunk in a script of many letters has a multiple
CHUNK_TRIGRAMS = 2_048


@cache
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(point).isalpha() for point in range(0x110000)), bool, 0x110000)


@cache
def _letter_vector(point: int, dims: int) -> np.ndarray:
    bits = np.random.Generator(np.random.Philox(key=point)).integers(0, 2, dims, dtype=np.int8)
    return bits * 2 - 1


def letter_codes(text: str | None) -> np.ndarray:
    """Code points in lower case, every stretch of other characters one blank, blanks at both ends; empty without letters."""
    if not text:
        return np.empty(0, np.int64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    is_letter = _letters()[codes]
    if not is_letter.any():
        return np.empty(0, np.int64)
    codes = np.concatenate([[BLANK], np.where(is_letter, codes, BLANK), [BLANK]])
    return codes[np.concatenate([[True], (codes[1:] != BLANK) | (codes[:-1] != BLANK)])]


def trigrams(text: str | None) -> np.ndarray:
    """One integer per letter trigram of the text, in order."""
    codes = letter_codes(text)
    return (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:] if len(codes) else codes


def trigram_vectors(keys: np.ndarray, dims: int) -> np.ndarray:
    """The bound vectors of distinct trigrams, one per row."""
    bound = np.ones((len(keys), dims), np.int8)
    for shift, turns in ((42, 2), (21, 1), (0, 0)):
        points, place = np.unique((keys >> shift) & 0x1FFFFF, return_inverse=True)
        table = np.stack([np.roll(_letter_vector(int(point), dims), turns) for point in points])
        bound *= table[place]
    return bound.astype(np.float32)


def bundle(texts: list[str | None], groups: np.ndarray, count: int, dims: int) -> np.ndarray:
    """The sum of trigram vectors for each of ``count`` groups of texts."""
    keys = [trigrams(text) for text in texts]
    owner = np.repeat(groups, [len(one) for one in keys])
    if not len(owner):
        return np.zeros((count, dims), np.float32)
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    total = np.zeros((count, dims), np.float32)
    for begin in range(0, len(distinct), CHUNK_TRIGRAMS):
        part = distinct[begin : begin + CHUNK_TRIGRAMS]
        held = slice(*np.searchsorted(place, (begin, begin + len(part))))
        counts = np.bincount(owner[held] * len(part) + place[held] - begin, minlength=count * len(part))
        total += counts.reshape(count, -1).astype(np.float32) @ trigram_vectors(part, dims)
    return total


def train(
    texts: DataFrame, text: Column, language: Column, dims: int = 1024, max_languages: int = 2_000
) -> tuple[list[str], np.ndarray]:
    """The languages in order and their unit vectors, learned from all given texts.

    Each task returns one partial profile per language, so what is shuffled depends on the
    number of tasks and languages, not on the text. ``max_languages`` bounds what comes to the driver.
    """

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for rows in batches(frames, lambda row: len(row[1]), CHUNK_CHARS):
            names, groups = np.unique([row[0] for row in rows], return_inverse=True)
            for name, vector in zip(names, bundle([row[1] for row in rows], groups, len(names), dims), strict=True):
                sums[str(name)] = sums.get(str(name), 0) + vector.astype(np.float64)
        if sums:
            yield pd.DataFrame({"language": list(sums), "profile": [vector.tolist() for vector in sums.values()]})

    labelled = texts.select(language.alias("language"), text.alias("text")).where("language is not null and text is not null")
    if labelled.select("language").distinct().limit(max_languages + 1).count() > max_languages:
        raise ValueError(f"more than {max_languages} languages in the training texts")
    parts = labelled.mapInPandas(partial, "language string, profile array<double>")
    summed = parts.select("language", F.posexplode("profile").alias("position", "value")).groupBy("language", "position")
    rows = summed.agg(F.sum("value").alias("value")).toPandas().sort_values(["language", "position"])
    names = sorted(rows["language"].unique())
    table = np.stack([rows.loc[rows["language"] == name, "value"].to_numpy() for name in names]) if names else np.empty((0, 0))
    length = np.linalg.norm(table, axis=1, keepdims=True)
    return names, (table / np.where(length == 0, 1, length)).astype(np.float32)


def identify(documents: DataFrame, text: Column, names: list[str], table: np.ndarray, result: str) -> DataFrame:
    """The documents with a struct column (lang_pred, score); no shuffle, whole texts."""
    dims = table.shape[1] if len(names) else 1

    @F.pandas_udf("lang_pred string, score double")
    def predict(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for values in series:
            out = []
            for begin in _spans(values):
                part = list(values.iloc[begin])
                vectors = bundle(part, np.arange(len(part)), len(part), dims)
                length = np.linalg.norm(vectors, axis=1)
                cosines = vectors @ table.T / np.where(length == 0, 1, length)[:, None] if names else np.zeros((len(part), 1))
                best = cosines.argmax(axis=1)
                for row, has_letters in enumerate(length > 0):
                    score = float(np.clip(cosines[row, best[row]], 0, 1))
                    out.append((names[best[row]], score) if has_letters and names else (UNDETERMINED, 0.0))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    return documents.withColumn(result, predict(text))


def _spans(values: pd.Series) -> Iterator[slice]:
    begin = total = 0
    for place, value in enumerate(values):
        total += len(value or "")
        if total >= CHUNK_CHARS or place - begin + 1 >= CHUNK_TEXTS:
            yield slice(begin, place + 1)
            begin, total = place + 1, 0
    if begin < len(values):
        yield slice(begin, len(values))


def predictions(spark, sf_dir: str) -> DataFrame:
    """``op3``: the language of every document, learned from those that are not held out."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder(F.col("doc_id"), 3) == 1
    names, table = train(documents.where(~held_out), F.col("text"), F.col("lang"))
    found = identify(documents.select("doc_id", "text", held_out.alias("held_out")), F.col("text"), names, table, "found")
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def keep_identified(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: identify every document's language, from profiles of all labelled ones.

    Documents without a language (``und``: NULL texts and texts without letters) go, and a missing label
    becomes the language found. A low cosine may be a short or mixed text that is worth keeping, so
    no score rejects a text. Where nothing is labelled no language is known, and a letter is enough.
    """
    ship_package(spark)
    names, table = train(docs, F.col("text"), F.col("lang"))
    if not names:

        @F.pandas_udf("boolean")
        def has_letters(texts: pd.Series) -> pd.Series:
            return pd.Series([len(letter_codes(text)) > 0 for text in texts], dtype=bool)

        return docs.where(has_letters(F.col("text")))
    (found,) = unused(docs, "found")
    identified = identify(docs, F.col("text"), names, table, found).where(F.col(f"{found}.lang_pred") != UNDETERMINED)
    return identified.withColumn("lang", F.coalesce("lang", f"{found}.lang_pred")).select(docs.columns)
