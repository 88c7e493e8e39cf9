"""Per-column difference counts over changed pairs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.rows import KEY, is_text, quote
from evenkeel.functions.values import differs, value_text
from evenkeel.operators.columns import quoted
from evenkeel.operators.ledger import HALVES, PAIRS, SIDES, WORDS, product

SCHEMA = f"column_name string, differences {PAIRS}"


def types_by_name(df: DataFrame) -> dict[str, T.DataType]:
    return {field.name: field.dataType for field in df.schema.fields}


def counted_in_pairs(
    pairs: DataFrame,
    columns: Sequence[str],
    source_types: dict[str, T.DataType],
    target_types: dict[str, T.DataType],
) -> DataFrame:
    """All columns counted in one aggregate over pairs ``(source STRUCT, target STRUCT)``.

    Each task hands on a single row of counts, so nothing but that is shuffled.
    """
    counts = pairs.agg(*[
        F.count_if(
            differs(
                F.col(f"source.{quote(name)}"), source_types[name], F.col(f"target.{quote(name)}"), target_types[name]
            )
        ).alias(f"n{i}")
        for i, name in enumerate(columns)
    ])
    names = F.array(*[F.lit(name) for name in columns])
    numbers = F.array(*[f"n{i}" for i in range(len(columns))])
    return counts.select(F.inline(F.arrays_zip(names.alias("column_name"), numbers.alias("differences")))).select(
        "column_name", F.col("differences").cast(PAIRS).alias("differences")
    )


def read_back(rows: DataFrame, names: Sequence[str]) -> Column | None:
    """Whether the values of a row follow from the text of its digest; None for types where that isn't known.

    A separator can be taken for one only next to a text with a bar, and a point in time has the
    text of another one only where clocks are set back. No two numbers, truth values or days are
    written the same, and none is written as the empty text that stands for NULL.
    """
    types = types_by_name(rows)
    sure = F.lit(True)
    for name in names:
        kind = types[name]
        if is_text(kind):
            sure = sure & ~F.contains(quoted(name), F.lit("|"))
        elif isinstance(kind, T.TimestampType):
            sure = sure & quoted(name).eqNullSafe(quoted(name).cast("string").try_cast(kind))
        elif not isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampNTZType)):
            return None
    return sure


def digests_tell_apart(source: DataFrame, target: DataFrame, names: Sequence[str]) -> bool:
    """Whether rows with equal digests are known to have equal values: one look at texts and times, nothing is shuffled."""
    kinds = [[types_by_name(df)[name] for name in names] for df in (source, target)]
    sure = [read_back(df, names) for df in (source, target)]
    if kinds[0] != kinds[1] or sure[0] is None or sure[1] is None:
        return False
    if not any(is_text(kind) or isinstance(kind, T.TimestampType) for kind in kinds[0]):
        return True
    return not any(df.where(~condition).limit(1).count() for df, condition in zip((source, target), sure))


def counted_by_value(
    source: DataFrame,
    target: DataFrame,
    columns: Sequence[str],
    pairs: Decimal,
    told_apart: bool,
    store: Callable[[DataFrame, str], DataFrame],
) -> DataFrame:
    """The same counts for keys with many rows on both sides, without forming their pairs.

    Of all ``pairs`` with the same key, those that agree in a column are the sum, over key
    and value, of the product of both sides' row counts. The others differ; they count
    unless their digests are equal all the same (as with values that contain the
    separator), which is looked into where digests may stand for unequal rows (not ``told_apart``).
    """
    source_types, target_types = types_by_name(source), types_by_name(target)

    def marked(df: DataFrame, side: str, own: dict[str, T.DataType], other: dict[str, T.DataType]) -> DataFrame:
        values = [value_text(quoted(name), own[name], other[name]) for name in columns]
        words = [F.expr(word).alias(half) for half, word in WORDS.items()]
        markers = [F.lit(int(side == name)).cast("bigint").alias(f"{name}_rows") for name in SIDES]
        return df.select(KEY, *words, F.array(*values).alias("_values"), *markers)

    sums = [F.sum(f"{side}_rows").alias(f"{side}_rows") for side in SIDES]
    rows = marked(source, "source", source_types, target_types).unionByName(
        marked(target, "target", target_types, source_types)
    )

    def agreeing(rows: DataFrame, *by: str) -> DataFrame:
        cells = rows.select(*by, F.posexplode("_values").alias("place", "value"), "source_rows", "target_rows")
        per_value = cells.groupBy(*by, "place", "value").agg(*sums)
        return per_value.groupBy("place").agg(F.sum(product("source_rows", "target_rows")).cast(PAIRS).alias("same"))

    uncounted, hidden = agreeing(rows, KEY), 0
    if not told_apart:
        # unequal rows differ in one of two 64-bit hashes
        hashes = {"first": F.xxhash64("_values"), "second": F.xxhash64(F.lit(1), "_values")}
        spans = [bound(hashes[name]).alias(f"{name}_{bound.__name__}") for name in hashes for bound in (F.min, F.max)]
        ambiguous = rows.groupBy(KEY, *HALVES).agg(*spans, *sums).where(
            "source_rows > 0 AND target_rows > 0 AND (first_min <> first_max OR second_min <> second_max)"
        )
        ambiguous = ambiguous.select(KEY, *HALVES, product("source_rows", "target_rows").alias("pairs"))
        ambiguous = store(ambiguous, "ambiguous_digests")
        hidden = ambiguous.agg(F.coalesce(F.sum("pairs"), F.lit(0)).cast(PAIRS)).first()[0]
    if hidden:
        # pairs with equal digests that agree in the column were subtracted twice: add them again
        inside = agreeing(rows.join(ambiguous, [KEY, *HALVES], "left_semi"), KEY, *HALVES)
        uncounted = uncounted.unionByName(inside.withColumn("same", (-F.col("same")).cast(PAIRS)))
        uncounted = uncounted.groupBy("place").agg(F.sum("same").cast(PAIRS).alias("same"))
    names = F.element_at(F.array(*[F.lit(name) for name in columns]), F.col("place") + 1)
    counted = (F.lit(pairs - hidden).cast(PAIRS) - F.col("same")).cast(PAIRS)
    return uncounted.select(names.alias("column_name"), counted.alias("differences"))


def summed(*parts: DataFrame) -> DataFrame:
    """Counts of all parts added up per column; columns without differences are left out."""
    whole = parts[0]
    if len(parts) > 1:
        for part in parts[1:]:
            whole = whole.unionByName(part)
        whole = whole.groupBy("column_name").agg(F.sum("differences").cast(PAIRS).alias("differences"))
    return whole.where(F.col("differences") > 0)
