"""Row counts per business key: the base of every count and every difference set.

No rows are paired up here, and pair counts are products of row counts. Where keys are nearly
unique, both sides are stacked and summed up per key in one shuffle: rows per side, and the smallest
and largest digest per side, which settles every key with one digest on each side; the few keys with
several digests are counted again. Where many keys have several rows, both sides are counted once per
(key, digest) and the counts summed up per key. All sums have a map-side part, so a key that
holds a third of all rows shrinks to one record per task before it travels.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.rows import DIGEST, KEY

# Numbers of pairs are products of row counts and outgrow a 64-bit integer.
PAIRS = "decimal(38,0)"


def product(left: str, right: str) -> Column:
    return F.expr(f"CAST(CAST({left} AS DECIMAL(19,0)) * CAST({right} AS DECIMAL(19,0)) AS {PAIRS})")


SIDES = ("source", "target")
HALVES = ("high", "low")
# Digests meet as two 64-bit hashes of their halves, fixed-width words that keep aggregates on hash maps;
# SHA-256 digests that differ share both with a probability of 2^-128.
WORDS = {half: f"xxhash64(substr({DIGEST}, {at}, 32))" for half, at in zip(HALVES, (1, 33))}


def digest_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row per digest and key: rows on each side."""

    def marked(df: DataFrame, own: str) -> DataFrame:
        words = [f"{word} AS {half}" for half, word in WORDS.items()]
        return df.selectExpr(*words, KEY, *[f"{int(side == own)}L AS {side}_rows" for side in SIDES])

    sums = [F.sum(f"{side}_rows").alias(f"{side}_rows") for side in SIDES]
    return marked(source, "source").unionByName(marked(target, "target")).groupBy(*HALVES, KEY).agg(*sums)


def key_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row per key: rows on each side, pairs, and pairs with equal digests."""
    sums = [F.sum(f"{side}_rows").alias(f"{side}_rows") for side in SIDES]
    same = F.sum(product("source_rows", "target_rows")).cast(PAIRS).alias("same_pairs")
    per_key = digest_counts(source, target).groupBy(KEY).agg(*sums, same)
    return per_key.withColumn("pairs", product("source_rows", "target_rows"))


# Share of rows that may have a key of an earlier row where keys count as nearly unique.
# approx_count_distinct is off by 5 % as a rule, which can change the plan but no count.
REPEATED = 0.15


def nearly_unique(keys: DataFrame) -> bool:
    """Whether few rows share their key: one number per task, nothing else is shuffled."""
    found = keys.agg(F.count("*").alias("all"), F.approx_count_distinct(KEY).alias("distinct")).first()
    return found["distinct"] >= (1 - REPEATED) * found["all"]


def key_sums(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row per key, in one shuffle: rows on each side, whether each side has one digest, and whether those are equal."""

    def marked(df: DataFrame, own: str) -> DataFrame:
        return df.selectExpr(
            KEY,
            *[f"{int(side == own)}L AS {side}_rows" for side in SIDES],
            *[f"{WORDS[half] if side == own else 'CAST(NULL AS BIGINT)'} AS {side}_{half}" for side in SIDES for half in HALVES],
        )

    words = [f"{side}_{half}" for side in SIDES for half in HALVES]
    sums = marked(source, "source").unionByName(marked(target, "target")).groupBy(KEY).agg(
        *[F.sum(f"{side}_rows").alias(f"{side}_rows") for side in SIDES],
        *[F.min(word).alias(f"{word}_min") for word in words],
        *[F.max(word).alias(f"{word}_max") for word in words],
    )
    # a side without rows has neither smallest nor largest
    single = " AND ".join(f"{word}_min <=> {word}_max" for word in words)
    same = " AND ".join(f"source_{half}_min <=> target_{half}_min" for half in HALVES)
    return sums.selectExpr(KEY, "source_rows", "target_rows", f"{single} AS single", f"{same} AS same")


IS_PLAIN = "single AND same AND source_rows = 1 AND target_rows = 1"
IS_PLAIN_COUNT = "source_rows = 1 AND target_rows = 1 AND same_pairs = 1"


def settled(sums: DataFrame) -> DataFrame:
    """Ledger records of the keys that their sums settle and that aren't plain."""
    return sums.where("single").withColumn("pairs", product("source_rows", "target_rows")).select(
        KEY,
        F.lit(False).alias("plain"),
        "source_rows",
        "target_rows",
        F.when(F.col("same"), F.col("pairs")).otherwise(F.lit(0)).cast(PAIRS).alias("same_pairs"),
        "pairs",
    )


def counted(counts: DataFrame) -> DataFrame:
    """Ledger records of the keys whose digests were counted one by one."""
    return counts.select(KEY, F.lit(False).alias("plain"), "source_rows", "target_rows", "same_pairs", "pairs")


def plain_record(like: DataFrame, keys: int) -> DataFrame:
    """All plain keys (one row per side, equal) as one record."""
    number = F.lit(Decimal(keys))
    kinds = {"source_rows": "bigint", "target_rows": "bigint", "same_pairs": PAIRS, "pairs": PAIRS}
    one = like.sparkSession.range(1 if keys else 0)
    return one.select(
        F.lit(None).cast(like.schema[KEY].dataType).alias(KEY),
        F.lit(True).alias("plain"),
        *[number.cast(kind).alias(name) for name, kind in kinds.items()],
    )


# size of one listed key, for lists that may be broadcast
KEY_BYTES = f"octet_length(CAST({KEY} AS STRING)) + 24L"


def key_bytes(records: DataFrame, listed: Column) -> int:
    """Measured size of the listed keys."""
    return records.where(listed).agg(F.expr(f"CAST({_total(KEY_BYTES)} AS BIGINT)")).first()[0]


def in_source_only() -> Column:
    return F.col("target_rows") == 0


def in_target_only() -> Column:
    return F.col("source_rows") == 0


def is_changed() -> Column:
    return F.col("pairs") > F.col("same_pairs")


def is_crowded(rows: int) -> Column:
    """Keys with more than ``rows`` rows on both sides."""
    return F.least("source_rows", "target_rows") > rows


def _total(value: str, where: str = "true") -> str:
    return f"coalesce(sum({value}) FILTER (WHERE {where}), 0)"


def count_columns() -> list[Column]:
    """The aggregates that turn key counts (or a ledger) into one row of counts."""
    sums = {
        "source_rows": _total("source_rows"),
        "target_rows": _total("target_rows"),
        "source_only": _total("source_rows", "target_rows = 0"),
        "target_only": _total("target_rows", "source_rows = 0"),
        "matched": f"CAST({_total('pairs')} AS {PAIRS})",
        "changed": f"CAST({_total('pairs - same_pairs')} AS {PAIRS})",
    }
    return [F.expr(value).alias(name) for name, value in sums.items()]


COUNTS = ("source_rows", "target_rows", "source_only", "target_only", "matched", "changed")


def counts_of(key_records: DataFrame) -> DataFrame:
    """One row: rows per side, one-sided rows, matched pairs, changed pairs."""
    return key_records.agg(*count_columns())


@dataclass(frozen=True)
class Totals:
    """What the driver needs to know about a ledger: one row of numbers."""

    source_rows: int
    target_rows: int
    source_only: int
    target_only: int
    matched: int
    changed: int
    changed_rows: int
    crowded_changed: int
    crowded_pairs: Decimal
    heaviest: int
    most_pairs: Decimal
    source_only_bytes: int
    target_only_bytes: int
    changed_bytes: int
    crowded_bytes: int


def totals(records: DataFrame, pair_rows: int) -> Totals:
    """Sum up a ledger, with the exact size of each key list that may be broadcast."""
    crowded = f"NOT plain AND least(source_rows, target_rows) > {pair_rows}"
    sums = {
        "changed_rows": _total("source_rows + target_rows", "pairs > same_pairs"),
        "crowded_changed": f"CAST({_total('pairs - same_pairs', crowded)} AS {PAIRS})",
        "crowded_pairs": f"CAST({_total('pairs', f'{crowded} AND pairs > same_pairs')} AS {PAIRS})",
        "heaviest": "coalesce(max(greatest(source_rows, target_rows)) FILTER (WHERE NOT plain), 0)",
        "most_pairs": "coalesce(max(pairs) FILTER (WHERE NOT plain), 0)",
        "source_only_bytes": _total(KEY_BYTES, "target_rows = 0"),
        "target_only_bytes": _total(KEY_BYTES, "source_rows = 0"),
        "changed_bytes": _total(KEY_BYTES, "pairs > same_pairs"),
        "crowded_bytes": _total(KEY_BYTES, crowded),
    }
    row = records.agg(*count_columns(), *[F.expr(value).alias(name) for name, value in sums.items()]).first()
    values = row.asDict()
    for name in ("matched", "changed", "crowded_changed"):
        values[name] = int(values[name])
    return Totals(**values)
