"""Joins by key that stay balanced when single keys hold a large share of the rows.

Rows of hot keys are dealt to several tasks by a salt, the number of the task that read
them, and what they meet is repeated for every salt. The pairs of a key form a rectangle, rows of the
source by rows of the target, that is cut both ways into cells, a task's share each; a row is repeated
along its own side's cells only. So each table is read and shuffled once, whatever its keys. A task
repeated after a lost executor reads the same split and gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.functions.rows import KEY
from evenkeel.operators.ledger import HALVES, SIDES

# A key is hot when it holds more than one part in HOT_SHARE of all rows,
# so there are never more than HOT_SHARE hot keys and their list can be broadcast.
HOT_SHARE = 200_000
MOST_SALTS = 256

SALT, HEAVY = "_salt", "_heavy"
TASKS, CELL, FIRST = "_tasks", "_cell", "_first"


def hot_threshold(all_rows: int, least_rows: int) -> int:
    return max(least_rows, -(-all_rows // HOT_SHARE))


def is_hot(threshold: int) -> Column:
    return F.greatest("source_rows", "target_rows") > threshold


def dealt_to(threshold: int, most_rows: int, most_pairs: int, count: int) -> Column:
    """Tasks that a key's pairs are dealt to, by its pairs and, if it is hot, its rows; 1 for ordinary keys."""
    by_pairs = F.ceil(F.col("pairs").cast("double") / F.lit(float(most_pairs)))
    by_rows = F.ceil((F.col("source_rows") + F.col("target_rows")) / F.lit(float(most_rows)))
    wanted = F.greatest(by_pairs, F.when(is_hot(threshold), by_rows).otherwise(1))
    return F.greatest(F.least(wanted, F.lit(count)), F.lit(1)).cast("int")


def _partitions(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def salts(df: DataFrame) -> int:
    """Tasks that the rows of a hot key are dealt to."""
    return min(MOST_SALTS, _partitions(df))


def places(df: DataFrame, pairs: int, most_pairs: int) -> int:
    """Partitions that pairs are made in: the session's number follows bytes, and few bytes can make many pairs."""
    return max(_partitions(df), min(MOST_SALTS, -(-pairs // most_pairs)))


def _tagged(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """The rows with ``HEAVY`` of their key (NULL for ordinary keys): a lookup in a broadcast list, no shuffle."""
    return rows.join(F.broadcast(hot), KEY, "left")


def _own_salt(count: int) -> Column:
    return F.pmod(F.col("_part"), F.lit(count))


def filter_by_keys(rows: DataFrame, records: DataFrame, listed: Column, how: str, small: bool, hot: Column | None) -> DataFrame:
    """Keep (``left_semi``) or drop (``left_anti``) the rows whose key is ``listed``.

    ``records`` holds one record per key. The listed keys are broadcast when their measured
    size allows it (``small``), and the rows are not shuffled at all. Otherwise rows and
    keys are shuffled, hot keys together with their salt.
    """
    keys = records.where(listed).select(KEY)
    if small:
        return rows.join(F.broadcast(keys), KEY, how)
    if hot is None:
        return rows.join(keys, KEY, how)
    count = salts(rows)
    heavy = records.where(hot).select(KEY, F.lit(True).alias(HEAVY))
    dealt = _tagged(rows.withColumn("_part", F.spark_partition_id()), heavy)
    dealt = dealt.withColumn(SALT, F.when(F.col(HEAVY), _own_salt(count)).otherwise(0))
    repeats = F.when(F.col(HEAVY), F.sequence(F.lit(0), F.lit(count - 1))).otherwise(F.array(F.lit(0)))
    places = _tagged(keys, heavy).select(KEY, F.explode(repeats).alias(SALT))
    return dealt.join(places, [KEY, SALT], how).select(rows.columns)


def cut(records: DataFrame, tasks: Column) -> DataFrame:
    """The keys with several ``tasks``, each with the parts its sides are cut into and the number of its first cell.

    Parts follow the sides' rows, so that cells are about square: that takes the fewest copies.
    """
    source, target = (F.greatest(F.col(f"{side}_rows"), F.lit(1)) for side in SIDES)
    heavy = records.select(KEY, "plain", *[f"{side}_rows" for side in SIDES], tasks.alias(TASKS))
    heavy = heavy.where(~F.col("plain") & (F.col(TASKS) > 1))
    source_parts = F.round(F.sqrt(F.col(TASKS) * source / target)).cast("bigint")
    heavy = heavy.withColumn("source_parts", F.greatest(F.least(source_parts, F.col(TASKS)), F.lit(1)).cast("int"))
    heavy = heavy.withColumn("target_parts", F.round(F.col(TASKS) / F.col("source_parts")).cast("int"))
    # numbered through, so that the cells of all keys are laid out evenly; no more rows than may be broadcast
    before = Window.orderBy(KEY).rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum(F.expr("source_parts * target_parts")).over(before), F.lit(0)).cast("int")
    return heavy.select(KEY, "source_parts", "target_parts", first.alias(FIRST))


def join_sides(source: DataFrame, target: DataFrame, records: DataFrame, tasks: Column | None, count: int) -> DataFrame:
    """Inner join of both sides by key; of a key with several ``tasks`` each task gets a part of the pairs.

    Both sides are cut into parts by digest and reading task, and each part goes to the cells it has
    pairs in: of n x m pairs in c cells, some sqrt(c) copies of both sides are shuffled. There are ``count`` partitions,
    so that neither few rows (with many pairs) nor a small file leave the pairs to one task.
    """
    if tasks is None:
        return source.join(target, KEY)
    parts = cut(records, tasks)
    # keys of two types are equal in the ledger's type
    ordinary = F.pmod(F.hash(F.col(KEY).cast(records.schema[KEY].dataType)), F.lit(count))

    def dealt(rows: DataFrame, side: str) -> DataFrame:
        tagged = _tagged(rows.withColumn("_part", F.spark_partition_id()), parts)
        words = [f"{side}_{half}" for half in HALVES]
        own = F.pmod(F.xxhash64(*words, "_part"), F.col(f"{side}_parts")).cast("int")
        if side == "source":
            start = F.col(FIRST) + own * F.col("target_parts")
            cells = F.sequence(start, start + F.col("target_parts") - 1)
        else:
            start = F.col(FIRST) + own
            cells = F.sequence(start, start + (F.col("source_parts") - 1) * F.col("target_parts"), F.col("target_parts"))
        cells = F.when(F.col(FIRST).isNull(), F.array(ordinary)).otherwise(cells)
        return tagged.select(*rows.columns, F.explode(cells).alias(CELL)).repartitionById(count, CELL)

    pairs = dealt(source, "source").join(dealt(target, "target").hint("merge"), [KEY, CELL])
    return pairs.drop(CELL)


def same_digest() -> Column:
    """Whether both rows of a pair have the same digest."""
    high, low = (F.col(f"source_{half}").eqNullSafe(F.col(f"target_{half}")) for half in HALVES)
    return high & low
