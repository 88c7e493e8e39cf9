"""Comparison of two tables by business key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from evenkeel.functions.rows import DIGEST, KEY, is_text
from evenkeel.operators import differences, ledger, schemas, spread
from evenkeel.operators.columns import fold_names, keyed, name_list, quoted, with_digest
from evenkeel.workspace import remove, shared_folder, written


@dataclass(frozen=True)
class Options:
    """How two sides are compared.

    ``key_mode``: "concat" joins key parts to one text, "typed" compares them one by one.
    ``digest``: "text" joins values to one text, "safe" keeps NULL and separators apart.
    ``digest_columns``: "all" non-key columns of each side, or the "common" ones only.
    The others choose a plan and never change a result:
    ``pair_rows``: keys with more rows than this on both sides have their columns counted
    by value instead of pair by pair.
    ``hot_rows``: rows of one key that may go to one task; keys with more are dealt to several.
    ``hot_pairs``: the same for the pairs of one key.
    ``broadcast_bytes``: largest list of differing keys, by measured size, that is sent to all executors.
    ``hot_list_bytes``: the same for the list of hot keys.
    """

    key_mode: str = "concat"
    digest: str = "text"
    digest_columns: str = "all"
    pair_rows: int = 16
    hot_rows: int = 1_000_000
    hot_pairs: int = 2_000_000
    broadcast_bytes: int = 32 << 20
    hot_list_bytes: int = 32 << 20

    def __post_init__(self) -> None:
        if self.digest_columns not in ("all", "common"):
            raise ValueError(f"digest_columns must be 'all' or 'common', not {self.digest_columns!r}")
        if min(self.pair_rows, self.hot_rows, self.hot_pairs) < 1:
            raise ValueError("pair_rows, hot_rows and hot_pairs must be positive")


#: How matched rows are listed: every pair, or every row once with its numbers of partners.
LAYOUTS = ("pairs", "rows")


def check_layout(layout: str) -> None:
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")


class Comparison:
    """Counts and difference sets of one table pair; every result is a DataFrame.

    Two steps. The first reads key and digest of both sides only and counts rows per key
    (``operators.ledger``). The second goes back to the full rows for the few keys that the
    first found to differ, so equal rows never travel with their columns. ``counts`` needs
    the first step alone; all share one ledger, written once.

    Matched rows are listed in the layout the caller asks for, the same for every key:
    ``pairs`` has m x n pairs for m rows against n, ``rows`` has m + n rows, each with its number
    of partners and of partners that differ. ``totals.matched`` says beforehand how many
    pairs there are. Used in a ``with`` statement, a comparison removes what it wrote.
    """

    def __init__(
        self, source: DataFrame, target: DataFrame, keys: str | Sequence[str], options: Options | None = None
    ) -> None:
        self.options = options or Options()
        self.keys = [name.lower() for name in name_list(keys)]
        self.columns = schemas.column_sets(source, target)
        only = None
        if self.options.digest_columns == "common":
            only = self.columns.common
        if self.options.key_mode == "typed":
            _check_key_types(fold_names(source), fold_names(target), self.keys)
        self._only = only
        self.source = keyed(source, self.keys, self.options.key_mode)
        self.target = keyed(target, self.keys, self.options.key_mode)
        self.spark = source.sparkSession
        self._changed: DataFrame | None = None
        self._folders: list[str] = []
        self._kept: dict[str, DataFrame] = {}

    def on(self, source: DataFrame, target: DataFrame) -> Comparison:
        """The same comparison over other copies of the two sides."""
        other = Comparison(source, target, self.keys, self.options)
        other._folders = self._folders
        return other

    def _digested(self, rows: DataFrame) -> DataFrame:
        return with_digest(rows, self.keys, self.options.digest, self._only)

    # first step: key and digest only

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write an intermediate table to the shared folder and go on from it."""
        self._folders.append(shared_folder(self.spark))
        return written(df, self._folders[-1], name)

    @cached_property
    def records(self) -> DataFrame:
        """The ledger: a record per key that needs attention and one for all others, written to the shared folder."""
        if not ledger.nearly_unique(self.source.select(KEY)):
            return self._counted_records()
        plain = Observation()
        sums = ledger.key_sums(self._digested(self.source), self._digested(self.target))
        sums = sums.observe(plain, F.count_if(F.expr(ledger.IS_PLAIN)).alias("keys"))
        kept = self.store(sums.where(f"NOT ({ledger.IS_PLAIN})"), "key_sums")
        records = ledger.plain_record(kept, plain.get["keys"]).unionByName(ledger.settled(kept))
        several = kept.where("NOT single").select(KEY)
        size = ledger.key_bytes(kept, ~F.col("single"))
        if not size:
            return records
        if size <= self.options.broadcast_bytes:
            several = F.broadcast(several)
        # key and digest alone are shuffled; a broadcast list drops the other rows before they are digested
        sides = [self._digested(self._rows(side)).select(KEY, DIGEST).join(several, KEY, "left_semi") for side in ledger.SIDES]
        counted = self.store(ledger.counted(ledger.key_counts(*sides)), "digest_counts")
        return records.unionByName(counted)

    def _counted_records(self) -> DataFrame:
        """The ledger where many keys have several rows: every row is read, digested and shuffled once."""
        plain = Observation()
        counts = self.key_counts().observe(plain, F.count_if(F.expr(ledger.IS_PLAIN_COUNT)).alias("keys"))
        kept = self.store(ledger.counted(counts.where(f"NOT ({ledger.IS_PLAIN_COUNT})")), "key_counts")
        return ledger.plain_record(kept, plain.get["keys"]).unionByName(kept)

    @cached_property
    def totals(self) -> ledger.Totals:
        return ledger.totals(self.records, self.options.pair_rows)

    def key_counts(self) -> DataFrame:
        """Rows per key on each side, pairs, and pairs with equal digests."""
        return ledger.key_counts(self._digested(self.source), self._digested(self.target))

    def row_counts(self) -> DataFrame:
        """One row, ``source_rows`` and ``target_rows``: no digest, nothing shuffled but a number per task."""
        sides = [
            rows.select(*[F.lit(int(name == side)).cast("bigint").alias(f"{name}_rows") for name in ledger.SIDES])
            for side, rows in (("source", self.source), ("target", self.target))
        ]
        sums = [F.coalesce(F.sum(f"{name}_rows"), F.lit(0)).alias(f"{name}_rows") for name in ledger.SIDES]
        return sides[0].unionAll(sides[1]).agg(*sums)

    def counts(self) -> DataFrame:
        """One row of counts."""
        return ledger.counts_of(self.records)

    def status_counts(self) -> DataFrame:
        """Rows (pairs where both sides have the key) per status."""
        return self.counts().selectExpr(
            f"""inline(array(
                struct('source_only' AS status, CAST(source_only AS {ledger.PAIRS}) AS row_count),
                struct('target_only' AS status, CAST(target_only AS {ledger.PAIRS}) AS row_count),
                struct('changed' AS status, changed AS row_count),
                struct('equal' AS status, CAST(matched - changed AS {ledger.PAIRS}) AS row_count)))"""
        ).where("row_count > 0")

    # second step: full rows of the keys that matter

    @cached_property
    def _threshold(self) -> int:
        rows = self.totals.source_rows + self.totals.target_rows
        return spread.hot_threshold(rows, self.options.hot_rows)

    @cached_property
    def _hot(self) -> Column | None:
        """The condition for hot keys; None without any, or with a list too long to be sent out.

        Then only adaptive execution splits what such keys make too large.
        """
        if self.totals.heaviest <= self._threshold:
            return None
        hot = spread.is_hot(self._threshold) & ~F.col("plain")
        return hot if ledger.key_bytes(self.records, hot) <= self.options.hot_list_bytes else None

    @cached_property
    def _places(self) -> int:
        return spread.places(self.records, self.totals.matched, self.options.hot_pairs)

    @cached_property
    def _tasks(self) -> Column | None:
        """In how many parts the pairs of each key are made; None where every key has one, or the list is too long."""
        if self.totals.heaviest <= self._threshold and self.totals.most_pairs <= self.options.hot_pairs:
            return None
        # a task's share of all pairs and of all rows is as much as any need be cut into
        rows = self.totals.source_rows + self.totals.target_rows
        most_rows = min(self._threshold, -(-rows // self._places))
        most_pairs = max(self.options.hot_pairs, -(-self.totals.matched // self._places))
        tasks = spread.dealt_to(self._threshold, most_rows, most_pairs, min(self._places, spread.MOST_SALTS))
        size = ledger.key_bytes(self.records, (tasks > 1) & ~F.col("plain"))
        return tasks if size <= self.options.hot_list_bytes else None

    def _filtered(self, side: str, where: Column, size: int) -> DataFrame:
        """One side's rows of the listed keys, from the kept rows if there are any."""
        small = size <= self.options.broadcast_bytes
        listed = where & ~F.col("plain")
        if side in self._kept:
            return spread.filter_by_keys(self._kept[side], self.records, listed, "left_semi", small, self._hot)
        return self._digested(spread.filter_by_keys(self._rows(side), self.records, listed, "left_semi", small, self._hot))

    def _rows(self, side: str) -> DataFrame:
        return self.source if side == "source" else self.target

    def keep_differing_rows(self) -> None:
        """Store the rows of one-sided and changed keys, if those keys can be broadcast.

        One more scan per side then serves all difference sets. With more keys than that,
        a second copy of the tables would cost more than it saves, and nothing is stored.
        """
        one_sided = {
            "source": (ledger.in_source_only(), self.totals.source_only_bytes),
            "target": (ledger.in_target_only(), self.totals.target_only_bytes),
        }
        for side, (alone, size) in one_sided.items():
            size += self.totals.changed_bytes
            if side not in self._kept and size <= self.options.broadcast_bytes:
                rows = self._filtered(side, alone | ledger.is_changed(), size)
                self._kept[side] = self.store(rows, f"{side}_rows")

    @property
    def _crowded(self) -> Column:
        return ledger.is_crowded(self.options.pair_rows)

    @property
    def _same_digest_columns(self) -> bool:
        """Whether the digests of both sides cover the common columns and no other."""
        return self.options.digest_columns == "common" or set(self.source.columns) == set(self.target.columns)

    @property
    def _mostly_changed(self) -> bool:
        """Whether a filter by changed keys would keep most rows of both sides."""
        rows = self.totals.source_rows + self.totals.target_rows
        return not self._kept and 2 * self.totals.changed_rows > rows

    def source_only(self) -> DataFrame:
        """Source rows whose key the target lacks."""
        return self._filtered("source", ledger.in_source_only(), self.totals.source_only_bytes)

    def target_only(self) -> DataFrame:
        """Target rows whose key the source lacks."""
        return self._filtered("target", ledger.in_target_only(), self.totals.target_only_bytes)

    def _side_of_pairs(self, side: str, where: Column | None) -> DataFrame:
        rows = self._digested(self._rows(side)) if where is None else self._filtered(side, where, self.totals.changed_bytes)
        words = [F.expr(word).alias(f"{side}_{half}") for half, word in ledger.WORDS.items()]
        return rows.select(KEY, *words, F.struct(*_data_columns(rows)).alias(side))

    def _pairs(self, where: Column | None) -> DataFrame:
        """All pairs of rows with the same key, of all keys or those listed."""
        sides = [self._side_of_pairs(side, where) for side in ledger.SIDES]
        return spread.join_sides(*sides, self.records, self._tasks, self._places)

    def _changed_pairs(self, where: Column | None = None) -> DataFrame:
        if where is None and not self._mostly_changed:
            where = ledger.is_changed()
        return self._pairs(where).where(~spread.same_digest())

    def _listed_rows(self, changed: bool) -> DataFrame:
        """Rows of both sides that have partners, each once, with how many partners there are and how many differ."""
        where = ledger.is_changed() if changed and not self._mostly_changed else None
        both = [
            self._digested(self._rows(side)) if where is None else self._filtered(side, where, self.totals.changed_bytes)
            for side in ledger.SIDES
        ]
        # the digest's words come first: sorts then compare numbers, not the few texts of keys with many rows
        by = [*ledger.HALVES, KEY]
        per_digest = ledger.digest_counts(*both).select(*by, *[F.col(f"{side}_rows").alias(f"same_{side}") for side in ledger.SIDES])
        # keys left out of the ledger have one row on each side
        per_key = self.records.where("NOT plain").select(KEY, *[f"{side}_rows" for side in ledger.SIDES])
        numbers = per_digest.join(per_key, KEY, "left")
        parts = []
        for side, other, rows in (("source", "target", both[0]), ("target", "source", both[1])):
            partners = F.coalesce(f"{other}_rows", F.lit(1))
            mine = numbers.where(F.col(f"same_{side}") > 0).select(
                *by, partners.alias("partners"), (partners - F.col(f"same_{other}")).alias("unequal_partners")
            )
            words = [F.expr(word).alias(half) for half, word in ledger.WORDS.items()]
            data = F.struct(*[quoted(name) for name in rows.columns if name != KEY]).alias(side)
            listed = rows.select(*words, KEY, data).join(mine.where("partners > 0"), by)
            parts.append(listed.select(KEY, F.lit(side).alias("side"), side, "partners", "unequal_partners"))
        listed = parts[0].unionByName(parts[1], allowMissingColumns=True)
        listed = listed.select(KEY, "side", "source", "target", "partners", "unequal_partners")
        return listed.where("unequal_partners > 0") if changed else listed

    def matched(self, layout: str = "pairs") -> DataFrame:
        """All rows whose key is on both sides.

        ``pairs``: key, ``source``, ``target`` for every pair. ``rows``: key, ``side``, the row in the
        column of its side, ``partners`` and ``unequal_partners``, for every row.
        """
        check_layout(layout)
        return self._listed_rows(False) if layout == "rows" else self._pairs(None).select(KEY, "source", "target")

    def changed(self, layout: str = "pairs") -> DataFrame:
        """As ``matched``, but only pairs with unequal digests, or rows with a partner that differs."""
        check_layout(layout)
        if layout == "rows":
            return self._listed_rows(True)
        return self._changed if self._changed is not None else self._changed_pairs().select(KEY, "source", "target")

    def use_changed(self, stored: DataFrame) -> None:
        """Go on from a written copy of ``changed`` (as pairs) instead of computing it again."""
        self._changed = stored

    def classified(self, layout: str = "pairs") -> DataFrame:
        """The full outer join by key: every row or pair with its status and both sides.

        Built from the two one-sided sets and the matched rows, which deal hot keys out; an
        outer join cannot. The status of a matched row or pair is ``equal`` or ``changed``.
        """
        check_layout(layout)
        if layout == "rows":
            matched, differs = self._listed_rows(False), F.col("unequal_partners") > 0
        else:
            matched, differs = self._pairs(None), ~spread.same_digest()
        whole = matched.select(F.when(differs, "changed").otherwise("equal").alias("status"), KEY, "source", "target")
        for side, rows in (("source", self.source_only()), ("target", self.target_only())):
            data = F.struct(*_data_columns(rows)).alias(side)
            part = rows.select(F.lit(f"{side}_only").alias("status"), KEY, data)
            whole = whole.unionByName(part, allowMissingColumns=True)
        return whole

    def column_differences(self) -> DataFrame:
        """Per common non-key column, in how many changed pairs it differs; zeros left out."""
        names = [name for name in self.columns.common if name not in self.keys]
        if not names or not self.totals.changed:
            return self.spark.createDataFrame([], differences.SCHEMA)
        kinds = differences.types_by_name(self.source), differences.types_by_name(self.target)
        if self._changed is not None:
            return differences.summed(differences.counted_in_pairs(self._changed, names, *kinds))
        parts = []
        if self.totals.changed > self.totals.crowded_changed:
            ordinary = ledger.is_changed() & ~self._crowded if self.totals.crowded_changed else None
            parts.append(differences.counted_in_pairs(self._changed_pairs(ordinary), names, *kinds))
        if self.totals.crowded_changed:
            wanted = self._crowded & ledger.is_changed()
            rows = [self._filtered(side, wanted, self.totals.crowded_bytes) for side in ledger.SIDES]
            told_apart = self._same_digest_columns and differences.digests_tell_apart(*rows, names)
            parts.append(differences.counted_by_value(*rows, names, self.totals.crowded_pairs, told_apart, self.store))
        return differences.summed(*parts)

    @cached_property
    def differing(self) -> dict[str, int]:
        """The same counts on the driver: at most one number per column."""
        return {row["column_name"]: int(row["differences"]) for row in self.column_differences().collect()}

    def metrics(self) -> DataFrame:
        """One row: all counts, the number of differing columns and the verdict."""
        known = [F.lit(Decimal(getattr(self.totals, name))) for name in ledger.COUNTS]
        kinds = ["bigint"] * 4 + [ledger.PAIRS] * 2
        found = self.column_differences().agg(F.count("*").alias("differing_columns"))
        return found.select(
            *[value.cast(kind).alias(name) for value, kind, name in zip(known, kinds, ledger.COUNTS)],
            F.lit(len(self.columns.common)).cast("bigint").alias("common_columns"),
            "differing_columns",
        ).withColumn("is_match", is_match())

    def verdict(self) -> DataFrame:
        """One row, ``is_match``: no one-sided rows and no differing column."""
        return self.metrics().select("is_match")

    def close(self) -> None:
        """Remove the tables written for this comparison; its results must not be read after."""
        for folder in self._folders:
            remove(self.spark, folder)
        self._folders.clear()

    def __enter__(self) -> Comparison:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def schema_diff(self) -> DataFrame:
        """Column names per side."""
        return schemas.schema_diff(self.source.drop(KEY), self.target.drop(KEY))


def is_match() -> Column:
    return (F.col("source_only") == 0) & (F.col("target_only") == 0) & (F.col("differing_columns") == 0)


def compare(
    source: DataFrame, target: DataFrame, keys: str | Sequence[str], options: Options | None = None
) -> Comparison:
    """Compare two tables by key; nothing is read until a result is asked for."""
    return Comparison(source, target, keys, options)


def _data_columns(df: DataFrame) -> list[Column]:
    return [quoted(name) for name in df.columns if name != KEY]


def _check_key_types(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> None:
    left, right = differences.types_by_name(source), differences.types_by_name(target)
    for name in keys:
        kinds = left.get(name), right.get(name)
        if None not in kinds and is_text(kinds[0]) != is_text(kinds[1]):
            raise ValueError(
                f"key column {name!r} is {kinds[0].simpleString()} on one side and "
                f"{kinds[1].simpleString()} on the other; typed keys need the same kind of type"
            )


__all__ = ["Comparison", "Options", "compare", "is_match"]
