"""Projection operators and the preparation of one side for comparison."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions import rows
from evenkeel.functions.rows import DIGEST, KEY
from evenkeel.functions.values import holds_map, ordered_text, safe_text

KEY_MODES = ("concat", "typed")
DIGESTS = ("text", "safe")


def name_list(names: str | Sequence[str] | None) -> list[str]:
    """Names given as a list or as comma-separated text."""
    if names is None:
        return []
    parts = names.split(",") if isinstance(names, str) else names
    return [part.strip() for part in parts if part.strip()]


def quoted(name: str) -> Column:
    return F.col(rows.quote(name))


def project(df: DataFrame, columns: str | Sequence[str] = "*", exclude: str | Sequence[str] = ()) -> DataFrame:
    """Keep ``columns`` (default all) without ``exclude``; names match in any case."""
    wanted = name_list(columns)
    by_name = {name.lower(): name for name in df.columns}
    if wanted in ([], ["*"]):
        kept = list(df.columns)
    else:
        unknown = [name for name in wanted if name.lower() not in by_name]
        if unknown:
            raise ValueError(f"columns {unknown} not found among {df.columns}")
        kept = [by_name[name.lower()] for name in wanted]
    dropped = {name.lower() for name in name_list(exclude)}
    kept = [name for name in kept if name.lower() not in dropped]
    if not kept:
        raise ValueError("every column is excluded, nothing is left to select")
    return df.select(*[rows.quote(name) for name in kept])


def fold_names(df: DataFrame) -> DataFrame:
    """Lower-case all column names."""
    folded = [name.lower() for name in df.columns]
    twice = sorted(name for name, times in Counter(folded).items() if times > 1)
    if twice:
        raise ValueError(f"column names {twice} occur more than once when letter case is ignored")
    return df.toDF(*folded)


def normalize(df: DataFrame) -> DataFrame:
    """Lower-case names; NULL and NaN texts become the empty string."""
    df = fold_names(df)
    return df.select(*[
        rows.blank_missing(f.name) if rows.is_text(f.dataType) else rows.quote(f.name)
        for f in df.schema.fields
    ])


def with_key(df: DataFrame, keys: str | Sequence[str], key_mode: str = "concat") -> DataFrame:
    """Add the business key column."""
    names = [name.lower() for name in name_list(keys)]
    if not names:
        raise ValueError("at least one key column is needed")
    if key_mode not in KEY_MODES:
        raise ValueError(f"key_mode must be one of {KEY_MODES}, not {key_mode!r}")
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"key columns {missing} not found among {df.columns}")
    return df.withColumn(KEY, rows.joined_key(names) if key_mode == "concat" else rows.typed_key(names))


def with_digest(
    df: DataFrame,
    keys: str | Sequence[str],
    digest: str = "text",
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Add the row digest over all non-key columns (or those also in ``only``), by name."""
    if digest not in DIGESTS:
        raise ValueError(f"digest must be one of {DIGESTS}, not {digest!r}")
    left_out = {name.lower() for name in name_list(keys)} | {KEY}
    names = sorted(n for n in df.columns if n.lower() not in left_out and (only is None or n in only))
    if digest == "text":
        types = {name: df.schema[name].dataType for name in names}
        maps = {name: ordered_text(quoted(name), kind) for name, kind in types.items() if holds_map(kind)}
        return df.withColumn(DIGEST, rows.text_digest(names, maps))
    texts = [(name, safe_text(quoted(name), df.schema[name].dataType)) for name in names]
    return df.withColumn(DIGEST, rows.safe_digest(texts))


def keyed(df: DataFrame, keys: str | Sequence[str], key_mode: str = "concat") -> DataFrame:
    """Normalise one side and add its key: narrow work, no shuffle."""
    taken = [name for name in df.columns if name.lower() in (KEY, DIGEST)]
    if taken:
        raise ValueError(f"column names {taken} are reserved")
    return with_key(normalize(df), keys, key_mode)
