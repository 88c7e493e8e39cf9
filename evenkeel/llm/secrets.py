"""Secret scans that weigh each candidate by who owns its copies.

Candidates are found per text with regular expressions. Their hashes are then counted over
the whole corpus by distinct owner and repository: a value that many owners share is a
copied example (where values are masked, also one in very many repositories), one that stays with an owner or two and looks random is ``live``, the
rest is ``weak``. DataFrame functions only.

Positions are code points, ends exclusive. They come from the lengths of the pieces between
the matches, as Spark has no function that returns the place of a match.

Cases: a NULL text is the empty text and has no spans. NULL owners count as one owner, and
NULL repositories as one repository. A repository is told apart within its owner, so the
same name under two owners counts twice. Repeated rows are scanned one by one but count as
one repository. Spans of several kinds may overlap; equal starts are ordered by kind.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import read_table, shared_folder, unused, written


@dataclass(frozen=True)
class Kind:
    """What to look for: ``group`` holds the secret itself, which needs ``least`` characters."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1


BASE_KINDS = (
    Kind(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    # a shorter run holds no longer one, so the least length can stand in the pattern of these two
    Kind("access", r"AKIA[A-Z0-9]{16,}"),
    Kind("hex", r"[0-9a-f]{24,}"),
)
ADDED_KINDS = (
    Kind("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Kind("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
    Kind("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
KINDS = BASE_KINDS + ADDED_KINDS
#: what is masked of a private key is its body, up to the END line or, in a cut text, as far as lines of base64 go
KEY_BODY = Kind(
    "pem",
    r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
    r"([^-]*+(?:-(?!----)[^-]*+)*+(?=-----END [A-Z ]{0,40}PRIVATE KEY-----)|(?:(?:\s|\\[nr])*+[A-Za-z0-9+/=]{40,}+){0,400}+)",
    group=1,
    least=32,
)
MASKED_KINDS = tuple(KEY_BODY if kind.name == "pem" else kind for kind in KINDS)
#: from so many owners on, a value is a copied example
SHARED_OWNERS = 3
#: what is masked is also no example: from so many repositories on, a value is one, whoever owns them
SHARED_REPOSITORIES = 1_000
#: a live value has at least so many different characters
RANDOM_CHARACTERS = 8
MASK = "[secret]"


def _matches(text: Column, kind: Kind, rank: int) -> Column:
    """The spans of one kind: array of (start, rank, end, value)."""
    regex = F.lit(kind.pattern)
    lengths = F.transform(F.regexp_extract_all(text, regex, F.lit(0)), F.length)
    values = F.regexp_extract_all(text, regex, F.lit(kind.group))
    gaps = F.transform(F.split(text, kind.pattern, -1), F.length)
    pieces = F.arrays_zip(gaps.alias("gap"), lengths.alias("size"), values.alias("value"))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,value:string>>")

    def add(state: Column, piece: Column) -> Column:
        start = state["at"] + piece["gap"]
        end = start + F.coalesce(piece["size"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), piece["value"].alias("value"))
        kept = F.when(F.length(piece["value"]) >= kind.least, F.concat(state["spans"], F.array(span)))
        return F.struct(end.alias("at"), F.coalesce(kept, state["spans"]).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    spans = F.aggregate(pieces, begin, add, lambda state: state["spans"])
    return F.when(text.rlike(kind.pattern), spans).otherwise(empty)


def find_spans(text: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """All spans of a text by start, then kind: array of (start, rank, end, value)."""
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(*(_matches(text, kind, rank) for rank, kind in enumerate(kinds))))


def has_candidate(text: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    text = F.coalesce(text, F.lit(""))
    return reduce(or_, (text.rlike(kind.pattern) for kind in kinds))


def span_list(spans: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """The spans as ``kind:start:end``, comma-joined."""
    names = F.array(*(F.lit(kind.name) for kind in kinds))
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["rank"]), x["start"], x["end"])), ","
    )


def secret_hash(value: Column) -> Column:
    return F.sha2(value, 256)


def masked_hash(value: Column) -> Column:
    """The hash of a value however its lines are broken; only the body of a key has several."""
    return secret_hash(F.regexp_replace(value, r"\s|\\[nr]", ""))


def ownership(found: DataFrame, shared_owners: int = SHARED_OWNERS, shared_repositories: int | None = None) -> DataFrame:
    """(hash, owners, repositories, standing) of (hash, owner, repository, value_is_random) rows.

    Duplicates go before the counts, and each count has a partial step on the map side, so a
    value in a third of all rows shrinks to one row per owner before its rows meet. Without
    ``shared_repositories`` owners alone make a value shared, as in the SQL counterpart of the scan.
    """
    places = found.groupBy("hash", "owner", "repository").agg(F.max("value_is_random").alias("value_is_random"))
    owners = places.groupBy("hash", "owner").agg(
        F.count("*").alias("repositories"), F.max("value_is_random").alias("value_is_random")
    )
    totals = owners.groupBy("hash").agg(
        F.count("*").alias("owners"),
        F.sum("repositories").alias("repositories"),
        F.max("value_is_random").alias("value_is_random"),
    )
    shared = F.col("owners") >= shared_owners
    if shared_repositories is not None:
        shared |= F.col("repositories") >= shared_repositories
    standing = F.when(shared, "shared").when(F.col("value_is_random"), "live").otherwise("weak")
    return totals.select("hash", "owners", "repositories", standing.alias("standing"))


def _candidates(rows: DataFrame, *columns: str, hashed: Callable[[Column], Column] = secret_hash) -> DataFrame:
    """One row per different value of a text: the given columns, hash and value_is_random."""
    values = F.array_distinct(
        F.transform(
            "spans",
            lambda x: F.struct(
                hashed(x["value"]).alias("hash"),
                (F.size(F.array_distinct(F.split(x["value"], ""))) >= RANDOM_CHARACTERS).alias("value_is_random"),
            ),
        )
    )
    return rows.where(F.size("spans") > 0).select(*columns, F.inline(values))


def scan_secrets(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id"
) -> DataFrame:
    """One row per document: counts per base kind, all spans, and how many different values are live, shared or weak.

    The texts are read and matched once; what goes on is a table of spans in the shared
    folder, whose stored row numbers tie the verdicts back to the rows.
    """
    folder = shared_folder(documents.sparkSession)
    scanned = documents.select(
        F.col(doc_id).alias("doc_id"),
        F.col(owner).alias("owner"),
        F.col(repository).alias("repository"),
        find_spans(F.col(text)).alias("spans"),
    )
    rows = written(scanned.withColumn("row", F.monotonically_increasing_id()), folder, "secret_spans")
    found = _candidates(rows, "row", "owner", "repository")
    verdicts = found.select("row", "hash").join(ownership(found), "hash").groupBy("row").agg(
        *(F.count(F.when(F.col("standing") == name, True)).alias(f"n_{name}") for name in ("live", "shared", "weak"))
    )

    def of_kind(rank: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["rank"] == rank)).cast("long")

    digest = rows.select(
        "row",
        "doc_id",
        *(of_kind(rank).alias(f"n_{kind.name}") for rank, kind in enumerate(BASE_KINDS)),
        F.sha2(span_list(F.filter("spans", lambda x: x["rank"] < len(BASE_KINDS))), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )
    return digest.join(verdicts, "row", "left").drop("row").fillna(0, ["n_live", "n_shared", "n_weak"])


def mask_live(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    n_chars: str = "n_chars",
    shared_repositories: int = SHARED_REPOSITORIES,
) -> DataFrame:
    """The documents, all of them, with live values replaced by a mask and ``n_chars`` counted anew.

    Only rows with a candidate are shuffled; all others pass through as they are. Rows with
    the same id share their verdicts.
    """
    key, spans, live = unused(documents, "secret_key", "spans", "live_hashes")
    marks = has_candidate(F.col(text), MASKED_KINDS)
    plain = documents.where(~marks)
    marked = documents.where(marks).withColumn(spans, find_spans(F.col(text), MASKED_KINDS))
    rows = marked.select(
        F.col(doc_id).alias("repository"), F.col(owner).alias("owner"), F.col(spans).alias("spans")
    )
    found = written(_candidates(rows, "repository", "owner", hashed=masked_hash), shared_folder(documents.sparkSession), "secret_values")
    verdicts = ownership(found, shared_repositories=shared_repositories).where("standing = 'live'").select("hash")
    per_document = (
        found.select("repository", "hash").distinct().join(verdicts, "hash")
        .groupBy(F.col("repository").alias(key)).agg(F.collect_set("hash").alias(live))
    )
    hit = F.filter(spans, lambda x: F.array_contains(F.col(live), masked_hash(x["value"])))
    # longer values first, as one may lie within another
    ordered = F.array_sort(F.transform(hit, lambda x: F.struct((-F.length(x["value"])).alias("size"), x["value"].alias("value"))))
    clean = F.aggregate(ordered, F.col(text), lambda held, x: F.replace(held, x["value"], F.lit(MASK)))
    changed = F.col(live).isNotNull()
    masked = marked.join(per_document, F.col(doc_id).eqNullSafe(F.col(key)), "left").withColumns(
        {
            text: F.when(changed, clean).otherwise(F.col(text)),
            n_chars: F.when(changed, F.length(clean).cast("long")).otherwise(F.col(n_chars)),
        }
    )
    return plain.unionByName(masked.select(documents.columns))


def secret_report(spark, sf_dir: str) -> DataFrame:
    """``op8``: the secrets of every document; a source owns its documents, each a repository."""
    return scan_secrets(read_table(spark, sf_dir, "documents"))


def mask_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: live secrets are masked, no document goes."""
    return mask_live(docs)
