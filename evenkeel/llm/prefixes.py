"""Prefix trie of conversations by recursive halving of depth, after van Emde Boas.

A conversation is a sequence of turns below the textless root, which stands at depth 0. Nodes of the trie
are the distinct prefixes. No task walks a whole conversation:

1. Sequences are cut into blocks of ``LEAF`` levels, one row each.
2. Recursion on depth: a stretch of blocks is cut at half its depth. The cut prefix gets a name, a hash of the name of
   the stretch's own root and that of the half above. The half above is an upper trie, the halves below
   are the forests hanging from the cut prefixes; both go on in the same way, all stretches of
   one size in one job. Going up (``halves``) names the halves, going down (``roots``) the cut
   prefixes: two jobs per doubling of the depth, and none for conversations of one block.
3. Inside a block the names follow from turn to turn. Members, smallest member and children are counted by name, with
   sums that combine before they are shuffled, so a prefix shared by all costs one record a task.
4. A node belongs to its smallest member, and what a conversation owns is a tail of its path. Totals are
   grafted upward from these tails: within a block, from block to block, and by name over all members.

Names are 128 bits of SHA-256. The digest of a node's ends needs the ids in order; each 4 096
neighbouring ids are joined first, and the digest reads these texts as a stream, never as one value.

Cases: rows without a conversation's id are left out. NULL roles and texts are empty. Turns are ordered by ``turn``,
NULL first, equal ones by a digest of role and text; repeated rows are turns of their own. An empty table has an empty
result, without a root. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import read_table, shared_folder, written

LEAF = 16
#: conversations are rebuilt from the first of their hundred
FAMILY = 100
MOST_HEAD = 5
#: ids joined into one text: 2^12 neighbours
ID_BITS = 12
#: parents with more children are hot; at most HOT_SHARE of them can be
HOT_CHILDREN = 1_000
HOT_SHARE = 20_000


def name_of(*parts: Column) -> Column:
    """128 bits that name a sequence of names of equal length."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def _root() -> Column:
    return name_of(F.lit(b"root"))


def numbered(conversations: DataFrame, folder: str, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, stretch, at, token, chars): every turn with its place from 1; texts aren't shuffled.

    Rows are dealt by ranges, so a conversation of any length lies in as many stretches as it needs. Only
    the first and last conversation of a stretch can go beyond it, so the list of what lies before is
    at most twice as long as there are stretches.
    """
    said, by = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text, role))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        name_of(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said).cast("binary")).alias("token"),
        F.length(said).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("copy"),
    )
    order = ["turn", "token", "copy"]
    ranged = rows.repartitionByRange("conv", *order).withColumn("stretch", F.spark_partition_id())
    ranged = written(ranged, folder, "ranged")
    edges = ranged.groupBy("stretch").agg(F.min("conv").alias("low"), F.max("conv").alias("high"))
    at_edge = ranged.join(F.broadcast(edges), "stretch").where("conv = low or conv = high").groupBy("conv", "stretch").count()
    before = Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = at_edge.select("conv", "stretch", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("conv", "stretch").orderBy(*order))
    local = ranged.withColumn("place", place)
    local = local.join(F.broadcast(offsets), ["conv", "stretch"], "left")
    at = F.col("place") + F.coalesce("before", F.lit(0))
    return written(local.select("conv", "stretch", at.alias("at"), "place", "token", "chars"), folder, "numbered")


def plain_sequences(turns: DataFrame) -> DataFrame:
    """(conv, depth, token, chars) of conversations as they are, the root included."""
    own = turns.select("conv", F.col("at").alias("depth"), "token", "chars")
    return own.unionByName(_tops(turns.where("at = 1").select("conv")))


def rebuilt_sequences(turns: DataFrame) -> DataFrame:
    """(conv, depth, token, chars) of rebuilt conversations, the root included.

    The first h turns come from the first conversation of the family, h = crc32 of the id modulo 6; own turns
    follow from h + 1 on. Joins go by conversation and stretch, so a long one is never in one task.
    """
    wanted = (F.crc32(F.col("conv").cast("string").cast("binary")) % (MOST_HEAD + 1)).cast("int")
    family = F.col("conv") - F.col("conv") % FAMILY
    first = turns.where((F.col("at") <= MOST_HEAD) & (F.col("conv") % FAMILY == 0))
    heads = first.groupBy(F.col("conv").alias("family")).agg(F.sort_array(F.collect_list(F.struct("at", "token", "chars"))).alias("head"))
    parts = turns.where("place = 1").select("conv", "stretch", F.col("at") == 1, wanted.alias("h"), family.alias("family"))
    parts = parts.toDF("conv", "stretch", "opens", "h", "family").join(heads, "family", "left")
    # slice of nothing is NULL, as is the head of an absent conversation
    parts = parts.withColumn("head", F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast("array<struct<at:bigint,token:binary,chars:bigint>>")))
    given = parts.where("opens").select("conv", F.inline("head")).select("conv", F.col("at").alias("depth"), "token", "chars")
    short = parts.select("conv", "stretch", "h", (F.col("h") - F.size("head")).alias("short"))
    own = turns.join(short, ["conv", "stretch"]).where("at > h").select("conv", (F.col("at") - F.col("short")).alias("depth"), "token", "chars")
    return given.unionByName(own).unionByName(_tops(turns.where("at = 1").select("conv")))


def _tops(convs: DataFrame) -> DataFrame:
    return convs.select("conv", F.lit(0).cast("long").alias("depth"), _root().alias("token"), F.lit(0).cast("long").alias("chars"))


def blocks(sequences: DataFrame) -> DataFrame:
    """(conv, block, steps): at most ``LEAF`` consecutive levels of a conversation a row."""
    at = F.floor(F.col("depth") / LEAF).alias("block")
    return sequences.groupBy("conv", at).agg(F.sort_array(F.collect_list(F.struct("depth", "token", "chars"))).alias("steps"))


def halves(parts: DataFrame) -> DataFrame:
    """(conv, part, upper, has_lower): stretches of twice the size, with the name of the half above."""
    pairs = parts.groupBy("conv", F.shiftright("part", 1).alias("above")).agg(
        F.max(F.when(F.col("part") % 2 == 0, F.col("name"))).alias("upper"),
        F.max(F.when(F.col("part") % 2 == 1, F.col("name"))).alias("lower"),
    )
    # what is on top and has nothing below hangs from the root, which is known
    return pairs.withColumnRenamed("above", "part").where("lower is not null or part > 0")


def roots(cells: DataFrame, folder: str) -> DataFrame:
    """(conv, block, root): the name of the prefix that each block but the first hangs from."""
    deepest = cells.agg(F.max("block")).first()[0] or 0
    joined = F.aggregate("steps", F.lit(b""), lambda whole, step: F.concat(whole, step["token"]))
    long = cells.where("block > 0").select("conv").distinct()
    parts = cells.join(long, "conv", "left_semi").select("conv", F.col("block").alias("part"), name_of(joined).alias("name"))
    levels = []
    for level in range(deepest.bit_length()):
        pairs = written(halves(parts), folder, f"halves_{level}")
        levels.append(pairs)
        parts = pairs.select("conv", "part", F.coalesce(name_of(F.col("upper"), F.col("lower")), "upper").alias("name"))
    named = None
    for level, pairs in reversed(list(enumerate(levels))):
        if named is not None:
            pairs = pairs.join(named, ["conv", "part"], "left")
        else:
            pairs = pairs.withColumn("root", F.lit(None).cast("binary"))
        root = F.coalesce("root", _root())
        below = F.struct((F.col("part") * 2 + 1).alias("part"), name_of(root, F.col("upper")).alias("root"))
        same = F.struct((F.col("part") * 2).alias("part"), root.alias("root"))
        both = F.when(F.col("lower").isNotNull(), F.array(same, below)).otherwise(F.array(same))
        named = written(pairs.select("conv", F.inline(both)).where("part > 0"), folder, f"roots_{level}")
    if named is None:
        return cells.select("conv", "block", F.lit(None).cast("binary").alias("root")).limit(0)
    return named.withColumnRenamed("part", "block")


def paths(cells: DataFrame, folder: str) -> DataFrame:
    """(conv, block, steps, names, parent, ends): the names of all prefixes ending in a block, and of the one before."""
    hung = cells.join(roots(cells, folder), ["conv", "block"], "left")
    start = F.array(F.coalesce("root", _root()))
    names = F.aggregate("steps", start, lambda held, step: F.concat(held, F.array(name_of(F.element_at(held, -1), step["token"]))))
    named = written(hung.select("conv", "block", "steps", F.slice(names, 2, LEAF).alias("names")), folder, "named")
    previous = named.select("conv", (F.col("block") + 1).alias("block"), F.element_at("names", -1).alias("parent"))
    following = named.where("block > 0").select("conv", (F.col("block") - 1).alias("block"), F.lit(True).alias("goes_on"))
    linked = named.join(previous, ["conv", "block"], "left").join(following, ["conv", "block"], "left")
    return written(linked.select("conv", "block", "steps", "names", "parent", F.col("goes_on").isNull().alias("ends")), folder, "paths")


def members(path: DataFrame) -> DataFrame:
    """One row per node: name, parent's name, depth, code points of the last text, members, smallest member."""
    at = F.transform(
        "names",
        lambda name, i: F.struct(
            name.alias("name"),
            F.when(i > 0, F.get("names", i - 1)).otherwise(F.col("parent")).alias("parent"),
            F.get("steps", i)["depth"].alias("depth"),
            F.get("steps", i)["chars"].alias("chars"),
        ),
    )
    return path.select("conv", F.inline(at)).groupBy("name", "parent", "depth", "chars").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"))


def totals(path: DataFrame, nodes: DataFrame, folder: str) -> DataFrame:
    """(name, n_leaves, saved_tokens): sums over subtrees, from what each conversation owns of its path."""
    value = F.struct("depth", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    owned = nodes.groupBy("conv", F.floor(F.col("depth") / LEAF).alias("block")).agg(F.collect_list(value).alias("owned"))

    def of(name: str) -> Column:
        return F.aggregate("owned", F.lit(0).cast("long"), lambda total, one: total + one[name])

    held = path.select("conv", "block", "steps", "names").join(owned, ["conv", "block"], "left")
    empty = F.array().cast("array<struct<depth:bigint,leaf:bigint,saved:bigint>>")
    held = held.withColumn("owned", F.coalesce("owned", empty)).withColumn("far", F.shiftright("block", 10))
    held = written(held.withColumns({"leaves_here": of("leaf"), "saved_here": of("saved")}), folder, "owned")
    # blocks after a block: those of the same thousand, and the sums of later thousands
    near = Window.partitionBy("conv", "far").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("conv").orderBy(F.desc("far")).rowsBetween(Window.unboundedPreceding, -1)
    sums = held.where("block > 0").groupBy("conv", "far").agg(F.sum("leaves_here").alias("x"), F.sum("saved_here").alias("y"))
    after_far = sums.unionByName(held.where("block = 0").select("conv", "far", F.lit(0).alias("x"), F.lit(0).alias("y")))
    after_far = after_far.groupBy("conv", "far").agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
    after_far = after_far.select(
        "conv", "far", *(F.coalesce(F.sum(n).over(later), F.lit(0)).alias(m) for n, m in (("x", "leaves_far"), ("y", "saved_far")))
    )
    near_sums = [F.coalesce(F.sum(f"{n}_here").over(near), F.lit(0)).alias(f"{n}_near") for n in ("leaves", "saved")]
    placed = held.select("conv", "far", "steps", "names", "owned", *near_sums).join(after_far, ["conv", "far"])

    def tail(i: Column, name: str, after: str) -> Column:
        depth = F.get("steps", i)["depth"]
        start = F.col(f"{after}_near") + F.col(f"{after}_far")
        return F.aggregate("owned", start, lambda total, one: total + F.when(one["depth"] >= depth, one[name]).otherwise(0))

    each = F.transform("names", lambda name, i: F.struct(name.alias("name"), tail(i, "leaf", "leaves").alias("x"), tail(i, "saved", "saved").alias("y")))
    return placed.select(F.inline(each)).groupBy("name").agg(F.sum("x").alias("n_leaves"), F.sum("y").alias("saved_tokens"))


def _stream_digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests of sorted (name, ids) rows: state is one digest, whatever a name's number of rows."""
    current, digest = None, None
    for frame in frames:
        done = []
        for name, ids in zip(frame["name"], frame["ids"], strict=True):
            name = bytes(name)
            if name != current:
                if current is not None:
                    done.append((current, digest.hexdigest()))
                current, digest = name, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pd.DataFrame(done, columns=["name", "ends_sha256"])
    if current is not None:
        yield pd.DataFrame([(current, digest.hexdigest())], columns=["name", "ends_sha256"])


def end_digests(path: DataFrame) -> DataFrame:
    """(name, ends_sha256) of nodes where conversations end."""
    ends = path.where("ends").select(F.element_at("names", -1).alias("name"), "conv")
    near = ends.groupBy("name", F.shiftright("conv", ID_BITS).alias("stretch")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    texts = near.select("name", "stretch", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    return texts.repartition("name").sortWithinPartitions("name", "stretch").select("name", "ids").mapInPandas(
        _stream_digests, "name binary, ends_sha256 string"
    )


def with_children(nodes: DataFrame, folder: str) -> DataFrame:
    """Adds ``n_children`` and ``parent_conv_id``; parents with very many children are sent to them, others are joined."""
    counts = nodes.where("parent is not null").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    counted = nodes.join(counts, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    counted = written(counted, folder, "counted")
    least = max(HOT_CHILDREN, counted.count() // HOT_SHARE)
    parents = counted.select(F.col("name").alias("parent"), F.col("conv").alias("parent_conv_id"), "n_children")
    hot = F.broadcast(parents.where(F.col("n_children") > least).drop("n_children"))  # at most HOT_SHARE rows
    others = parents.where(F.col("n_children").between(1, least)).drop("n_children")
    top = counted.where("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    below = counted.where("parent is not null")
    of_hot = below.join(hot, "parent").select(top.columns)
    rest = below.join(hot, "parent", "left_anti").join(others, "parent").select(top.columns)
    return written(top.unionByName(of_hot).unionByName(rest), folder, "nodes")


def prefix_trie(sequences: DataFrame, folder: str) -> DataFrame:
    """One row per node of the trie of (conv, depth, token, chars) sequences."""
    cells = written(blocks(sequences), folder, "blocks")
    path = paths(cells, folder)
    nodes = with_children(members(path), folder)
    out = nodes.join(totals(path, nodes, folder), "name").join(end_digests(path), "name", "left")
    return out.select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def conversation_trie(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", rebuilt: bool = False
) -> DataFrame:
    """The prefix trie of conversations; ``rebuilt`` gives each the head of its family's first one."""
    folder = shared_folder(conversations.sparkSession)
    turns = numbered(conversations, folder, conv_id, turn, role, text)
    return prefix_trie(rebuilt_sequences(turns) if rebuilt else plain_sequences(turns), folder)


def trie_report(spark, sf_dir: str) -> DataFrame:
    """``op13``: the trie of the rebuilt conversations."""
    return conversation_trie(read_table(spark, sf_dir, "conversations"), rebuilt=True)
