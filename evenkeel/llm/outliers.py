"""Quality rules: countable faults of a text, and robust multivariate outliers per language and source.

1. Countable statistics of every text (words, characters, symbols, repeated lines and windows of words).
   A text fails at once by two fixed rules (``base_failed``).
2. Shares made of them (length of words, symbols, capitals, punctuation, repeated words) are drawn
   towards those of the text's group by ``PRIOR`` words, as a text of few words says little, put on a
   log scale and rounded to 1/1024. All sums that follow are sums of whole numbers, so no result
   depends on the order of rows or on a task that ran again.
3. A group is a language and source. Pairs with fewer than ``LEAST_ROWS`` texts form one group per
   language, languages where these are still fewer one group in all; texts of a group that is
   too small even then get no verdict of the second kind and stay.
4. Minimum covariance determinant per group (Rousseeuw 1985; deterministic starts after Hubert, Rousseeuw,
   Verdonck 2012): each start gives a centre and a covariance; a concentration step takes the
   ``SHARE`` of rows nearest by Mahalanobis distance and computes both from them. After ``TRIES`` steps the start with the
   smallest determinant goes on until the determinant falls no further. The nearest rows are found
   from sums per distance bin (32 to a doubling): one scan and one small shuffle a step, no sort of a group.
   The subset ends at a bin's edge, so it holds the wanted share or a little more.
5. The estimate is scaled by the median distance, computed once more from all rows within the 97.5 % quantile,
   and a text beyond the ``CUTOFF`` quantile is an outlier. ``FLOOR`` is added to the spread of each
   statistic, so groups whose statistics hardly vary (or don't at all) reject nothing for a trifle.

DataFrame functions only. Cases: a NULL text has no words and fails by rule one. NULL languages and
sources are a category of their own. Repeated rows count as often as they occur, each gets its row. An empty table has
an empty result.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import BLANKS, read_table, shared_folder, written
from evenkeel.llm.fingerprints import let

WINDOW = 5
FEWEST_WORDS = 10
MOST_REPEATED = 20
#: words that a group's own shares count for in each text's
PRIOR = 50
SCALE = 1024
CLIP = 8 * SCALE
LEAST_ROWS = 50
SHARE = 0.75
FLOOR = 0.15
TRIES = 2
#: a step must lower the log of the determinant by this much for another to follow
LEAST_GAIN = 1e-6
BINS_PER_DOUBLING = 32
#: quantiles of chi-square with five degrees of freedom (fixed values): 0.5, 0.975 and 0.9999
MEDIAN, INNER, CUTOFF = 4.35146, 12.83250, 25.74483
#: 0.975 over the share of chi-square with seven degrees of freedom below the 0.975 quantile above
INNER_FACTOR = 0.975 / 0.923765

#: name, numerator, denominator, and the share up to which more hardly tells from none; of repeats, rule one allows as much
SHARES = [
    ("length", "word_chars", "n_words", 0.5),
    ("symbols", "n_symbols", "n_words", 0.02),
    ("capitals", "n_capitals", "word_chars", 0.01),
    ("points", "n_points", "word_chars", 0.01),
    ("repeats", "n_repeat_words", "n_words", MOST_REPEATED / 100),
]
SIZE = len(SHARES)
Z = [f"z{i}" for i in range(SIZE)]
CENTRE = [f"m{i}" for i in range(SIZE)]
PAIRS = [(i, j) for i in range(SIZE) for j in range(i + 1)]
SPREAD = [f"c{i}{j}" for i, j in PAIRS]
GROUP = ["language", "origin"]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def count_of(characters: str, text: Column) -> Column:
    """How many characters of the class ``[characters]`` a text has."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", "")).cast("long")


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """How many words stand in windows of ``width`` words that occur twice or more in the text."""

    def covered(starts: Column) -> Column:
        ends = F.transform(starts, lambda at, i: F.least(F.lit(width), F.coalesce(F.get(starts, i + 1) - at, F.lit(width))))
        return F.aggregate(ends, F.lit(0).cast("long"), lambda total, one: total + one)

    def starts_of(marked: Column) -> Column:
        twice = F.filter(
            marked,
            lambda x, i: x["hash"].eqNullSafe(F.get(marked, i - 1)["hash"]) | x["hash"].eqNullSafe(F.get(marked, i + 1)["hash"]),
        )
        return F.sort_array(F.transform(twice, lambda x: x["at"]))

    def count(hashes: Column) -> Column:
        marked = F.transform(hashes, lambda hash_, at: F.struct(hash_.alias("hash"), at.alias("at")))
        many = let(F.sort_array(marked), lambda ordered: let(starts_of(ordered), covered))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(many)

    def windows(hashed: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(hashed) - width)
        return F.transform(places, lambda at: F.xxhash64(*(F.get(hashed, at + n) for n in range(width))))

    hashed = F.transform(words, lambda word: F.xxhash64(word))
    return F.when(F.size(words) > width, let(let(hashed, windows), count)).otherwise(F.lit(0).cast("long"))


def repeated_lines(text: Column) -> Column:
    """How many lines that have a word equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda held: (F.size(held) - F.size(F.array_distinct(held))).cast("long"))


def statistics(documents: DataFrame, doc_id: str, text: str, language: str, source: str) -> DataFrame:
    """doc_id, language, source and the counts of every row; one pass over the texts, nothing is shuffled."""
    rows = documents.select(
        F.col(doc_id).alias("doc_id"),
        _category(F.col(language)).alias("language"),
        _category(F.col(source)).alias("origin"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    value = F.col("text")
    words = F.array_remove(F.split(value, BLANKS), "")
    pair = let(words, lambda held: F.struct(F.size(held).cast("long").alias("n"), repeated_words(held).alias("repeats")))
    return rows.select(
        "doc_id",
        *GROUP,
        pair.alias("words"),
        F.length(F.regexp_replace(value, BLANKS, "")).cast("long").alias("word_chars"),
        count_of("#*$%&|<>", value).alias("n_symbols"),
        repeated_lines(value).alias("n_dup_lines"),
        count_of("A-Z", value).alias("n_capitals"),
        count_of(r"!\x22'(),\-./:;=?@\[\\\]_`{}~+\^", value).alias("n_points"),
    ).select(
        "doc_id",
        *GROUP,
        F.col("words.n").alias("n_words"),
        F.col("words.repeats").alias("n_repeat_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_capitals",
        "n_points",
    )


def _category(value: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


def with_groups(rows: DataFrame, least_rows: int) -> DataFrame:
    """Adds ``base_failed`` and names each row's group; ``judged`` tells rows of groups that are large enough."""
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    pairs = rows.where("not base_failed").groupBy(*GROUP).count()
    # a table of languages and sources, however large, with the group of each pair
    by_origin = pairs.withColumn("to_origin", F.when(F.col("count") >= least_rows, F.col("origin")).otherwise("*"))
    rest = by_origin.groupBy("language", "to_origin").agg(F.sum("count").alias("n"))
    rest = rest.withColumn("to_language", F.when(F.col("n") >= least_rows, F.col("language")).otherwise("*"))
    last = rest.where("to_language = '*'").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("left_over"))
    named = by_origin.join(rest.drop("n"), ["language", "to_origin"]).crossJoin(F.broadcast(last))  # a single row
    named = named.select(
        *GROUP,
        "to_language",
        F.when(F.col("to_language") == "*", F.lit("*")).otherwise(F.col("to_origin")).alias("to_origin"),
        ((F.col("to_language") != "*") | (F.col("left_over") >= least_rows)).alias("judged"),
    )
    placed = rows.join(named, GROUP, "left")
    return placed.select(
        "doc_id",
        F.coalesce("to_language", "language").alias("language"),
        F.coalesce("to_origin", "origin").alias("origin"),
        *COUNTS,
        "n_capitals",
        "n_points",
        "base_failed",
        (F.coalesce("judged", F.lit(False)) & ~F.col("base_failed")).alias("judged"),
    )


def with_vectors(rows: DataFrame) -> DataFrame:
    """Adds the whole-numbered vector z0, z1, ... of every judged row; NULL for the others."""
    needed = sorted({name for share in SHARES for name in share[1:3]})
    sums = rows.where("judged").groupBy(*GROUP).agg(*(F.sum(name).alias(f"all_{name}") for name in needed))
    # all_word_chars / all_n_words: what the prior's words have in characters
    joined = rows.join(sums, GROUP, "left")
    vector = {}
    for name, (_, above, below, least) in zip(Z, SHARES, strict=True):
        usual = F.col(f"all_{above}") / F.greatest(F.col(f"all_{below}"), F.lit(1))
        weight = F.lit(float(PRIOR)) * (F.col(f"all_{below}") / F.greatest(F.col("all_n_words"), F.lit(1)))
        share = (F.col(above) + weight * usual) / (F.col(below) + weight + F.lit(1e-9))
        level = F.round(F.log(share + F.lit(least)) * SCALE).cast("int")
        vector[name] = F.when(F.col("judged"), F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), level)))
    return joined.withColumns(vector).drop(*(f"all_{name}" for name in needed))


def _medians(counted: DataFrame, value: str, name: str) -> DataFrame:
    """(group, part, name): the lower median of each part from (value, n) rows, at most one per value of the scale."""
    order = Window.partitionBy(*GROUP, "part").orderBy(value)
    upto = counted.withColumn("upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = counted.groupBy(*GROUP, "part").agg(F.sum("n").alias("whole"))
    reached = upto.join(whole, [*GROUP, "part"]).where(2 * F.col("upto") >= F.col("whole"))
    return reached.groupBy(*GROUP, "part").agg(F.min(value).alias(name))


def starts(points: DataFrame, folder: str) -> DataFrame:
    """(group, start, centre, covariance): medians with three kinds of covariance."""
    parts = F.array(*(F.struct(F.lit(i).alias("part"), F.col(name).alias("z")) for i, name in enumerate(Z)))
    counted = points.select(*GROUP, F.inline(parts)).groupBy(*GROUP, "part", "z").agg(F.count("*").alias("n"))
    counted = written(counted, folder, "values")
    medians = written(_medians(counted, "z", "median"), folder, "medians")
    away = counted.join(medians, [*GROUP, "part"]).groupBy(*GROUP, "part", F.abs(F.col("z") - F.col("median")).alias("off"))
    spreads = _medians(away.agg(F.sum("n").alias("n")), "off", "deviation").join(medians, [*GROUP, "part"])
    floor = FLOOR * SCALE
    spreads = spreads.withColumn("s", F.greatest(F.col("deviation") * 1.4826, F.lit(floor)))
    wide = spreads.groupBy(*GROUP).agg(
        *(F.max(F.when(F.col("part") == i, F.col("median"))).cast("double").alias(CENTRE[i]) for i in range(SIZE)),
        *(F.max(F.when(F.col("part") == i, F.col("s"))).alias(f"s{i}") for i in range(SIZE)),
    )
    wide = written(wide, folder, "scales")

    # sums of products of signs of direction and of tanh, as whole numbers
    scaled = points.join(wide, GROUP).select(
        *GROUP, *((F.col(Z[i]) - F.col(CENTRE[i])).__truediv__(F.col(f"s{i}")).alias(f"r{i}") for i in range(SIZE))
    )
    norm = F.sqrt(reduce(add, (F.col(f"r{i}") * F.col(f"r{i}") for i in range(SIZE))))
    scaled = scaled.withColumn("norm", F.greatest(norm, F.lit(1e-9)))
    small = scaled.select(
        *GROUP,
        *(F.round(F.col(f"r{i}") / F.col("norm") * SCALE).cast("long").alias(f"u{i}") for i in range(SIZE)),
        *(F.round(F.tanh(f"r{i}") * SCALE).cast("long").alias(f"t{i}") for i in range(SIZE)),
    )
    shapes = small.groupBy(*GROUP).agg(
        F.count("*").alias("n"),
        *(F.sum(F.col(f"{k}{i}") * F.col(f"{k}{j}")).alias(f"{k}{i}{j}") for k in "ut" for i, j in PAIRS),
    )
    kinds = []
    for number, kind in enumerate("dut"):
        cells = []
        for i, j in PAIRS:
            scale = F.col(f"s{i}") * F.col(f"s{j}")
            part = F.lit(1.0 if i == j else 0.0) if kind == "d" else F.col(f"{kind}{i}{j}") / F.col("n") / float(SCALE**2)
            if kind == "u":  # each direction has length one: times the dimension for a spread of one
                part = part * SIZE
            cells.append((scale * part + F.lit(floor * floor if i == j else 0.0)).alias(f"c{i}{j}"))
        kinds.append(F.struct(F.lit(number).alias("start"), *(F.col(name) for name in CENTRE), *cells))
    return wide.join(shapes, GROUP).select(*GROUP, "n", F.inline(F.array(*kinds)))


def with_inverse(estimates: DataFrame) -> DataFrame:
    """Adds the inverse of the covariance's Cholesky factor (i00, i10, ...) and the log of the determinant.

    Written out entry by entry: the matrices have five rows, and there is one per group.
    """
    out = estimates
    for i, j in PAIRS:
        inner = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"l{j}{k}"), range(j), F.col(f"c{i}{j}"))
        value = F.sqrt(F.greatest(inner, F.lit(1e-6))) if i == j else inner / F.col(f"l{j}{j}")
        out = out.withColumn(f"l{i}{j}", value)
    for i, j in PAIRS:
        if i == j:
            value = 1 / F.col(f"l{i}{i}")
        else:
            value = -reduce(add, (F.col(f"l{i}{k}") * F.col(f"i{k}{j}") for k in range(j, i))) / F.col(f"l{i}{i}")
        out = out.withColumn(f"i{i}{j}", value)
    logdet = 2 * reduce(add, (F.log(f"l{i}{i}") for i in range(SIZE)))
    return out.withColumn("logdet", logdet).drop(*(f"l{i}{j}" for i, j in PAIRS))


def distance() -> Column:
    """The squared Mahalanobis distance of z from a centre, with the inverse factor's columns at hand."""
    rows = []
    for i in range(SIZE):
        one = reduce(add, (F.col(f"i{i}{j}") * (F.col(Z[j]) - F.col(CENTRE[j])) for j in range(i + 1)))
        rows.append(one)
    return reduce(add, (one * one for one in rows))


def _bin(squared: Column) -> Column:
    return F.floor(F.log2(F.greatest(squared, F.lit(2.0**-20))) * BINS_PER_DOUBLING).cast("int")


SUMS = ["n", *(f"s{i}" for i in range(SIZE)), *(f"q{i}{j}" for i, j in PAIRS)]


def _sums() -> list[Column]:
    """Number, sums and sums of products of z, as whole numbers."""
    return [
        F.count("*").alias("n"),
        *(F.sum(F.col(name).cast("long")).alias(f"s{i}") for i, name in enumerate(Z)),
        *(F.sum(F.col(Z[i]).cast("long") * F.col(Z[j]).cast("long")).alias(f"q{i}{j}") for i, j in PAIRS),
    ]


def _estimates(n: Column) -> list[Column]:
    """Centre and covariance from the sums."""
    floor = (FLOOR * SCALE) ** 2
    centre = [(F.col(f"s{i}") / n).alias(CENTRE[i]) for i in range(SIZE)]
    spread = [
        (F.col(f"q{i}{j}") / n - (F.col(f"s{i}") / n) * (F.col(f"s{j}") / n) + F.lit(floor if i == j else 0.0)).alias(f"c{i}{j}")
        for i, j in PAIRS
    ]
    return [*centre, *spread]


def binned(points: DataFrame, estimates: DataFrame) -> DataFrame:
    """(group, start, bin, sums): what the rows of each distance bin add up to."""
    keyed = estimates.select(*GROUP, "start", *CENTRE, *(f"i{i}{j}" for i, j in PAIRS))
    far = points.join(keyed, GROUP).withColumn("bin", _bin(distance()))
    return far.groupBy(*GROUP, "start", "bin").agg(*_sums())


def _reaching(bins: DataFrame, share: float) -> DataFrame:
    """Per group and start, the first bin up to which ``share`` of the rows lie, with all sums up to its end."""
    order = Window.partitionBy(*GROUP, "start").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = bins.groupBy(*GROUP, "start").agg(F.sum("n").alias("whole"))
    upto = bins.select(*GROUP, "start", "bin", *(F.sum(name).over(order).alias(name) for name in SUMS))
    reached = upto.join(whole, [*GROUP, "start"]).where(F.col("n") >= F.ceil(F.col("whole") * share))
    return reached.groupBy(*GROUP, "start").agg(F.min_by(F.struct("bin", *SUMS), "bin").alias("at")).select(*GROUP, "start", "at.*")


def concentrate(points: DataFrame, estimates: DataFrame, folder: str, name: str) -> DataFrame:
    """One step: the estimates from the nearest ``SHARE`` of each group's rows."""
    bins = written(binned(points, estimates), folder, f"bins_{name}")
    nearest = _reaching(bins, SHARE).select(*GROUP, "start", *_estimates(F.col("n")))
    return written(with_inverse(nearest), folder, f"estimates_{name}")


def minimum_determinant(points: DataFrame, folder: str) -> DataFrame:
    """(group, start, centre, covariance, its inverse factor, logdet): the best estimate of each group."""
    held = written(with_inverse(starts(points, folder)).drop("n"), folder, "starts")
    for step in range(TRIES):
        held = concentrate(points, held, folder, f"try_{step}")
    best = held.groupBy(*GROUP).agg(F.min_by("start", F.struct("logdet", "start")).alias("start"))
    held = written(held.join(best, [*GROUP, "start"]), folder, "chosen")
    step = 0
    while True:
        after = concentrate(points, held, folder, f"step_{step}")
        before = held.select(*GROUP, F.col("logdet").alias("logdet_before"))
        fell = after.join(before, GROUP).withColumn("fell", F.col("logdet_before") - F.col("logdet") > LEAST_GAIN)
        # a group whose determinant fell no further keeps what it had
        kept = held.join(fell.where("not fell").select(*GROUP), GROUP, "left_semi")
        moved = fell.where("fell").select(*held.columns)
        if moved.isEmpty():
            return held
        held = written(kept.unionByName(moved), folder, f"held_{step}")
        step += 1


def reweighted(points: DataFrame, raw: DataFrame, folder: str) -> DataFrame:
    """The estimates from all rows that aren't far by the raw one, which is scaled by the median distance."""
    bins = written(binned(points, raw), folder, "bins_raw")
    middle = F.pow(F.lit(2.0), (F.col("bin") + 0.5) / BINS_PER_DOUBLING)
    factor = _reaching(bins, 0.5).select(*GROUP, F.greatest(middle / MEDIAN, F.lit(1e-3)).alias("factor"))
    near = bins.join(factor, GROUP).where(F.pow(F.lit(2.0), (F.col("bin") + 1) / BINS_PER_DOUBLING) <= F.col("factor") * INNER)
    summed = near.groupBy(*GROUP, "start").agg(*(F.sum(name).alias(name) for name in SUMS))
    out = summed.select(*GROUP, "start", *_estimates(F.col("n")))
    return written(with_inverse(out), folder, "reweighted")


def judge_quality(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    source: str = "source",
    least_rows: int = LEAST_ROWS,
) -> DataFrame:
    """One row per document: its counts, base_failed, the group it was judged in, distance, outlier, kept.

    ``distance`` is the squared Mahalanobis distance from the group's robust centre, NULL where a text wasn't
    judged; ``kept`` is true where neither a base rule nor the distance speaks against the text.
    """
    folder = shared_folder(documents.sparkSession)
    counted = written(statistics(documents, doc_id, text, language, source), folder, "statistics")
    rows = written(with_vectors(with_groups(counted, least_rows)), folder, "vectors")
    points = rows.where("judged").select(*GROUP, *Z)
    final = reweighted(points, minimum_determinant(points, folder), folder).drop("start")
    far = rows.join(final, GROUP, "left").withColumn("distance", F.when(F.col("judged"), distance() / INNER_FACTOR))
    outlier = F.coalesce(F.col("distance") > CUTOFF, F.lit(False))
    return far.select(
        "doc_id",
        *COUNTS,
        "base_failed",
        "language",
        "origin",
        "distance",
        outlier.alias("outlier"),
        (~F.col("base_failed") & ~outlier).alias("kept"),
    )


def quality_report(spark, sf_dir: str) -> DataFrame:
    """``op12``: counts and verdict of every document."""
    judged = judge_quality(read_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", "distance")
