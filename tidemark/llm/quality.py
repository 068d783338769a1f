"""Quality rules: robust multivariate outliers by minimum-covariance-determinant estimates per language and source.

Statistics of the whole text are transformed into four features.  For each (language, source) there are two starts: medians
with quartile ranges, and the mean and covariance of all rows.  From each, concentration steps repeat "distances, least
``SUBSET`` of them, mean and covariance of those" until no determinant changes (``MAX_STEPS`` at most); the estimate is the one
of least determinant.  A text is rejected where its squared Mahalanobis distance is beyond ``CUTOFF``.

All of it is DataFrame expressions.  A step is one pass over a few numbers a row and one aggregation by (group,
distance bin): the rows of a hot group are summed before the shuffle, and no group is ever gathered.  Features are
integers (thousandths), so that sums, and hence results, do not depend on the order of rows.  The concentration subset
is cut at a bin edge, a few per cent beyond the exact share.

Defined results: a null text has no words and fails the base rule; so do empty ones; very long texts are read whole; an
empty table has no rows; other columns, whatever their names, are not read; a null language or source is a group of its own;
groups under MIN_GROUP rows are pooled by language, and where the pool is that small too, nothing is rejected; rows that
repeat a document each get a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
SUBSET = 0.75
#: Consistency factor for a subset of 0.75 in four dimensions, and the 0.99999 quantile of chi-square with four degrees.
CONSISTENCY, CUTOFF = 1.49, 28.5
MAX_STEPS = 12
FEW = 50_000  # parameters of so many groups are broadcast, more are joined by a shuffle
MIN_GROUP = 100
P = 4
#: Least standard deviation of each feature (thousandths), so that a constant feature does not reject small changes.
FLOOR = (60, 250, 250, 60)
FEATURES = tuple(f"f{i}" for i in range(P))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base statistics of every row's whole text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(
        F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), text.alias("t")
    )
    white = " \t\n\x0b\x0c\r"
    bare = F.translate("t", white, "")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.select(
        "doc_id", "lang", "source",
        F.length(bare).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.when(bare != "", F.split(F.btrim("t", F.lit(white)), f"{SPACE}+")).otherwise(F.array().cast("array<string>")).alias("words"),
    )
    d = d.select(
        "doc_id", "lang", "source", "word_chars", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    return repeated_words(d)


def repeated_words(d: DataFrame) -> DataFrame:
    """``n_repeat_words`` in place of the array ``h`` of word hashes: words inside three-word windows that stand twice or more
    in the text.

    Most texts have no window twice, which a set of their hashes ``k`` tells.  In the others, the windows' hashes are sorted as
    numbers with the position in their low bits; those with a neighbour of equal high bits, a superset of the repeated
    ones, are sorted again by (whole hash, position).  The positions that remain, in order, give the number of words they cover.
    """
    own = [c for c in d.columns if c != "h"]
    k = F.expr("CASE WHEN size(h) < 3 THEN cast(array() AS array<bigint>) ELSE transform(slice(h, 1, size(h) - 2), (x, i) -> xxhash64(x, h[i + 1], h[i + 2])) END")
    d = d.select(*own, k.alias("k")).withColumn("low", F.expr("cast(ceil(log2(size(k) + 1)) AS int)"))
    packed = F.expr("""
        CASE WHEN size(array_distinct(k)) = size(k) THEN cast(array() AS array<bigint>)
        ELSE sort_array(transform(k, (x, i) -> (x & shiftleft(-1L, low)) | cast(i AS bigint))) END""")
    d = d.select(*own, "k", "low", packed.alias("s"))
    likely = F.expr("""
        sort_array(transform(
            filter(s, (x, j) -> (j > 0 AND shiftright(x, low) = shiftright(s[j - 1], low)) OR (j < size(s) - 1 AND shiftright(x, low) = shiftright(s[j + 1], low))),
            x -> named_struct('k', k[cast(x & (shiftleft(1L, low) - 1L) AS int)], 'p', cast(x & (shiftleft(1L, low) - 1L) AS int))))""")
    d = d.select(*own, likely.alias("s"))
    return d.select(*own, F.expr("""
        aggregate(
            sort_array(transform(
                filter(s, (x, j) -> (j > 0 AND x.k = s[j - 1].k) OR (j < size(s) - 1 AND x.k = s[j + 1].k)),
                x -> x.p)),
            named_struct('c', 0L, 'e', -1),
            (a, p) -> named_struct('c', a.c + least(3, p + 2 - a.e), 'e', p + 2),
            a -> a.c)""").alias("n_repeat_words"))


def features(stats: DataFrame) -> DataFrame:
    """The transformed statistic vector, in thousandths."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))

    def milli(c: Column) -> Column:
        return F.round(c * 1000).cast("long")

    return stats.withColumns({
        "f0": milli(F.log(chars / words)),
        "f1": milli(F.log1p(100 * F.col("n_symbols") / chars)),
        "f2": milli(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
        "f3": milli(F.col("n_repeat_words") / words),
    })


def _groups(stats: DataFrame, min_group: int) -> DataFrame:
    """Add ``g``: (language, source), or the language alone for groups of few rows that passed the base rule."""
    lang, source = F.coalesce("lang", F.lit("\x00")), F.coalesce("source", F.lit("\x00"))
    keyed = stats.withColumn("__g", F.concat(lang, F.lit("\x01"), source))
    large = keyed.where(~F.col("base_failed")).groupBy("__g").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= min_group)
    return keyed.join(large, "__g", "left").withColumn("g", F.when(F.col("__n").isNotNull(), F.col("__g")).otherwise(lang)).drop("__g", "__n")


def _start(used: DataFrame) -> DataFrame:
    """Medians and quartile ranges per group, from counts of the distinct values of each feature."""
    each = used.select("g", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f).alias("v")) for i, f in enumerate(FEATURES)])).alias("x")).select("g", "x.*")
    counts = each.groupBy("g", "i", "v").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("g", "i")
    cum = F.sum("n").over(w.orderBy("v"))
    ranked = counts.withColumns({"cum": cum, "all": F.sum("n").over(w)})
    at = ranked.groupBy("g", "i").agg(*[F.min(F.when(F.col("cum") >= F.col("all") * q, F.col("v"))).alias(n) for n, q in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75))], F.max("all").alias("n"))
    wide = at.groupBy("g").agg(F.max("n").alias("n"), *[F.max(F.when(F.col("i") == i, F.col(c))).alias(f"{c}_{i}") for i in range(P) for c in ("q1", "q2", "q3")])
    out = {f"m{i}": F.col(f"q2_{i}").cast("double") for i in range(P)}
    for i in range(P):
        for j in range(i + 1):
            var = F.pow((F.col(f"q3_{i}") - F.col(f"q1_{i}")) / 1.349, 2) + FLOOR[i] ** 2
            out[f"c{i}{j}"] = var if i == j else F.lit(0.0)
    return wide.select("g", F.lit(0).alias("start"), "n", F.lit(None).cast("double").alias("old"), *[c.alias(k) for k, c in out.items()])


PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("k"), *[F.sum(f"f{i}").alias(f"s{i}") for i in range(P)], *[F.sum(F.col(f"f{i}") * F.col(f"f{j}")).alias(f"s{i}{j}") for i, j in PAIRS]]


def _moments(sums: DataFrame, factor: float) -> DataFrame:
    """Mean and covariance from sums; ``old`` is the logarithm of the determinant before."""
    out = {f"m{i}": F.col(f"s{i}") / F.col("k") for i in range(P)}
    for i, j in PAIRS:
        cov = (F.col(f"s{i}{j}").cast("double") - F.col(f"s{i}").cast("double") * F.col(f"s{j}") / F.col("k")) / F.col("k") * factor
        out[f"c{i}{j}"] = cov + (FLOOR[i] ** 2 if i == j else 0.0)
    return sums.select("g", "start", "n", "old", *[c.alias(k) for k, c in out.items()])


def _plain_start(used: DataFrame) -> DataFrame:
    sums = used.groupBy("g").agg(*_sums())
    return _moments(sums.withColumns({"start": F.lit(1), "n": F.col("k"), "old": F.lit(None).cast("double")}), 1.0)


def _factor(params: DataFrame) -> DataFrame:
    """Cholesky factor of the covariance, as columns, and the logarithm of its determinant."""
    for i in range(P):
        for j in range(i + 1):
            s = F.col(f"c{i}{j}")
            for k in range(j):
                s = s - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            params = params.withColumn(f"l{i}{j}", F.sqrt(F.greatest(s, F.lit(1.0))) if i == j else s / F.col(f"l{j}{j}"))
    det = sum((F.log(f"l{i}{i}") for i in range(1, P)), F.log("l00"))
    return params.select("g", "start", "n", "old", det.alias("det"), *[f"m{i}" for i in range(P)], *[f"l{i}{j}" for i, j in PAIRS])


def _distance(rows: DataFrame, factors: DataFrame, few: bool) -> DataFrame:
    """Add ``d2``, the squared distance of each row from its group's centre, by forward substitution."""
    own = rows.columns
    rows = rows.join(F.broadcast(factors) if few else factors, "g", "left")
    for i in range(P):
        y = F.col(f"f{i}") - F.col(f"m{i}")
        for k in range(i):
            y = y - F.col(f"l{i}{k}") * F.col(f"y{k}")
        rows = rows.withColumn(f"y{i}", y / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, P)), F.col("y0") * F.col("y0"))
    return rows.select(*own, "start", "n", "det", d2.alias("d2"))


def _concentrate(used: DataFrame, factors: DataFrame, few: bool) -> DataFrame:
    """One step: mean and covariance of the SUBSET of least distances of each group, from each of its starts."""
    binned = _distance(used, factors, few).withColumn("bin", F.floor(16 * F.log2(F.col("d2") + 0.001)))
    sums = binned.groupBy("g", "start", "bin").agg(*_sums(), F.max("det").alias("old"))
    w = Window.partitionBy("g", "start")
    kept = sums.withColumns({"before": F.sum("k").over(w.orderBy("bin")) - F.col("k"), "n": F.sum("k").over(w)}).where(F.col("before") < F.ceil(F.col("n") * SUBSET))
    names = ["k", *[f"s{i}" for i in range(P)], *[f"s{i}{j}" for i, j in PAIRS]]
    total = kept.groupBy("g", "start").agg(F.max("n").alias("n"), F.max("old").alias("old"), *[F.sum(c).alias(c) for c in names])
    return _moments(total, CONSISTENCY)


def estimates(work: Workspace, used: DataFrame) -> tuple[DataFrame, bool]:
    """(factors of the least determinant of each group, whether the groups are few)."""
    factors = work.write(_factor(_start(used).unionByName(_plain_start(used))))
    few = factors.count() <= FEW
    for _ in range(MAX_STEPS):
        new = work.write(_factor(_concentrate(used, factors, few)))
        settled = new.where(F.abs(F.col("det") - F.col("old")) > 1e-9).isEmpty()
        work.drop(factors)
        factors = new
        if settled:
            break
    best = factors.groupBy("g").agg(F.min(F.struct("det", "start")).alias("b")).select("g", F.col("b.start").alias("start"))
    return work.write(factors.join(best, ["g", "start"]).select(*factors.columns)), few


def quality(docs: DataFrame, min_group: int = MIN_GROUP, cutoff: float = CUTOFF) -> DataFrame:
    """Per row: doc_id, the base statistics, base_failed, kept, and the squared distance d2."""
    with Workspace(docs.sparkSession) as work:
        stats = features(statistics(docs)).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
        stats = work.write(_groups(work.write(stats), min_group))
        factors, few = estimates(work, stats.where(~F.col("base_failed")).select("g", *FEATURES))
        out = _distance(stats, factors, few)
        fine = F.col("n").isNull() | (F.col("n") < min_group) | (F.col("d2") <= cutoff)
        return work.keep(out.select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            (~F.col("base_failed") & fine).alias("kept"), F.round("d2", 3).alias("d2"),
        ))
