"""Quality rules: word statistics, base rules and robust multivariate outliers, all in Spark SQL functions.

Documents that pass the base rules are compared with the others of their language and source: their
transformed statistics have a centre and a covariance that outliers do not pull, the minimum covariance
determinant estimate.  From three starts, concentration steps move to the share ``CORE`` of documents
nearest by Mahalanobis distance; the start with the smallest determinant stays.  A step is one grouped
aggregate: documents are counted and summed by distance bucket, and the buckets up to the wanted share
make the next estimate, so no group is sorted or collected.  Statistics are integers of 1/1024, so sums
do not depend on the order of rows and reruns agree.
"""

from __future__ import annotations

from math import exp

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm.common import GAP, WORD, broadcast_within, stored, words

#: Share of the documents in the core, concentration steps, tail probability of the rejection limit.
CORE, STEPS, TAIL = 0.75, 5, 1e-5

#: Standard deviations that always count as ordinary: of the log mean word length, and of the logs of
#: symbols per word, repeated lines and repeated words (see ``features``).  They are floors of the
#: estimate, so each must be under its statistic's range (log 11 for lines, log 6 for words that pass
#: the base rule) by more than the root of ``LIMIT``; else that statistic can never reject alone.
ORDINARY = (0.08, 0.20, 0.35, 0.25)

#: Weight, in documents, of the wider prior that stands in for documents a small group does not have.
PRIOR_DOCS, PRIOR_TIMES = 10, 2.0

SCALE, DIM = 1024, len(ORDINARY)
PAIRS = [(i, j) for i in range(DIM) for j in range(i + 1)]


def _chi2_4(x: float) -> float:
    return 1 - exp(-x / 2) * (1 + x / 2)


def _chi2_6(x: float) -> float:
    return 1 - exp(-x / 2) * (1 + x / 2 + x * x / 8)


def _quantile(p: float) -> float:
    low, high = 0.0, 200.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_4(mid) < p else (low, mid)
    return high


#: The core's covariance is too small by this factor for normal data; squared distance of the limit.
CONSISTENCY, LIMIT = CORE / _chi2_6(_quantile(CORE)), _quantile(1 - TAIL)


def _let(value: Column, use) -> Column:
    """``use`` applied to a value that is computed once per row."""
    return F.transform(F.array(value), use)[0]


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns ``n_words, word_chars, n_symbols, n_dup_lines, n_lines,
    n_repeat_words`` (long) in a struct ``stats``.  Null or blank text: zeros."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.withColumn("__w", words(text)).withColumn("__n", F.size("__w"))
    triple = F.transform(F.sequence(F.lit(0), F.col("__n") - 3), lambda i: F.xxhash64(
        F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)))
    rows = rows.withColumn("__h", F.when(F.col("__n") >= 3, triple))

    def covered(places: Column) -> Column:              # each window covers three words; overlaps once
        step = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, b: a + b)

    def repeated(a: Column) -> Column:
        kept = F.filter(a, lambda x, i: (F.coalesce(F.get(a, i + 1)["h"] == x["h"], F.lit(False)))
                        | (F.coalesce(F.get(a, i - 1)["h"] == x["h"], F.lit(False))))
        return _let(F.array_sort(F.transform(kept, lambda x: x["p"])), covered)

    placed = F.sort_array(F.transform("__h", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    repeats = F.when(F.size(F.array_distinct("__h")) < F.size("__h"), _let(placed, repeated)).otherwise(0)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    rows = rows.withColumn("__l", lines)
    stats = F.struct(
        F.col("__n").cast("long").alias("n_words"),
        F.char_length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.size("__l").cast("long").alias("n_lines"),
        F.coalesce(repeats, F.lit(0)).cast("long").alias("n_repeat_words"))
    return rows.withColumn("stats", stats).drop("__w", "__n", "__h", "__l")


def base_failed(s: str = "stats") -> Column:
    n, r = F.col(f"{s}.n_words"), F.col(f"{s}.n_repeat_words")
    return (n < 50) | (100 * r > 50 * n)


def features(s: str = "stats") -> Column:
    """Array of the transformed statistics, as integers of 1/1024."""
    n = F.greatest(F.col(f"{s}.n_words"), F.lit(1))
    parts = (F.log(F.greatest(F.col(f"{s}.word_chars"), F.lit(1)) / n),
             F.log1p(10 * F.col(f"{s}.n_symbols") / n),
             F.log1p(10 * F.col(f"{s}.n_dup_lines") / F.greatest(F.col(f"{s}.n_lines"), F.lit(1))),
             F.log1p(10 * F.col(f"{s}.n_repeat_words") / n))
    return F.array(*[F.round(p * SCALE).cast("long") for p in parts])


def _sums(x: str = "x") -> list[Column]:
    """Aggregates of count, sums and sums of products."""
    at = [F.get(x, F.lit(i)) for i in range(DIM)]
    return [F.count(F.lit(1)).alias("n"), *[F.sum(at[i]).alias(f"s{i}") for i in range(DIM)],
            *[F.sum(at[i] * at[j]).alias(f"q{i}{j}") for i, j in PAIRS]]


def _estimate(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Centre, Cholesky factor and log determinant of the regularised covariance from the sums."""
    n = F.col("n").cast("double")
    rows = sums.select(*keys, *[(F.col(f"s{i}") / n / SCALE).alias(f"m{i}") for i in range(DIM)], n.alias("n"),
                       *[(F.col(f"q{i}{j}") / n / SCALE ** 2).alias(f"q{i}{j}") for i, j in PAIRS])
    cov = {}
    for i, j in PAIRS:
        c = CONSISTENCY * (F.col(f"q{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}"))
        if i == j:
            prior = (ORDINARY[i] * PRIOR_TIMES) ** 2 * PRIOR_DOCS / (n + PRIOR_DOCS)
            c = F.greatest(c, F.lit(0.0)) + ORDINARY[i] ** 2 + prior
        cov[i, j] = c.alias(f"c{i}{j}")
    rows = rows.select(*keys, *[f"m{i}" for i in range(DIM)], *cov.values())
    return _factored(rows, keys)


def _factored(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Cholesky factor ``f`` of the covariance columns ``c``, entry by entry, and the log determinant."""
    for j in range(DIM):
        left = F.col(f"c{j}{j}")
        for k in range(j):
            left = left - F.col(f"f{j}{k}") * F.col(f"f{j}{k}")
        rows = rows.withColumn(f"f{j}{j}", F.sqrt(F.greatest(left, F.lit(ORDINARY[j] ** 2 / 4))))
        for i in range(j + 1, DIM):
            left = F.col(f"c{i}{j}")
            for k in range(j):
                left = left - F.col(f"f{i}{k}") * F.col(f"f{j}{k}")
            rows = rows.withColumn(f"f{i}{j}", left / F.col(f"f{j}{j}"))
    size = sum((F.log(F.col(f"f{i}{i}")) for i in range(1, DIM)), F.log(F.col("f00")))
    return rows.select(*keys, *[f"m{i}" for i in range(DIM)], *[f"f{i}{j}" for i, j in PAIRS], size.alias("volume"))


def _squared(rows: DataFrame, x: str = "x") -> DataFrame:
    """Adds ``d2``, the squared Mahalanobis distance, by forward substitution."""
    for i in range(DIM):
        left = F.get(x, F.lit(i)) / SCALE - F.col(f"m{i}")
        for k in range(i):
            left = left - F.col(f"f{i}{k}") * F.col(f"y{k}")
        rows = rows.withColumn(f"y{i}", left / F.col(f"f{i}{i}"))
    return rows.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, DIM)), F.col("y0") * F.col("y0")))


def _quartiles(rows: DataFrame) -> DataFrame:
    """Per group a start from median and interquartile range of each statistic, from value counts."""
    each = rows.select("grp", F.posexplode("x").alias("i", "v")).groupBy("grp", "i", F.shiftright("v", 3).alias("v")).count()
    by = Window.partitionBy("grp", "i")
    each = each.withColumn("upto", F.sum("count").over(by.orderBy("v"))).withColumn("all", F.sum("count").over(by))
    at = lambda p: F.min(F.when(F.col("upto") >= F.col("all") * p, F.col("v"))) * 8 / SCALE
    q = each.groupBy("grp", "i").agg(at(0.25).alias("a"), at(0.5).alias("b"), at(0.75).alias("c"))
    wide = q.groupBy("grp").agg(*[F.max(F.when(F.col("i") == i, F.col("b"))).alias(f"m{i}") for i in range(DIM)],
                                *[F.max(F.when(F.col("i") == i, (F.col("c") - F.col("a")) / 1.349)).alias(f"w{i}") for i in range(DIM)])
    spread = [(F.col(f"w{i}") ** 2 + ORDINARY[i] ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS]
    return wide.select("grp", F.lit(1).alias("start"), *[f"m{i}" for i in range(DIM)], *spread)


def _hinted(params: DataFrame) -> DataFrame:
    return broadcast_within(params, 32 * (3 + DIM + len(PAIRS)))


def estimates(rows: DataFrame, core: float = CORE, steps: int = STEPS) -> DataFrame:
    """The estimate of each group ``grp`` over integer vectors ``x``: centre, factor, volume."""
    keys = ["grp", "start"]
    all_ = _estimate(rows.groupBy("grp", F.lit(0).alias("start")).agg(*_sums()), keys)
    middle = _factored(_quartiles(rows), keys)
    params = stored(all_.unionByName(middle), "mcd-starts")
    # Third start: spatial signs, directions from the median without their lengths.
    signed = _squared(rows.join(_hinted(params.where("start = 1")), "grp"))
    length = F.sqrt(F.col("d2") + F.lit(1e-9))
    unit = signed.withColumn("u", F.array(*[F.round((F.get("x", F.lit(i)) - SCALE * F.col(f"m{i}")) / length).cast("long") for i in range(DIM)]))
    signs = unit.groupBy("grp", F.lit(2).alias("start")).agg(*_sums("u"))
    signs = _estimate(signs, keys).drop(*[f"m{i}" for i in range(DIM)]).join(
        params.where("start = 1").select("grp", *[f"m{i}" for i in range(DIM)]), "grp")
    params = stored(params.unionByName(signs), "mcd-starts")
    for step in range(steps):
        near = _squared(rows.join(_hinted(params), "grp"))
        bucket = F.floor(8 * F.log2(F.col("d2") + F.lit(1e-6))).cast("int")         # steps of nine per cent
        sums = near.groupBy(*keys, bucket.alias("bucket")).agg(*_sums())
        by = Window.partitionBy(*keys)
        sums = sums.withColumn("before", F.sum("n").over(by.orderBy("bucket")) - F.col("n")).withColumn("all", F.sum("n").over(by))
        inner = sums.where(F.col("before") < F.ceil(F.col("all") * core))
        total = inner.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ["n", *[f"s{i}" for i in range(DIM)], *[f"q{i}{j}" for i, j in PAIRS]]])
        params = stored(_estimate(total, keys), f"mcd-step{step}")
    best = F.min_by(F.struct(*[f"m{i}" for i in range(DIM)], *[f"f{i}{j}" for i, j in PAIRS]), F.struct("volume", "start"))
    return stored(params.groupBy("grp").agg(best.alias("p")).select("grp", "p.*"), "mcd")


def judged(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``stats``, ``base_failed``, ``distance`` (squared; null if the base rules reject)
    and ``kept``.

    Null or empty text fails the base rules.  A null language or source makes its own group.  A group
    of few documents is judged mostly by the prior, a lone one is kept.  Repeated rows count each.  An
    empty table gives no rows.  Columns of ``docs`` named like the added ones are replaced."""
    own = [c for c in docs.columns if c not in ("stats", "base_failed", "distance", "kept")]
    docs = docs.select(*[docs[c] for c in own])
    group = F.to_json(F.struct(docs["lang"].cast("string").alias("lang"), docs["source"].cast("string").alias("source")))
    carried = own if keep_text else [c for c in own if c != "text"]
    rows = statistics(docs).select(F.struct(*carried).alias("row"), "stats", group.alias("grp"))
    rows = rows.withColumn("base_failed", base_failed()).withColumn("x", features())
    rows = stored(rows, "quality-statistics")
    params = estimates(rows.where(~F.col("base_failed")).select("grp", "x"))
    near = _squared(rows.join(_hinted(params), "grp", "left"))
    distance = F.when(~F.col("base_failed"), F.col("d2"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= LIMIT, F.lit(True))
    return near.select("row.*", "stats", "base_failed", distance.alias("distance"), kept.alias("kept"))


def verdicts(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base statistics, ``base_failed``, ``kept`` and the squared distance."""
    rows = judged(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], docs["lang"], docs["source"]), keep_text=False)
    return rows.select("doc_id", "stats.n_words", "stats.word_chars", "stats.n_symbols", "stats.n_dup_lines",
                       "stats.n_repeat_words", "base_failed", "kept", "distance")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    return judged(docs).where("kept").select(*docs.columns)
