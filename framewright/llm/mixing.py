"""Mixing sources to target weights by hash-threshold histograms.

Each document has a fixed 48-bit hash of its id, and a source takes the documents below a threshold.
The threshold is found without sorting documents: words are summed by source and hash bucket, the
bucket in which a budget ends is found from the running sums, and only that bucket is divided again,
``LEVELS`` times.  Thresholds of smaller budgets are lower, so their mixes are parts of the larger
ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm.common import broadcast_within, n_words, stored

#: Bits of a bucket number at each level, and levels: the hash has their product in bits.
BITS, LEVELS = 12, 4
HASH_BITS = BITS * LEVELS


def hash48(docs: DataFrame) -> Column:
    """The document's place on the hash line; a null id is placed by its text."""
    key = F.coalesce(docs["doc_id"].cast("string"), F.concat(F.lit("text:"), F.coalesce(docs["text"], F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``source, source_size, target`` from one row per source.

    Weights repeat over the sources by code point, null last.  A target is the weight times one
    level, at most ``most`` times the source; the level gives all targets together ``share`` of all
    words.  It is found by filling the sources in the order in which they reach their limit."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * F.lit(float(most))
    rows = sizes.withColumn("weight", weight).withColumn("limit", limit).withColumn("full_at", F.col("limit") / F.col("weight"))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    budget = F.sum("source_size").over(whole) * F.lit(float(share))
    rows = rows.withColumn("level", (budget - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / open_weight)
    rows = rows.withColumn("fits", F.when(F.col("level") <= F.col("full_at"), F.col("level")))
    level = F.first("fits", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return rows.select("source", "source_size", F.least(F.col("limit"), F.coalesce(level * F.col("weight"), F.col("limit"))).alias("target"))


def thresholds(sized: DataFrame, wants: DataFrame) -> DataFrame:
    """For each row (source, budget, want) of ``wants`` the hash below which the source's documents
    hold ``want`` words, as near as whole documents allow: ``source, budget, below``."""
    state = wants.withColumn("prefix", F.lit(0).cast("long")).withColumnRenamed("want", "left")
    done = None
    for level in range(1, LEVELS + 1):
        state = broadcast_within(stored(state, f"mix-level{level}"), 64)
        rest = HASH_BITS - BITS * level
        rows = sized.join(state, sized["source"].eqNullSafe(state["source"])
                          & (F.shiftright(sized["h"], rest + BITS) == state["prefix"]))
        sums = (rows.groupBy(state["source"].alias("source"), "budget", "left", F.shiftright("h", rest).alias("bucket"))
                .agg(F.sum("size").alias("words")))
        by = Window.partitionBy("source", "budget").orderBy("bucket")
        sums = sums.withColumn("running", F.sum("words").over(by))
        ends = (sums.where(F.col("running") > F.col("left")).groupBy("source", "budget")
                .agg(F.min_by(F.struct("bucket", "words", (F.col("left") - F.col("running") + F.col("words")).alias("left")), "bucket").alias("b")))
        if level == 1:                              # a budget of all words has no end bucket
            first = state.join(ends, state["source"].eqNullSafe(ends["source"]) & (state["budget"] == ends["budget"]), "left_anti")
            done = first.select("source", "budget", F.lit(1 << HASH_BITS).cast("long").alias("below"))
        state = ends.select("source", "budget", F.col("b.left").alias("left"), F.col("b.bucket").alias("prefix"), F.col("b.words").alias("words"))
        if level < LEVELS:
            state = state.drop("words")
    # The last bucket is one hash value: it is taken if that comes nearer.
    last = state.select("source", "budget", (F.col("prefix") + F.when(2 * F.col("left") >= F.col("words"), 1).otherwise(0)).alias("below"))
    return stored(done.unionByName(last), "mix-thresholds")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), budgets: tuple[float, ...] = (1.5,),
        most: float = 2.0) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken, copies,
    copies_by_budget``; all but the last for the largest budget.

    ``budgets`` are shares of all words.  A document is taken ``floor(target / source size)`` times,
    and once more below its source's threshold.  Null text: size 0, taken 0 words.  A null source is
    a source.  Equal ids have equal hashes and are taken alike.  An empty table gives no rows."""
    sized = stored(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"),
                               n_words(docs["text"]).alias("size"), hash48(docs).alias("h")), "mix-sizes")
    return _apply(sized, sized, weights, budgets, most)


def _apply(sized: DataFrame, rows: DataFrame, weights, budgets, most) -> DataFrame:
    sources = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    wants = None
    for k, share in enumerate(sorted(budgets)):
        one = targets(sources, weights, share, most).withColumn("budget", F.lit(k))
        wants = one if wants is None else wants.unionByName(one)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    wants = wants.withColumn("whole", times).withColumn(
        "want", F.floor(F.col("target") - F.col("whole") * F.col("source_size") + F.lit(0.5)).cast("long"))
    wants = stored(wants, "mix-targets")
    below = thresholds(sized, wants.select("source", "budget", "want"))
    plan = (wants.alias("w").join(below.alias("b"), F.col("w.source").eqNullSafe(F.col("b.source")) & (F.col("w.budget") == F.col("b.budget")))
            .groupBy(F.col("w.source").alias("of_source"))
            .agg(F.max("w.source_size").alias("source_size"), F.max_by("w.target", "w.budget").alias("target"),
                 F.sort_array(F.collect_list(F.struct("w.budget", "w.whole", "b.below"))).alias("steps")))
    plan = broadcast_within(stored(plan, "mix-plan"), 64 + 32 * len(budgets))
    found = rows.join(plan, rows["source"].eqNullSafe(plan["of_source"]), "left")
    copies = F.transform("steps", lambda s: s["whole"] + F.when(F.col("h") < s["below"], 1).otherwise(0))
    found = found.withColumn("copies_by_budget", copies).withColumn("copies", F.element_at("copies_by_budget", -1))
    return found.withColumn("taken", F.col("size") * F.col("copies")).drop("of_source", "steps", "h")


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5,
                    most: float = 2.0) -> DataFrame:
    """The documents of the mix with their own columns, each as often as it is taken.  The mix is
    decided from the sizes alone, so the texts are read again in place and not shuffled."""
    keep = docs.columns
    sized = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"),
                        n_words(docs["text"]).alias("size"), hash48(docs).alias("h"))
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), docs["source"].cast("string").alias("source"),
                       F.lit(0).cast("long").alias("size"), hash48(docs).alias("h"))
    taken = _apply(stored(sized, "mix-sizes"), rows, weights, (share,), most)
    each = taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"))
    return each.select("row.*")


#: The same mix in DuckDB: the documents of a source in hash order, up to the budget.
SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) AS h
  FROM documents),
sources AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sized GROUP BY source),
filled AS (
  SELECT *, 2.0::DOUBLE * source_size AS lim, 2.0::DOUBLE * source_size / weight AS full_at FROM sources),
leveled AS (
  SELECT *, (SUM(source_size) OVER () * 1.5::DOUBLE
             - COALESCE(SUM(lim) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (SUM(weight) OVER () - COALESCE(SUM(weight) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM filled),
level AS (SELECT arg_min(level, full_at) AS level FROM leveled WHERE level <= full_at),
wants AS (
  SELECT source, source_size, target, n, CAST(floor(target - n * source_size + 0.5) AS BIGINT) AS want
  FROM (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS n
        FROM (SELECT source, source_size, LEAST(lim, COALESCE((SELECT level FROM level) * weight, lim)) AS target FROM leveled))),
running AS (
  SELECT s.*, w.source_size, w.target, w.n, w.want,
         SUM(size) OVER (PARTITION BY s.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         SUM(size) OVER (PARTITION BY s.source, h) AS here
  FROM sized s JOIN wants w ON s.source IS NOT DISTINCT FROM w.source)
SELECT doc_id, source, size, source_size, target,
       CAST(size * (n + CASE WHEN upto <= want OR (upto - here <= want AND 2 * (want - upto + here) >= here) THEN 1 ELSE 0 END) AS BIGINT) AS taken,
       CAST(n + CASE WHEN upto <= want OR (upto - here <= want AND 2 * (want - upto + here) >= here) THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM running
"""
