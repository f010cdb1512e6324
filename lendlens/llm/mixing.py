"""Mixing sources to target weights with hash-threshold histograms.

Every document has a 60-bit hash of its id and text.  A source that gets T
words of its own S takes every document floor(T / S) times and once more the
documents whose hash lies below the source's threshold, so mixes of growing
budgets are nested and no document is taken more than once above another.
Thresholds are found without sorting: sizes are summed by (source, leading 12
bits), the bucket in which the running sum passes the budget is the boundary,
and only rows of boundary buckets are summed again by their next 12 bits.
Equal hashes (repeated rows) are cut further by the hash of their place in the
stored narrow table.  A boundary of one row is taken when that brings the sum
nearer to the target, so a source misses it by half a document at most.

Targets: sources in code-point order, NULL last, weigh 5, 2, 1, 5, 2, 1 ... of
all words; a target stops at ``max_repeats`` times its source and the excess is
shared again by weight among the others until none is above.

Jobs: one pass over the texts writes (doc_id, source, size, hash); all else
reads that narrow table.  Sums combine before they are shuffled, so a hot
source is a few thousand buckets.  The table of sources is broadcast when it
is small (checked), else joined over salted keys.

Defined cases: NULL text has size 0; an empty text too; NULL is a source of
its own, other than ''; sources without words have target 0 and take nothing;
repeated rows are rows of their own (which of them is taken does not show);
ties go to the smaller hash; a table without words has targets 0; an empty
table gives an empty result; extra columns are ignored; missing ones are NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendlens.llm.common import column, materialize

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
DIGIT, DIGITS = 12, 5                      # 12 bits a level, five levels of each hash
MASK = (1 << DIGIT) - 1
BITS = DIGIT * DIGITS


def words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; NULL has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), "")).cast("long")


def look_up(big: DataFrame, small: DataFrame, on: Column, salts: int = 64, most: int = 200_000) -> DataFrame:
    """Inner join on ``on``: ``small`` is broadcast up to ``most`` rows, else both sides are dealt over ``salts``."""
    if small.limit(most + 1).count() <= most:
        return big.join(F.broadcast(small), on)
    dealt = small.withColumn("_salt_r", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = big.withColumn("_salt_l", F.pmod(F.xxhash64("u", "w"), F.lit(salts)).cast("int"))
    return salted.join(dealt, on & (F.col("_salt_l") == F.col("_salt_r"))).drop("_salt_l", "_salt_r")


def ordinals(df: DataFrame, by: str) -> DataFrame:
    """Distinct non-NULL ``by`` with ``place`` 0, 1, 2 ... in ascending order, numbered inside stored ranges."""
    ranged = df.select(by).filter(F.col(by).isNotNull()).distinct().repartitionByRange(by).sortWithinPartitions(by)
    stored = materialize(ranged.withColumn("range", F.spark_partition_id()), "mix-ranges")
    sizes = stored.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(sizes.select("range", before.alias("start")))        # one row a shuffle partition
    inside = F.row_number().over(Window.partitionBy("range").orderBy(by)) - 1
    return stored.withColumn("inside", inside).join(starts, "range").select(by, (F.col("start") + F.col("inside")).alias("place"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size) to (source, source_size, target); the rounds of resharing pass sums only."""
    placed = ordinals(sizes, "source")
    last = placed.count()
    placed = sizes.join(placed.withColumnRenamed("source", "_s"), F.col("source") == F.col("_s"), "left")
    at = F.pmod(F.coalesce("place", F.lit(last)), F.lit(len(weights))).cast("int") + 1
    shares = materialize(placed.select("source", "source_size", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), at).alias("weight"),
                                       (F.col("source_size") * max_repeats).alias("limit")), "mix-shares")
    total = shares.agg(F.sum("source_size")).first()[0] or 0
    per_weight, full = 0.0, -1
    while total:
        above = F.col("weight") * per_weight >= F.col("limit")
        if per_weight == 0.0:
            above = F.col("limit") == 0
        r = shares.agg(F.sum(F.when(above, F.col("limit"))).alias("held"), F.sum(F.when(~above, F.col("weight"))).alias("open"),
                       F.count(F.when(above, 1)).alias("full")).first()
        if r["full"] == full or not r["open"]:
            break
        full, per_weight = r["full"], (total - (r["held"] or 0)) / r["open"]
    target = F.least(F.col("limit").cast("double"), F.col("weight") * F.lit(per_weight))
    return shares.select("source", "source_size", target.alias("target"))


def _boundary(level: int) -> Column:
    """Does a row lie in the bucket reached after ``level`` levels?"""
    if level <= DIGITS:
        return F.shiftright("u", BITS - DIGIT * level) == F.col("at_u")
    return (F.col("u") == F.col("at_u")) & (F.shiftright("w", BITS - DIGIT * (level - DIGITS)) == F.col("at_w"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, cut_u, cut_w) for budgets (source, left): the rows below the cut hold ``left`` words, to half a document.

    ``rows``: source, size, u, w.  Sources with nothing left get no cut.
    """
    state = materialize(budgets.filter("left > 0").select("source", "left", F.lit(0).cast("long").alias("at_u"), F.lit(0).cast("long").alias("at_w")), "mix-state")
    done = []
    for level in range(2 * DIGITS):
        if state.isEmpty():
            break
        key = "u" if level < DIGITS else "w"
        shift = BITS - DIGIT * (level % DIGITS + 1)
        digit = F.shiftright(key, shift).bitwiseAND(F.lit(MASK))
        here = state.withColumnRenamed("source", "_s")
        inside = look_up(rows.filter("size > 0"), here, F.col("source").eqNullSafe(F.col("_s")) & _boundary(level)) if level else rows.filter("size > 0")
        sums = inside.groupBy("source", digit.alias("digit")).agg(F.sum("size").alias("held"), F.count(F.lit(1)).alias("n"))
        running = F.sum("held").over(Window.partitionBy("source").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1))
        sums = sums.withColumn("before", F.coalesce(running, F.lit(0)))
        met = here.join(sums, F.col("source").eqNullSafe(F.col("_s"))).filter("before <= left").groupBy("source").agg(
            F.max_by(F.struct("digit", "before", "held", "n", "left", "at_u", "at_w"), "digit").alias("b")).select("source", "b.*")
        deeper = F.shiftleft("at_u" if key == "u" else "at_w", DIGIT) + F.col("digit")
        met = met.select("source", (F.col("left") - F.col("before")).alias("left"), "held", "n", (deeper if key == "u" else F.col("at_u")).alias("at_u"),
                         (deeper if key == "w" else F.col("at_w")).alias("at_w"))
        met = materialize(met, "mix-level")
        final = (F.col("n") == 1) | (F.col("left") >= F.col("held")) if level < 2 * DIGITS - 1 else F.lit(True)
        more = (F.col("left") * 2 >= F.col("held")).cast("long")
        if key == "u":
            cut = [F.shiftleft(F.col("at_u") + more, shift).alias("cut_u"), F.lit(0).cast("long").alias("cut_w")]
        else:
            cut = [F.col("at_u").alias("cut_u"), F.shiftleft(F.col("at_w") + more, shift).alias("cut_w")]
        done.append(met.filter(final).select("source", *cut))
        state = met.filter(~final).select("source", "left", "at_u", "at_w")
    out = budgets.filter(F.lit(False)).select("source", F.lit(0).cast("long").alias("cut_u"), F.lit(0).cast("long").alias("cut_w"))
    for d in done:
        out = out.unionByName(d)
    return out


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per document."""
    text, doc_id = column(docs, "text", "string"), column(docs, "doc_id", "long")
    mark = F.xxhash64(doc_id, F.coalesce(text, F.lit(""))).bitwiseAND(F.lit((1 << BITS) - 1))
    stored = materialize(docs.select(doc_id.alias("doc_id"), column(docs, "source", "string").alias("source"), words(text).alias("size"), mark.alias("u")), "mix-rows")
    place = F.xxhash64("u", F.col("_metadata.file_name"), F.col("_metadata.row_index")).bitwiseAND(F.lit((1 << BITS) - 1))
    rows = stored.select("*", place.alias("w"))
    sizes = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    targets = source_targets(sizes, weights, max_repeats)
    repeats = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    budgets = materialize(targets.withColumn("repeats", repeats).withColumn(
        "left", F.when(F.col("source_size") > 0, F.col("target") - F.col("repeats") * F.col("source_size")).otherwise(F.lit(0.0))), "mix-budgets")
    cuts = thresholds(rows, budgets).withColumnRenamed("source", "_c")
    plan = budgets.join(cuts, F.col("source").eqNullSafe(F.col("_c")), "left").select(
        F.col("source").alias("_s"), "source_size", "target", "repeats", F.coalesce("cut_u", F.lit(0)).alias("cut_u"), F.coalesce("cut_w", F.lit(0)).alias("cut_w"))
    plan = materialize(plan, "mix-plan")
    below = (F.col("u") < F.col("cut_u")) | ((F.col("u") == F.col("cut_u")) & (F.col("w") < F.col("cut_w")))
    taken = F.col("size") * (F.col("repeats") + below.cast("long"))
    return look_up(rows, plan, F.col("source").eqNullSafe(F.col("_s"))).select("doc_id", "size", "source_size", "target", taken.alias("taken"))
