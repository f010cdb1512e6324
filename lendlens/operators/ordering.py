"""Exact NTILE / PERCENT_RANK / ROW_NUMBER over a whole table, without one task.

``ntile(k) OVER (ORDER BY x)`` has no partition key, so Spark plans it as
``Exchange SinglePartition``: the whole table sorted by one task.  The same
numbers come out of a range-bucketed plan:

1. one aggregate pass gives the row count and approximate quantiles of each
   order key; the quantiles become literal bucket boundaries (so a retried
   task buckets exactly as the first attempt did);
2. a value that fills more than a bucket on its own (it repeats among the
   quantiles), and a large NULL / NaN group, get a bucket of their own that is
   split further on the tie-break column, with boundaries from a bounded
   sample; no group of equal keys ends up in one task;
3. one aggregate pass counts rows per (partition keys, bucket, sub-bucket);
   that table has at most (#partition values x #buckets) rows and gives each
   bucket its offset inside its partition and the partition size; within the
   size limit it is pinned and broadcast, beyond it stored and joined by
   shuffle (AQE splits skewed sides);
4. a bucket whose rows all fall in one tile takes that tile from the pinned
   table (broadcast lookup, no shuffle); only rows of buckets on a tile edge
   get a piece index, and only those of pieces on an edge are numbered by a window
   partitioned by (partition keys, bucket, piece): offset + local number is the global position.

PERCENT_RANK needs no row order at all when the (partition, value) count
table is small enough to pin or store: rank = rows with a smaller key + 1.

All passes of all specs are batched (GROUPING SETS, one sketch pass, one
sample).  Order is ascending with NULLs last and NaN above every number (the SQL
default of the analysed pipeline).  The tie-break column fixes the order of
equal keys for NTILE / ROW_NUMBER; PERCENT_RANK lets ties share a rank.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlens.operators.joins import STORED_ROW_LIMIT, join_small, pin_small, pinned_grouping_sets, together
from lendlens.session import materialize

# Rows sampled at most to place sub-bucket boundaries of hot keys.
HOT_SAMPLE_ROWS = 200_000
SAMPLES_PER_PIECE = 32
# Cuts of a hot bucket are searched in two levels of at most about this many.
CUT_STEP = 64
# Fewer buckets than this many rows each are not worth their bookkeeping.
MIN_BUCKET_ROWS = 2_000
# From so many rows on, one more scan is cheaper than shuffling rows whose piece has one answer.
APART_ROWS = 1_000_000


@dataclass(frozen=True)
class RankSpec:
    """One ranking column to add.

    kind: ``ntile`` (needs ``tiles``), ``percent_rank`` or ``row_number``.
    """

    name: str
    key: str
    kind: str
    tiles: int = 0
    parts: tuple[str, ...] = ()


def _unique(names) -> list[str]:
    """Column names in first-seen order, each once."""
    return list(dict.fromkeys(names))


def default_buckets(spark) -> int:
    sp = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(256, min(8192, 8 * sp))


def _bucket_plan(stats, spec_idx: int, buckets: int, n: int):
    """Literal splits and hot buckets for one key from the first pass.

    The pass computed ``buckets - 1`` quantiles; small inputs use every j-th
    of them so that buckets keep about ``MIN_BUCKET_ROWS`` rows.
    """
    q_all = stats[f"_q{spec_idx}"] or []
    eff = min(buckets, max(16, n // MIN_BUCKET_ROWS))
    q = [q_all[(j * buckets) // eff - 1] for j in range(1, eff)] if q_all and eff < buckets else q_all
    buckets = eff
    n_valid = stats[f"_v{spec_idx}"]
    n_nan = stats[f"_nan{spec_idx}"]
    n_null = n - n_valid - n_nan
    target = max(1, n // buckets)
    mult = Counter(v for v in q if math.isfinite(v))
    hot_vals = sorted(v for v, m in mult.items() if m >= 2)
    pts = set(mult)
    for v in hot_vals:
        pts.add(math.nextafter(v, math.inf))
    splits = [-math.inf] + sorted(p for p in pts if math.isfinite(p)) + [math.inf]
    if len(splits) < 3:
        splits = [-math.inf, 0.0, math.inf]
    nb = len(splits) - 1          # regular buckets 0..nb-1; NaN -> nb; NULL -> nb+1
    hot = {}                       # bucket index -> estimated rows
    for v in hot_vals:
        b = splits.index(v)        # bucket [v, nextafter(v)) holds v only
        hot[b] = mult[v] * n_valid / max(1, len(q) + 1)
    if n_nan > 2 * target:
        hot[nb] = n_nan
    if n_null > 2 * target:
        hot[nb + 1] = n_null
    return splits, nb, hot, target


def _bucket_col(df: DataFrame, key: str, splits, nb: int, out: str) -> DataFrame:
    """Bucket index by binary search over literal splits (JVM Bucketizer)."""
    tmp = f"{out}__in"
    filled = df.withColumn(tmp, F.coalesce(F.nanvl(F.col(key).cast("double"), F.lit(0.0)), F.lit(0.0)))
    bz = Bucketizer(splits=splits, inputCol=tmp, outputCol=f"{out}__raw", handleInvalid="keep")
    b = bz.transform(filled)
    k = F.col(key).cast("double")
    return (b.withColumn(out, F.when(k.isNull(), F.lit(nb + 1))
                         .when(F.isnan(k), F.lit(nb))
                         .otherwise(F.col(f"{out}__raw").cast("int")))
            .drop(tmp, f"{out}__raw"))


def _sub_bounds(df: DataFrame, tie: str, hot_by_spec: dict, seed: int = 17) -> dict:
    """Tie-break boundaries splitting hot buckets into bounded pieces.

    ``hot_by_spec``: bucket column -> ({bucket: estimated rows}, target rows).
    One bounded sample of the rows of any hot bucket serves every spec.
    """
    hot_by_spec = {b: h for b, h in hot_by_spec.items() if h[0]}
    if not hot_by_spec:
        return {}
    total = sum(sum(h.values()) for h, _ in hot_by_spec.values())
    pieces = sum(math.ceil(est / target) for h, target in hot_by_spec.values() for est in h.values())
    # about SAMPLES_PER_PIECE keys per wanted piece place the cuts well enough
    frac = min(1.0, min(HOT_SAMPLE_ROWS, max(1_000, SAMPLES_PER_PIECE * pieces)) / max(1.0, total))
    cond = F.lit(False)
    for bcol, (hot, _) in hot_by_spec.items():
        cond = cond | F.col(bcol).isin(list(hot))
    rows = (df.filter(cond & F.col(tie).isNotNull()).select(*hot_by_spec, tie)
            .sample(False, frac, seed).limit(2 * HOT_SAMPLE_ROWS).collect())
    bounds = {}
    for bcol, (hot, target) in hot_by_spec.items():
        per = {}
        for r in rows:
            if r[bcol] in hot:
                per.setdefault(r[bcol], []).append(r[tie])
        bounds[bcol] = {}
        for b, est in hot.items():
            ties = sorted(set(per.get(b, [])))
            want = min(max(2, math.ceil(est / target)), max(1, len(ties)))
            cut = sorted({ties[(j * len(ties)) // want] for j in range(1, want)}) if want > 1 else []
            if cut:
                bounds[bcol][b] = cut
    return bounds


def _sub_col(bcol: str, tie: str, bounds: dict) -> F.Column:
    """Number of cuts of the row's bucket below its tie-break: every CUT_STEP-th cut first, then the cuts of that step."""
    if not bounds:
        return F.lit(0)

    def lookup(pick) -> F.Column:
        entries = []
        for b, cut in bounds.items():
            entries += [F.lit(b), F.array(*[F.lit(x) for x in pick(cut)])]
        return F.try_element_at(F.create_map(*entries), F.col(bcol))

    t = F.col(tie)
    below = lambda arr: F.size(F.filter(arr, lambda x: x < t))
    every = lookup(lambda cut: cut)
    steps = F.greatest(below(lookup(lambda cut: cut[::CUT_STEP])) - 1, F.lit(0)) * CUT_STEP
    place = steps + below(F.slice(every, steps + 1, CUT_STEP))
    # NULL tie-breaks sort last, so they go to the last piece of their bucket.
    return F.coalesce(F.when(t.isNull(), F.size(every)).otherwise(place), F.lit(0))


def exact_as_double(df: DataFrame, key: str) -> bool:
    """Do distinct values of the key stay distinct (and in order) as doubles?"""
    return isinstance(df.schema[key].dataType, (T.DoubleType, T.FloatType, T.IntegerType, T.ShortType, T.ByteType))


def _rank_by_range(df: DataFrame, spec: RankSpec, tie: str, range_rows: int) -> DataFrame:
    """Append one ranking of a key of any ordered type (BIGINT, DECIMAL, text, dates).

    Rows are range-partitioned and written in the native order of (partition
    keys, key, tie-break), so equal keys spread over files by their tie-break.  A row's place is the
    count of its partition's rows in earlier files plus its index in its own file; no window sees the rows.
    """
    ranges = max(1, -(-df.count() // range_rows))
    keys = [*[F.col(p).asc_nulls_last() for p in spec.parts], F.col(spec.key).asc_nulls_last(), F.col(tie).asc_nulls_last()]
    sorted_ = df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).withColumn("__file", F.spark_partition_id())
    rows = materialize(sorted_, "rank_ranges").select("*", F.col("_metadata.row_index").alias("__at"))
    group = [*spec.parts, "__file"]
    counts = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__from"))
    whole = Window.partitionBy(*spec.parts)
    before = F.sum("__n").over(whole.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*group, "__from", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__n").over(whole).alias("__total"))
    placed = join_small(rows, offsets, group).withColumn("__place", F.col("__before") + F.col("__at") - F.col("__from") + 1)
    if spec.kind == "percent_rank":
        by = [*spec.parts, spec.key]
        first = placed.groupBy(*by).agg(F.min("__place").alias("__first"))
        placed = join_small(placed, first, by)
        value = F.when(F.col("__total") > 1, (F.col("__first") - 1).cast("double") / (F.col("__total") - 1).cast("double")).otherwise(F.lit(0.0))
    elif spec.kind == "ntile":
        value = _ntile_sql("__place", "__total", spec.tiles)
    else:
        value = F.col("__place").cast("bigint")
    return placed.select(*df.columns, value.alias(spec.name))


def _ntile_sql(r: str, n: str, k: int) -> F.Column:
    """NTILE(k) of 1-based position ``r`` among ``n`` rows (integer arithmetic)."""
    q, m = f"({n} div {k})", f"({n} % {k})"
    c = f"({m} * ({q} + 1))"
    return F.expr(f"CAST(CASE WHEN {r} <= {c} THEN ({r} - 1) div ({q} + 1) + 1 "
                  f"ELSE {m} + ({r} - 1 - {c}) div greatest({q}, 1) + 1 END AS BIGINT)")


def _offsets(counts: DataFrame, spec: RankSpec, i: int, bcol: str, scol: str) -> DataFrame:
    """Per (partition keys, bucket, piece) with its row count ``_cnt``: rows
    before it, rows before its key, partition size and, when every row of
    the piece gets the same answer, that answer (``__const``)."""
    wpart = Window.partitionBy(*spec.parts)
    wcum = wpart.orderBy(bcol, scol).rowsBetween(Window.unboundedPreceding, -1)
    whole = wpart.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wkey = Window.partitionBy(*(list(spec.parts) + [bcol]))
    off = (counts
           .withColumn(f"__off{i}", F.coalesce(F.sum("_cnt").over(wcum), F.lit(0)).cast("bigint"))
           .withColumn(f"__npart{i}", F.sum("_cnt").over(whole).cast("bigint"))
           .withColumn(f"__kbase{i}", F.min(f"__off{i}").over(wkey))
           .withColumn("__first", F.col(f"__off{i}") + 1)
           .withColumn("__last", F.col(f"__off{i}") + F.col("_cnt")))
    if spec.kind == "ntile":
        first, last = _ntile_sql("__first", f"__npart{i}", spec.tiles), _ntile_sql("__last", f"__npart{i}", spec.tiles)
        const = F.when(first == last, first)
    elif spec.kind == "row_number":
        const = F.when(F.col("_cnt") == 1, F.col("__first"))
    else:
        const = F.lit(None).cast("bigint")
    return off.withColumn(f"__const{i}", const.cast("bigint")).drop("_cnt", "__first", "__last")


def _rank_by_value(pinned: DataFrame, spec: RankSpec) -> DataFrame:
    """PERCENT_RANK from pinned counts per (partition keys, key value ``__v``).

    Ties share a rank, so the rank of a row depends only on its key: rows
    with a smaller key in the partition, plus one.
    """
    wpart = Window.partitionBy(*spec.parts)
    below = F.coalesce(F.sum("_cnt").over(
        wpart.orderBy(F.col("__v").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    n = F.sum("_cnt").over(wpart.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    pr = F.when(n > 1, below.cast("double") / (n - 1).cast("double")).otherwise(F.lit(0.0))
    return pinned.select(*spec.parts, "__v", pr.alias(spec.name))


def _value_tables(df: DataFrame, prs: list[RankSpec], small_limit: int, stored_limit: int) -> dict[str, DataFrame]:
    """PERCENT_RANK by key value of every spec whose (partition, value) count table is small enough."""
    if not prs:
        return {}
    # counts per (partition, key value) of every PERCENT_RANK spec in one scan
    narrow = df.select(*_unique(p for x in prs for p in x.parts),
                       *[F.col(x.key).cast("double").alias(f"__v_{x.name}") for x in prs])
    cnt = [F.count(F.lit(1)).alias("_cnt")]
    tables = pinned_grouping_sets(narrow, [list(x.parts) + [f"__v_{x.name}"] for x in prs], cnt, small_limit)
    if tables is None:
        # too big to pin together: one by one, each pinned or stored (size checked)
        tables = [None if t is None else t[0] for t in
                  (pinned_grouping_sets(narrow, [list(x.parts) + [f"__v_{x.name}"]], cnt, small_limit,
                                        stored_limit) for x in prs)]
    return {x.name: _rank_by_value(t.withColumnRenamed(f"__v_{x.name}", "__v"), x) for x, t in zip(prs, tables) if t is not None}


def _key_stats(df: DataFrame, specs: list[RankSpec], buckets: int) -> dict:
    """Row count and, per spec, approximate quantiles, values and NaNs of its key (one aggregate)."""
    if not specs:
        return {}
    probs = [i / buckets for i in range(1, buckets)]
    acc = max(10_000, 20 * buckets)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, s in enumerate(specs):
        k = F.col(s.key).cast("double")
        valid = F.when(~F.isnan(k), k)
        aggs += [F.percentile_approx(valid, probs, acc).alias(f"_q{i}"),
                 F.count(valid).alias(f"_v{i}"),
                 F.count(F.when(F.isnan(k), 1)).alias(f"_nan{i}")]
    return df.agg(*aggs).first().asDict()


def add_ranks(df: DataFrame, specs: list[RankSpec], tie: str, buckets: int | None = None,
              small_limit: int = 200_000, stored_limit: int = STORED_ROW_LIMIT, range_rows: int = 1_000_000) -> DataFrame:
    """Append the ranking columns in ``specs`` to ``df``.

    * PERCENT_RANK: from the (partition, value) count table when it holds at
      most ``small_limit`` rows (pinned) or ``stored_limit`` rows (written
      and counted), joined back by broadcast: no shuffle of the rows.
      Otherwise bucketed as below.
    * NTILE / ROW_NUMBER: rows are range-bucketed on literal boundaries; a
      bucket that lies inside one tile gets its tile from the pinned offset
      table, and only rows of the buckets that straddle a tile edge (at most
      k - 1 per partition) are shuffled and numbered by a window.

    Keys that a double cannot hold exactly (BIGINT, DECIMAL, text, dates) are
    ranked in their own order from a sorted write (``_rank_by_range``).

    Before the final plan ``df`` is scanned for quantiles, counts and (with
    hot keys) a bounded sample, each pass reading only key, tie-break and
    partition columns: pass a materialised table.  The final plan scans it
    twice (constant and numbered rows) and unions the two.
    """
    if not specs:
        return df
    native = [x for x in specs if not exact_as_double(df, x.key)]
    if native:
        out = add_ranks(df, [x for x in specs if x not in native], tie, buckets, small_limit, stored_limit)
        for x in native:
            out = _rank_by_range(out, x, tie, range_rows)
        return out.select(*df.columns, *[x.name for x in specs])
    spark = df.sparkSession
    B = buckets or default_buckets(spark)

    prs = [x for x in specs if x.kind == "percent_rank"]
    others = [x for x in specs if x.kind != "percent_rank"]
    # the count tables of PERCENT_RANK and the key statistics of the rest are independent scans
    by_value, known = together(spark, lambda: _value_tables(df, prs, small_limit, stored_limit), lambda: _key_stats(df, others, B))
    bucketed = [x for x in specs if x.name not in by_value]

    plans, small = {}, True
    if bucketed:
        stats = known if bucketed == others else _key_stats(df, bucketed, B)
        narrow = df.select(*_unique([p for x in bucketed for p in x.parts] + [x.key for x in bucketed] + [tie]))
        hot_by_spec = {}
        for i, s in enumerate(bucketed):
            splits, nb, hot, target = _bucket_plan(stats, i, B, stats["_n"])
            narrow = _bucket_col(narrow, s.key, splits, nb, f"__b{i}")
            plans[i] = [splits, nb, hot]
            hot_by_spec[f"__b{i}"] = (hot, target)
        bounds = _sub_bounds(narrow, tie, hot_by_spec)
        for i, s in enumerate(bucketed):
            b = bounds.get(f"__b{i}", {})
            narrow = narrow.withColumn(f"__s{i}", _sub_col(f"__b{i}", tie, b))
            plans[i].append(b)
        # counts per (partition, bucket, piece) of every spec in one scan
        sets = [list(s.parts) + [f"__b{i}", f"__s{i}"] for i, s in enumerate(bucketed)]
        counts = pinned_grouping_sets(narrow, sets, [F.count(F.lit(1)).alias("_cnt")], small_limit)
        if counts is None:
            # more cells than may be broadcast: one stored table per spec, joined by shuffle
            small = False
            counts = [materialize(narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt")), "rank_cells")
                      for keys in sets]
        for i, s in enumerate(bucketed):
            offs = _offsets(counts[i], s, i, f"__b{i}", f"__s{i}")
            plans[i] = tuple(plans[i]) + (pin_small(offs, small_limit) if small else materialize(offs, "rank_offsets"),)

    out = df
    helpers = []
    for i, s in enumerate(bucketed):                 # bucket index: binary search, every row
        splits, nb, _, _, _ = plans[i]
        out = _bucket_col(out, s.key, splits, nb, f"__b{i}")
        helpers.append(f"__b{i}")

    def with_pieces(frame, i, s):
        """Piece index (hot buckets split on the tie-break) and the piece lookup."""
        _, _, _, bounds, offs = plans[i]
        frame = frame.withColumn(f"__s{i}", _sub_col(f"__b{i}", tie, bounds))
        return join_small(frame, offs, list(s.parts) + [f"__b{i}", f"__s{i}"], limit=small_limit, pinned=small)

    def piece_cols(i):
        return [f"__s{i}", f"__off{i}", f"__npart{i}", f"__kbase{i}", f"__const{i}"]

    positional = [(i, s) for i, s in enumerate(bucketed) if s.kind != "percent_rank"]
    if positional:
        # A bucket whose pieces all share one answer is constant as a whole: its
        # rows need neither a piece index nor a window.
        need = F.lit(False)
        for i, s in positional:
            c = f"__const{i}"
            whole = plans[i][4].groupBy(*s.parts, f"__b{i}").agg(
                F.when((F.min(c) == F.max(c)) & (F.count(c) == F.count(F.lit(1))), F.min(c)).alias(f"__bconst{i}"))
            out = join_small(out, pin_small(whole, small_limit) if small else whole, list(s.parts) + [f"__b{i}"],
                             limit=small_limit, pinned=small)
            helpers.append(f"__bconst{i}")
            need = need | F.col(f"__bconst{i}").isNull()
        fixed = out.filter(~need).withColumns({s.name: F.col(f"__bconst{i}") for i, s in positional})
        moving = out.filter(need)
        for i, s in positional:
            moving = with_pieces(moving, i, s)
        if small and stats["_n"] >= APART_ROWS:
            # of those rows, the ones whose pieces have one answer each need no window either; a piece without one stays whole
            told = {i: F.coalesce(F.col(f"__bconst{i}"), F.col(f"__const{i}")) for i, _ in positional}
            open_ = F.lit(False)
            for known in told.values():
                open_ = open_ | known.isNull()
            fixed = fixed.unionByName(moving.filter(~open_).withColumns({s.name: told[i] for i, s in positional}).drop(
                *[c for i, _ in positional for c in piece_cols(i)]))
            moving = moving.filter(open_)
        for i, s in positional:
            grp = list(s.parts) + [f"__b{i}", f"__s{i}"]
            w = Window.partitionBy(*grp).orderBy(F.col(s.key).cast("double").asc_nulls_last(),
                                                 F.col(tie).asc_nulls_last())
            moving = moving.withColumn(f"__r{i}", (F.col(f"__off{i}") + F.row_number().over(w)).cast("bigint"))
            val = F.col(f"__r{i}") if s.kind == "row_number" else _ntile_sql(f"__r{i}", f"__npart{i}", s.tiles)
            moving = (moving.withColumn(s.name, F.coalesce(F.col(f"__bconst{i}"), F.col(f"__const{i}"), val))
                      .drop(f"__r{i}", *piece_cols(i)))
        out = fixed.unionByName(moving)

    for i, s in enumerate(bucketed):
        if s.kind != "percent_rank":
            continue
        _, _, hot, _, _ = plans[i]
        out = with_pieces(out, i, s)
        grp = list(s.parts) + [f"__b{i}", f"__s{i}"]
        hot_b = F.col(f"__b{i}").isin(list(hot)) if hot else F.lit(False)
        base = F.when(hot_b, F.col(f"__kbase{i}")).otherwise(F.col(f"__off{i}"))
        rank = base + F.rank().over(Window.partitionBy(*grp).orderBy(F.col(s.key).cast("double").asc_nulls_last()))
        npart = F.col(f"__npart{i}")
        out = out.withColumn(s.name, F.when(npart > 1, (rank - 1).cast("double") / (npart - 1).cast("double"))
                             .otherwise(F.lit(0.0))).drop(*piece_cols(i))

    for name, t in by_value.items():
        s = next(x for x in specs if x.name == name)
        kcol = f"__k_{name}"
        out = join_small(out.withColumn(kcol, F.col(s.key).cast("double")),
                         t.withColumnRenamed("__v", kcol), list(s.parts) + [kcol], how="left",
                         limit=small_limit, pinned=True).drop(kcol)

    out = out.drop(*helpers)
    return out.select(*df.columns, *[s.name for s in specs])
