"""Chat formatting of reply trees (DataFrame functions only).

Messages form trees (tree_id, node_id, parent_id).  Iterative self-joins by
pointer doubling give each message its 2^k-th ancestor; from the leaves the
same tables are walked back from the largest step to the smallest, which lists
every message of every root-to-leaf path once, in about log2(depth) joins in
each direction.  Branches are ranked by their mean message score (ties: the
smaller leaf) and the best path of a tree is formatted as one conversation.

Template: ``<|turn|>role<|text|>text<|end|>`` per message.  Inside roles and
texts ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``, so no text can hold a
mark and reading back is exact.  The loss mask lists the code-point ranges of
the assistant texts in the formatted conversation.

Defined cases: NULL text and role are empty; messages whose parent is missing
start a path of their own; a NULL tree id is a tree; equal messages of a
conversation keep their number; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendlens.llm.common import column, materialize, pinned
from lendlens.llm.pii import running_sums

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, "(?s)\\\\(.)", "$1")


def linear_nodes(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text rows as chain trees: node_id numbers a conversation's rows by turn, parent is the row before.

    Rows are ranked through a stored range partitioning, so that one very long
    conversation is numbered by many tasks.
    """
    rows = rows.select(column(rows, "conv_id", "long").alias("tree_id"), column(rows, "turn", "long").alias("turn"),
                       F.coalesce(column(rows, "role", "string"), F.lit("")).alias("role"),
                       F.coalesce(column(rows, "text", "string"), F.lit("")).alias("text"))
    order = ["turn", "role", "text"]
    parts = max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = rows.withColumn("_h", F.xxhash64("role", "text")).repartitionByRange(parts, "tree_id", "turn", "_h")
    cut = materialize(cut.withColumn("_part", F.spark_partition_id()), "chat-rows")
    # equal (tree, turn) rows may lie in two parts in hash order; within a turn any fixed order will do
    counts = cut.groupBy("tree_id", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("tree_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("tree_id").alias("_t"), F.col("_part").alias("_q"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = cut.withColumn("_i", F.row_number().over(Window.partitionBy("tree_id", "_part").orderBy("turn", "_h", *order[1:])))
    joined = ranked.join(starts, F.col("tree_id").eqNullSafe(F.col("_t")) & (F.col("_part") == F.col("_q")))
    node = (F.col("_start") + F.col("_i") - 1).cast("long")
    return joined.select("tree_id", node.alias("node_id"), F.when(node > 0, node - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def paths(nodes: DataFrame) -> DataFrame:
    """tree_id, leaf, node_id, up (steps above the leaf) for every message on a root-to-leaf path."""
    keys = nodes.select("tree_id", "node_id", "parent_id")
    known = keys.select(F.col("tree_id").alias("_t"), F.col("node_id").alias("_n"))
    steps = [materialize(keys.join(known, F.col("tree_id").eqNullSafe(F.col("_t")) & (F.col("parent_id") == F.col("_n")))
                         .select("tree_id", "node_id", F.col("parent_id").alias("up_id")), "chat-up-0")]
    while not steps[-1].isEmpty():                            # 2^k-th ancestors, until no message has one
        further = steps[-1].select(F.col("tree_id").alias("_t"), F.col("node_id").alias("_n"), F.col("up_id").alias("_u"))
        steps.append(materialize(steps[-1].join(further, F.col("tree_id").eqNullSafe(F.col("_t")) & (F.col("up_id") == F.col("_n")))
                                 .select("tree_id", "node_id", F.col("_u").alias("up_id")), f"chat-up-{len(steps)}"))
    parents = steps[0].select(F.col("tree_id").alias("_t"), F.col("up_id").alias("_n")).distinct()
    walk = keys.join(parents, F.col("tree_id").eqNullSafe(F.col("_t")) & (F.col("node_id") == F.col("_n")), "left_anti").select(
        "tree_id", F.col("node_id").alias("leaf"), "node_id", F.lit(0).cast("long").alias("up"))
    for k in range(len(steps) - 1, -1, -1):
        jump = steps[k].select(F.col("tree_id").alias("_t"), F.col("node_id").alias("_n"), F.col("up_id").alias("_u"))
        above = walk.join(jump, F.col("tree_id").eqNullSafe(F.col("_t")) & (F.col("node_id") == F.col("_n"))).select(
            "tree_id", "leaf", F.col("_u").alias("node_id"), (F.col("up") + (1 << k)).alias("up"))
        walk = materialize(walk.unionByName(above), "chat-walk")
    return walk


def format_trees(nodes: DataFrame, best_only: bool = True) -> DataFrame:
    """tree_id, leaf, score, formatted, loss_spans: the best branch of each tree (or all) as one conversation."""
    nodes = materialize(nodes, "chat-nodes")
    walk = paths(nodes)
    told = nodes.select(F.col("tree_id").alias("_t"), F.col("node_id").alias("_n"), "role", "text", "score")
    on = F.col("tree_id").eqNullSafe(F.col("_t")) & (F.col("node_id") == F.col("_n"))
    if best_only:                       # ranked on keys and scores; texts join the chosen path only
        score = walk.join(told.select("_t", "_n", "score"), on).groupBy("tree_id", "leaf").agg(F.avg("score").alias("s"))
        best = score.groupBy("tree_id").agg(F.max(F.struct("s", (-F.col("leaf")).alias("l"))).alias("b")).select(
            F.col("tree_id").alias("_bt"), (-F.col("b.l")).alias("_leaf"))
        walk = walk.join(best, F.col("tree_id").eqNullSafe(F.col("_bt")) & (F.col("leaf") == F.col("_leaf")))
    full = walk.join(told, on)
    turns = full.groupBy("tree_id", "leaf").agg(
        F.avg("score").alias("score"), F.array_sort(F.collect_list(F.struct((-F.col("up")).alias("at"), "role", "text"))).alias("turns"))
    parts = F.transform("turns", lambda t: F.struct(
        (t["role"] == "assistant").alias("learn"), F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)).alias("head"), escape(t["text"]).alias("body")))
    turns = pinned(turns, _parts=parts)
    turns = turns.withColumn("formatted", F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""))
    sizes = F.transform("_parts", lambda p: F.length(p["head"]) + F.length(p["body"]) + len(END))
    turns = pinned(turns, _stops=running_sums(sizes))
    stop = lambda i: F.get("_stops", i) - len(END)
    spans = F.array_compact(F.transform("_parts", lambda p, i: F.when(p["learn"], F.struct(
        (stop(i) - F.length(p["body"])).alias("start"), stop(i).alias("end")))))
    return turns.withColumn("loss_spans", spans).select("tree_id", "leaf", "score", "formatted", "loss_spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds turns (role, text) and loss_text, read from ``formatted`` and ``loss_spans`` alone."""
    pieces = F.slice(F.split("formatted", "<\\|turn\\|>", -1), 2, 1 << 30)
    rows = pinned(formatted, _pieces=pieces)

    def turn(p: Column) -> Column:
        at = F.instr(p, TEXT)
        return F.struct(unescape(F.substring(p, F.lit(1), at - 1)).alias("role"),
                        unescape(F.substring(p, at + len(TEXT), F.length(p) - at - len(TEXT) - len(END) + 1)).alias("text"))

    rows = rows.withColumn("turns", F.transform("_pieces", turn))
    # a piece's own range under the mask: ranges are looked up by where the piece ends
    ends = F.map_from_entries(F.transform("loss_spans", lambda s: F.struct(s["end"], s["start"])))
    rows = pinned(rows, _ends=ends, _stops=running_sums(F.transform("_pieces", lambda p: F.length(p) + len(TURN))))
    stop = lambda i: F.get("_stops", i) - len(END)

    def learnt(p: Column, i: Column) -> Column:
        start = F.element_at("_ends", stop(i))
        return F.when(F.map_contains_key("_ends", stop(i)), F.substring(p, F.length(p) - len(END) - (stop(i) - start) + 1, stop(i) - start))

    text = F.array_compact(F.transform("_pieces", learnt))
    return rows.withColumn("loss_text", F.array_join(F.transform(text, unescape), "")).drop("_pieces", "_ends", "_stops")
