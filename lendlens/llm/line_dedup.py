"""Line dedup: repeated runs of lines leave the texts (DataFrame functions only).

A text is split at line feeds.  A line goes when it lies in a run of
consecutive lines of at least ``words`` words that also occurs, byte for byte,
at an earlier place (smaller doc_id, then text hash, then line).  Lines and
surroundings on either side of the run do not matter.  No rows are dropped.

Found without comparing pairs: for every line with a word the shortest run of
``words`` words that starts there and the shortest one that ends there are
indexed.  Any longer run is the union of such runs that lie inside it, so the
lines of repeated indexed runs are exactly the lines of all repeated runs.  A
text has at most two indexed runs a line; their ends come from sums over 1, 2,
4 ... lines by binary descent.  Runs are counted by SHA-256 and length over
all texts.  The bytes of every class that occurs more than once are compared
by taking their least and greatest (equal exactly when all are); only
byte-equal classes count as repeated.

Defined cases: NULL and empty texts stay as they are; equal rows (same doc_id
and text) are treated as one document and keep the same lines; NULL doc_ids
rank first; blank lines inside a removed run go with it, those at its edges
stay; a run may overlap its own earlier place (of a, a, a the first line
stays); the first place of a line never goes; other columns are kept as they
are, ``n_chars`` (where present) is recounted; ``n_removed_chunks`` counts the
removed stretches of neighbouring lines; a caller's column named like one of
the three counts is kept and that count left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import column, few_elements, materialize, pinned, small_enough

CLASS = ["sha", "bytes"]
BROADCAST_RUNS = 2_000_000   # runs (at most about 60 bytes each) that may be broadcast with their texts' keys


def with_lines(docs: DataFrame) -> DataFrame:
    """Rows (_row: the caller's columns, _text, _doc and _key: row identity, _lines)."""
    text = column(docs, "text", "string")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), text.alias("_text"),
                       column(docs, "doc_id", "long").alias("_doc"), F.xxhash64(text).alias("_key"))
    return pinned(rows, _lines=F.split(F.coalesce("_text", F.lit("")), "\n"))


def _body(lo: Column, hi: Column) -> Column:
    return F.array_join(F.transform(F.sequence(lo, hi), lambda k: F.get("_lines", k)), "\n")


def _shortest(rows: DataFrame, counts: Column, words: int, out: str) -> DataFrame:
    """``rows`` plus ``out``: for each place of ``counts`` (all positive) where the shortest run of ``words`` from there ends (size or more: nowhere)."""
    levels = max(words - 1, 1).bit_length()
    rows = pinned(rows, _sum0=counts)
    for k in range(1, levels):
        half = f"_sum{k - 1}"
        rows = pinned(rows, **{f"_sum{k}": F.transform(half, lambda x, i: x + F.coalesce(F.get(half, i + (1 << k - 1)), F.lit(0)))})
    at = F.transform("_sum0", lambda x, i: F.struct(i.alias("end"), F.lit(0).alias("held")))

    def step(k: int):
        def go(a: Column) -> Column:
            more = a["held"] + F.get(f"_sum{k}", a["end"])
            return F.when(more < words, F.struct((a["end"] + (1 << k)).alias("end"), more.alias("held"))).otherwise(a)
        return go

    for k in reversed(range(levels)):
        at = F.transform(at, step(k))
    return pinned(rows, **{out: F.transform(at, lambda a: a["end"])}).drop(*[f"_sum{k}" for k in range(levels)])


def line_runs(docs: DataFrame, words: int) -> DataFrame:
    """_doc, _key, lo, hi (first and last line), sha, bytes of every indexed run."""
    rows = with_lines(docs).select("_doc", "_key", "_lines")
    count = lambda line: F.size(F.array_remove(F.split(line, "[\\x20\\x09-\\x0D]+"), ""))
    rows = pinned(rows, _words=F.transform("_lines", count))
    rows = pinned(rows, _units=F.filter(F.sequence(F.lit(0), F.size("_lines") - 1), lambda i: F.get("_words", i) > 0))
    rows = pinned(rows, _counts=F.transform("_units", lambda i: F.get("_words", i)), _size=F.size("_units"))
    rows = _shortest(rows, F.col("_counts"), words, "_ends")
    rows = _shortest(rows, F.reverse("_counts"), words, "_starts")
    last = F.col("_size") - 1
    code = lambda lo, hi: F.get("_units", lo).cast("long") * F.lit(1 << 32) + F.get("_units", hi)
    forward = F.transform("_ends", lambda end, i: F.when(end <= last, code(i, end)))
    backward = F.transform("_starts", lambda end, i: F.when(end <= last, code(last - end, last - i)))
    rows = pinned(rows, _runs=F.array_compact(F.array_distinct(F.concat(forward, backward))))
    ends = lambda r: (F.shiftright(r, 32).cast("int"), r.bitwiseAND(F.lit((1 << 32) - 1)).cast("int"))
    bodies = F.transform("_runs", lambda r: F.struct(ends(r)[0].alias("lo"), ends(r)[1].alias("hi"), _body(*ends(r)).alias("body")))
    digest = F.transform(bodies, lambda r: F.struct(r["lo"].alias("lo"), r["hi"].alias("hi"), F.unhex(F.sha2(r["body"], 256)).alias("sha"),
                                                    F.octet_length(r["body"]).alias("bytes")))
    return rows.select("_doc", "_key", F.explode(digest).alias("r")).select("_doc", "_key", "r.*")


def repeated_runs(docs: DataFrame, words: int = 50) -> DataFrame:
    """_doc, _key, lo, hi of the runs that occurred earlier, byte for byte."""
    at = F.struct(F.col("_doc").alias("doc"), F.col("_key").alias("key"), F.col("lo").alias("lo"))
    runs = materialize(line_runs(docs, words), "line-runs")
    classes = runs.groupBy(*CLASS).agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first")).filter("n > 1").drop("n")
    places = materialize(runs.join(small_enough(materialize(classes, "line-classes"), 200_000), CLASS), "line-places")
    held = places.groupBy(F.col("_doc").alias("_d"), F.col("_key").alias("_k")).agg(F.collect_set(F.struct("lo", "hi", *CLASS)).alias("_held"))
    held = few_elements(materialize(held, "line-held"), "_held", BROADCAST_RUNS)
    rows = with_lines(docs).select("_doc", "_key", "_lines").join(held, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_key") == F.col("_k")))
    bodies = rows.select(F.explode(F.transform("_held", lambda r: F.struct(
        r["sha"].alias("sha"), r["bytes"].alias("bytes"), _body(r["lo"], r["hi"]).alias("body")))).alias("r")).select("r.*")
    unequal = bodies.groupBy(*CLASS).agg((F.min("body") != F.max("body")).alias("unequal")).filter("unequal").select(*CLASS)
    unequal = materialize(unequal, "line-unequal")
    if not unequal.isEmpty():
        places = places.join(unequal, CLASS, "left_anti")
    return places.filter(~at.eqNullSafe(F.col("first"))).select("_doc", "_key", "lo", "hi")


def dedup_lines(docs: DataFrame, words: int = 50) -> DataFrame:
    """``docs`` with repeated runs of lines removed from ``text``, plus n_lines, n_removed_lines, n_removed_chunks."""
    removed = repeated_runs(docs, words).groupBy(F.col("_doc").alias("_d"), F.col("_key").alias("_k")).agg(
        F.collect_set(F.struct("lo", "hi")).alias("_gone"))
    removed = few_elements(materialize(removed, "line-removed"), "_gone", BROADCAST_RUNS)
    joined = with_lines(docs).join(removed, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_key") == F.col("_k")), "left")
    everything = F.sequence(F.lit(0), F.size("_lines") - 1)
    gone = F.array_distinct(F.flatten(F.transform("_gone", lambda g: F.sequence(g["lo"], g["hi"]))))
    joined = pinned(joined, _gone=F.coalesce(gone, F.array().cast("array<int>")))
    joined = pinned(joined, _kept=F.when(F.size("_gone") > 0, F.array_except(everything, "_gone")))
    text = F.col("_text")
    clean = F.when(F.col("_kept").isNull(), text).otherwise(F.array_join(F.transform("_kept", lambda k: F.get("_lines", k)), "\n"))
    own = {c: F.col("_row")[c] for c in docs.columns}
    own["text"] = clean
    if "n_chars" in docs.columns:
        own["n_chars"] = F.when(F.col("_kept").isNull(), own["n_chars"]).otherwise(F.length(clean).cast(docs.schema["n_chars"].dataType))
    told = {"n_lines": F.when(text.isNull(), F.lit(0)).otherwise(F.size("_lines")).cast("long"), "n_removed_lines": F.size("_gone").cast("long"),
            "n_removed_chunks": F.size(F.array_except("_gone", F.transform("_gone", lambda k: k + 1))).cast("long")}
    return joined.select(*[v.alias(c) for c, v in own.items()], *[v.alias(c) for c, v in told.items() if c not in docs.columns])
