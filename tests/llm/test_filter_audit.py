"""Filter audit against a brute force that applies every order row by row, and against its DuckDB text."""

import collections
import itertools
import os
import re

import duckdb
import pytest

from lendlens.llm import filter_audit
from lendlens.llm.oracles import ORACLES
from lendlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LABELS = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (3, 1, 1), (5, 1, None), (None, 1, 1), (7, 1, 1), (8, 1, 0)]
NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(rows, labels):
    def fails(i, t, first):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        return {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
                "D": any(c in "#$%&*|" for c in t), "E": first is not None and (i is None or i > first)}

    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = collections.defaultdict(list)
    for i, t, s in rows:
        parts[s or ""].append((i, fails(i, t, first.get(t or ""))))
    out = []
    for part, held in parts.items():
        shapley, told = collections.Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = held
            for step, f in enumerate(order, 1):
                gone = [x for x in left if x[1][f]]
                left = [x for x in left if not x[1][f]]
                shapley[f] += len(gone)
                told.append((part, "".join(order), step, len(left), len(gone), sum(x[1][f] for x in held) - len(gone),
                             sum(x[1][f] and sum(x[1].values()) == 1 for x in held), sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)))
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in told]
    return sorted(out)


def odd_rows():
    long = " ".join(f"w{i}" for i in range(250))
    texts = [None, "", " \n", "short", "short", "SHOUT IT", "SHOUT IT", "a # b", long, long, long + " #", long + " ABCDEFGHIJKLMNOPQRSTUVWXYZABCDEF", "x " * 400,
             "x " * 400 + "$", "ÄÖÜ ä", "50 AB" + "c" * 96]
    rows = [(i, t, ["s", None, "", "t"][i % 4]) for i, t in enumerate(texts)]
    return rows + [rows[9], rows[9], (None, long, "s"), (None, "nowhere else", "t"), (None, "nowhere else", "t"), (99, None, "s"), (3, "short", "u")] + [
        (500 + i, "one text in a third of all rows", "hot") for i in range(15)]


def got(df):
    return sorted(tuple(r[c] for c in NAMES) for r in df.collect())


@pytest.fixture(scope="module")
def frames(spark):
    rows = odd_rows()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, mask int, part string").repartition(5)
    return rows, docs, spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def test_odd_rows(frames):
    rows, docs, labels = frames
    assert got(filter_audit.audit(docs, labels)) == brute(rows, LABELS)


def test_shared_hashes(frames, monkeypatch):
    """All texts under a few hashes: the texts themselves settle which are equal."""
    rows, docs, labels = frames
    from pyspark.sql import functions as F
    monkeypatch.setattr(filter_audit, "text_keys", lambda t: [F.pmod(F.length(t), F.lit(3)).cast("long").alias("h"), F.lit(1).cast("long").alias("h2")])
    assert got(filter_audit.audit(docs, labels)) == brute(rows, LABELS)


def test_frequent_texts_apart(frames):
    """The join that splits frequent texts off gives the same rows as the broadcast."""
    rows, docs, _ = frames
    held = filter_audit.materialize(filter_audit.flagged_rows(docs), "test-audit")
    repeats, clashes = filter_audit.repeated_texts(docs, held)
    assert clashes.isEmpty()
    a = filter_audit.with_repeats(docs, held, repeats, clashes)
    b = filter_audit.with_repeats(docs, held, repeats, clashes, frequent=4, most=1)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count() == len(rows)


def test_prepass_clears_unique_texts(spark):
    rows = spark.range(30000).selectExpr("xxhash64(CASE WHEN id < 100 THEN id % 50 ELSE id END) AS h")
    left = rows.filter(filter_audit.possible_repeats(rows)("h"))
    assert left.selectExpr("h").intersectAll(rows.groupBy("h").count().filter("count > 1").select("h")).count() == 50
    assert 100 <= left.count() < 2500


def test_query_against_duckdb(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(SF, t)}.parquet'")
    want = con.execute(f"SELECT {', '.join(NAMES)} FROM ({ORACLES['op12_filter_audit']})").fetchall()
    df = QUERIES["op12_filter_audit"](spark, SF)
    assert got(df) == sorted(want) and dict(df.dtypes)["step"] == "int" and dict(df.dtypes)["shapley"] == "bigint"


def test_empty(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert got(filter_audit.audit(empty, labels)) == []
