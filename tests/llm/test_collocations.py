"""Phrase mining against a brute force over all word windows, and against its DuckDB text."""

import collections
import os
import re

import duckdb
import numpy as np
import pytest

from lendlens.llm import collocations as C
from lendlens.llm.oracles import ORACLES
from lendlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least, top):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f.update((lang, tuple(w[s:s + k])) for s in range(len(w) - k + 1))
    found = collections.defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        inside = any(q[s:s + len(p)] == p for (g, q), b in f.items() if g == lang and b >= a and len(q) > len(p) for s in range(len(q) - len(p) + 1))
        if not inside:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            found[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, rank, p.decode(), -a, left, right, n[lang], -score) for lang, held in found.items()
                  for rank, (score, a, p, left, right) in enumerate(sorted(held)[:top], 1))


def got(df):
    return sorted(tuple(r[c] for c in NAMES) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.RandomState(11)
    words = ["the", "The", "cat", "sat", "on", "mat", "ß", "größe", "x-y", "a$b", "(very", " wide", "e", "é"]
    text = lambda n: "".join(words[min(int(k), 13)] + str(rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", "!"])) for k in rng.geometric(0.25, n))
    out = [(["en", "de", None, "und", ""][i % 5], text(int(rng.randint(1, 30)))) for i in range(150)]
    out += [("en", None), ("en", ""), (None, " \t"), ("en", "...!?"), ("en", "one two three four five six seven"), ("de", text(4000)), ("x", "Same Words here now and then. " * 40)]
    return out + [("en", "a third of all rows say the very same thing")] * 60


def test_brute_force(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "lang string, text string, id int, word string").repartition(4)
    want = brute(rows, 5, 40)
    assert max(len(w[2].split(" ")) for w in want) == 5 and len({w[0] for w in want}) >= 5
    assert got(C.collocations(docs, 5, 40, part=60)) == want


def test_dense_tiles_and_blocks(spark):
    """Few words, many times: dense tiles, several blocks, one giant text without an end of a piece."""
    rng = np.random.RandomState(2)
    giant = " ".join(f"w{k}" for k in np.minimum(rng.geometric(0.02, 1_300_000), 400))
    df = spark.createDataFrame([("en", giant), ("en", "w1 w2 w3")], "lang string, text string").coalesce(1)
    words = giant.split(" ")
    pairs = collections.Counter(zip(words, words[1:]))
    pairs.update([("w1", "w2"), ("w2", "w3")])
    _, levels = C.phrase_levels(df, 100, 2)
    assert {r["phrase"]: r["a"] for r in levels[1].collect()} == {" ".join(p): n for p, n in pairs.items() if n >= 100}


def test_local_pairs():
    rng = np.random.RandomState(1)
    seq = np.concatenate([np.minimum(rng.geometric(0.001, 200_000) - 1, 9000), rng.randint(-1, 10 ** 7, 5000)]).astype(np.int64)
    tile, cell, counts, at, back = C.local_pairs(seq, 10 ** 7 // C.TILE + 1)
    tiles = 10 ** 7 // C.TILE + 1
    pairs = list(zip(((tile // tiles) * C.TILE + cell // C.TILE).tolist(), ((tile % tiles) * C.TILE + cell % C.TILE).tolist()))
    want = collections.Counter((a, b) for a, b in zip(seq[:-1].tolist(), seq[1:].tolist()) if a >= 0 and b >= 0)
    assert dict(zip(pairs, counts.tolist())) == want
    assert [pairs[k] for k in back.tolist()] == [(int(seq[i]), int(seq[i + 1])) for i in at.tolist()]


def test_exact_arithmetic(spark):
    """Products beyond 64 bits."""
    big = 4 * 10 ** 12
    row = spark.createDataFrame([(big - 1, [big, big - 1], [big, big - 1], 10 ** 13)], "a long, heads array<long>, tails array<long>, n long")
    assert row.selectExpr(C.SCORED + ".score").first()[0] == 1000 * (big - 1) * 10 ** 13 // (big * big)


def test_query_against_duckdb(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{os.path.join(SF, 'documents.parquet')}'")
    want = con.execute(f"SELECT {', '.join(NAMES)} FROM ({ORACLES['op11_collocations']})").fetchall()
    assert got(QUERIES["op11_collocations"](spark, SF)) == sorted(want) and len(want) > 50


def test_empty(spark, empty):
    assert got(C.collocations(empty)) == []
    assert got(C.collocations(spark.createDataFrame([(1,)], "doc_id long"))) == []
