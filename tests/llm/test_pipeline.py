"""Each pipeline stage against a brute-force version of it, on the stage's own input rows."""

import collections
import os
import re
import zlib

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from lendlens.llm.common import materialize, table
from lendlens.llm.queries import tokenizer_file
from test_operators import brute_components, lower

SF = "/root/testdata/sf0.001"


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def spark_hash(data, seed=42):
    """xxhash64 of a text, or of a long under the hash of the column before it."""
    raw = data.encode() if isinstance(data, str) else data.to_bytes(8, "little", signed=True)
    return signed(xxhash.xxh64_intdigest(raw, seed % (1 << 64)))


def brute_lines(rows, words=50):
    """(doc_id, text) without the lines of runs of ``words`` words that occur at an earlier place: every pair of equal lines is followed to its end."""
    ident = lambda row: (row[0] is not None, row[0] or 0, spark_hash(row[1] or ""))
    texts = {ident(r): (r[1] or "").split("\n") for r in rows}
    count = {i: [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in lines] for i, lines in texts.items()}
    places, gone = collections.defaultdict(list), collections.defaultdict(set)
    for i in sorted(texts):
        for k, line in enumerate(texts[i]):
            if count[i][k]:
                places[line].append((i, k))
    for held in places.values():
        for n, (i, at) in enumerate(held):
            for j, to in held[n + 1:]:
                size = 0
                while at + size < len(texts[i]) and to + size < len(texts[j]) and texts[i][at + size] == texts[j][to + size]:
                    size += 1
                while not count[j][to + size - 1]:
                    size -= 1
                if sum(count[j][to:to + size]) >= words:
                    gone[j].update(range(to, to + size))
    return [(r[0], r[1] if not gone[ident(r)] else "\n".join(x for k, x in enumerate(texts[ident(r)]) if k not in gone[ident(r)])) for r in rows]


def brute_contaminated(rows, tests, size=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    windows = set()
    for t in tests:
        q = words(t)
        windows.update(tuple(q[k:k + size]) for k in range(max(len(q) - size, 0) + 1 if q else 0))
    lengths = {len(w) for w in windows}
    bad = set()
    for doc, text in rows:
        w = words(text)
        if any(tuple(w[s:s + n]) in windows for n in lengths for s in range(len(w) - n + 1)):
            bad.add(doc)
    return bad


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The small tables with null, empty, repeated and letterless rows added."""
    path = str(tmp_path_factory.mktemp("sf"))
    documents = table(spark, SF, "documents")
    passage = "\n".join(f"line {i} of a shared passage" for i in range(30))
    odd = [(9001, None), (9002, ""), (9003, "12 34"), (9004, "one two three four five six seven"), (9004, "one two three four five six seven"),
           (9005, "start of one\n" + passage), (9006, "start of another\nand more\n" + passage), (None, "no id here")]
    rows = spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in odd],
                                 documents.select("doc_id", "text", "lang", "source", "n_chars").schema)
    documents.unionByName(rows).write.parquet(os.path.join(path, "documents.parquet"))
    table(spark, SF, "benchmark").write.parquet(os.path.join(path, "benchmark.parquet"))
    return path


def test_stages_against_brute_force(spark, folder):
    from tokenizers import Tokenizer
    docs = table(spark, folder, "documents")
    tests = [r["text"] for r in table(spark, folder, "benchmark").collect()]
    columns = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = pairs(docs), materialize(stage(spark, docs, folder), "test-stage")
        if name == "language id":
            want = [(i, t) for i, t in before if any(c.isalpha() for c in t or "")]
        elif name == "line dedup":
            want = brute_lines(before)
            assert sum(a != b for a, b in zip(before, want)) > 0
        elif name == "near duplicates":
            stays = {(i, c) for i, _, c in brute_components([(i, t or "") for i, t in before])}
            want = [(i, t) for i, t in before if not (t or "").split()]           # empty sets link with nothing and stay
            want += list({(i, t) for i, t in before if (t or "").split() and (i is None or (i, i) in stays)})
            assert len(want) < len(before)
        elif name == "decontamination":
            bad = brute_contaminated(before, tests)
            want = [(i, t) for i, t in before if i not in bad]
            assert 0 < len(want) < len(before)
        else:
            tokenizer, pieces = Tokenizer.from_file(tokenizer_file()), collections.Counter()
            for i, t in before:
                ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
                pieces.update((i, s, len(ids[s:s + 4096]), zlib.crc32(ids[s:s + 4096].tobytes()), len(ids)) for s in range(0, len(ids), 4096))
            got = docs.collect()
            assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == pieces
            ends = collections.defaultdict(int)
            for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
                assert r["offset"] == ends[r["sequence_id"]]
                ends[r["sequence_id"]] += r["length"]
            assert max(ends.values()) <= 4096
            break
        assert sorted(pairs(docs), key=key) == sorted(want, key=key), name
        assert docs.columns == columns, name
    assert number == 4
    chained = collections.Counter((r["doc_id"], r["start"], r["ids_crc32"]) for r in got)
    assert collections.Counter((r["doc_id"], r["start"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, folder).collect()) == chained


def test_empty_table(spark, folder, tmp_path):
    table(spark, folder, "documents").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    table(spark, folder, "benchmark").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
