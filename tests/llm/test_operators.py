"""Small brute-force checks of the training-data operators on odd rows and empty tables."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendlens.llm import cutting_stock, language_id
from lendlens.llm.chat import format_trees, linear_nodes, read_back
from lendlens.llm.components import components
from lendlens.llm.decontaminate import find_contamination
from lendlens.llm.exact_dedup import exact_dedup
from lendlens.llm.jaccard_join import jaccard_components
from lendlens.llm.katz import score_texts
from lendlens.llm.line_dedup import dedup_lines
from lendlens.llm.packing import pack
from lendlens.llm.pii import find_pii, span_text
from lendlens.llm.queries import tokenizer_file
from lendlens.llm.sharding import shard_documents


def rows_of(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.collect()]


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def test_exact_dedup(docs, empty):
    groups = collections.defaultdict(list)
    for i, t in rows_of(docs):
        groups[re.sub(r"[\x20\x09-\x0D]+", "", t)].append((i, len(t)))
    want = sorted((i, hashlib.sha256(k.encode()).hexdigest(), len(g), min((-n, j) for j, n in g if j is not None)[1] if g[0][0] is not None else None)
                  for k, g in groups.items() for i, _ in g if i is not None)
    got = exact_dedup(docs, runs=4, fan_in=2).collect()
    assert sorted((r["doc_id"], r["text_sha256"], r["group_size"], r["keep_id"]) for r in got if r["doc_id"] is not None) == want
    assert len(got) == docs.count() and exact_dedup(empty).count() == 0


def test_sharding_moves_only_into_the_new_shard(docs, empty):
    def jump(key, n):
        at, nxt, i = 0, None, 0
        draw = lambda k: (int(hashlib.md5(f"{key}:{k}".encode()).hexdigest()[:13], 16) + 1.0) / 2 ** 52
        nxt = int(1 / draw(0))
        while nxt < n:
            i += 1
            at, nxt = nxt, int((nxt + 1) / draw(i))
        return at
    got = shard_documents(docs, 5).collect()
    for r in got:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        assert (r["shard"], r["grown_shard"]) == (jump(key, 5), jump(key, 6))
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    texts = dict(rows_of(docs))
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) and r["size"] == len(texts[r["doc_id"]].encode()) + 8 for r in got)
    assert shard_documents(empty).count() == 0


@pytest.mark.parametrize("chunk_bytes", [1 << 25, 200])
def test_decontamination(spark, docs, empty, chunk_bytes):
    tests = [("a", "the CAT sat on"), ("b", " ".join(f"w{i % 97}x{i % 89}" for i in range(40, 60))), (None, "x"), ("c", None), ("c", "mat, today!")]
    bench = spark.createDataFrame(tests, "item_id string, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["hit_words"], r["items"]) for r in find_contamination(docs, bench, chunk_bytes=chunk_bytes).collect())
    want = []
    for i, t in rows_of(docs):
        w, hit, items = words(t), set(), set()
        for name, text in tests:
            q = words(text)
            for k in range(max(len(q) - 10, 0) + 1 if q else 0):
                win = q[k:k + 10]
                for s in range(len(w) - len(win) + 1):
                    if w[s:s + len(win)] == win:
                        hit.update(range(s, s + len(win)))
                        items.add(name or "")
        want.append((i is None, i or 0, len(w), sorted(hit), sorted(items)))
    assert got == sorted(want)
    assert find_contamination(empty, bench).count() == 0
    near = spark.createDataFrame([(1, "alpha zz beta gamma"), (2, "alpha beta")], "doc_id long, text string")
    item = spark.createDataFrame([("q", "alpha beta gamma")], "item_id string, text string")
    assert [r["hit_words"] for r in find_contamination(near, item, proximity=1).orderBy("doc_id").collect()] == [[0, 1, 2, 3], []]


def brute_components(rows, words=5, percent=80):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    ids = [i for i, _ in rows]
    return sorted((i, len(s), min(x for x, q in zip(ids, root) if q == r)) for i, s, r in zip(ids, sets, root) if i is not None)


@pytest.mark.parametrize("small", [False, True])
def test_jaccard(spark, docs, empty, small):
    rng = np.random.RandomState(3)
    base = [f"t{k}" for k in rng.randint(0, 400, 120)]
    extra = []
    for i in range(60):
        t = list(base)
        for k in rng.randint(0, 120, rng.randint(0, 9)):
            t[k] = f"e{rng.randint(0, 9)}"
        extra.append((100 + i, " ".join(t)))
    many = docs.select("doc_id", "text").filter("doc_id IS NOT NULL").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    options = {"block_bytes": 4000, "hot_entries": 10} if small else {}
    got = sorted(tuple(r) for r in jaccard_components(many, **options).select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute_components(rows_of(many))
    assert jaccard_components(docs).count() == docs.count()
    assert jaccard_components(empty).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (100, 102)], "a long, b long")
    assert {r["component"] for r in components(edges).filter("node <= 40").collect()} == {1}
    assert components(edges).filter("component = 100").count() == 3


def test_unigram_level_sums_to_one():
    from lendlens.llm.katz import K, Unigram
    counts = np.random.RandomState(2).zipf(1.6, 4000)
    n = np.bincount(np.minimum(counts, K + 2), minlength=K + 3)[1:K + 2].tolist()
    model = Unigram(n, len(counts), int(counts[counts > K].sum()))
    assert model.tokens == counts.sum() and 0 < model.unknown < 1
    assert abs(model.p(counts).sum() + model.unknown - 1) < 1e-9


def test_katz_counts_and_base(docs, empty):
    got = score_texts(docs).collect()
    assert len(got) == docs.count() and all(r["score"] <= 1e-9 and r["n_known"] <= r["n_tokens"] for r in got)
    train = [t for i, t in rows_of(docs) if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    tokens = [w for t in train for w in re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + ["</end>"]]
    counts = collections.Counter(tokens)
    for r in got:
        if r["doc_id"] is None:
            continue
        text = dict(rows_of(docs))[r["doc_id"]]
        own = re.findall(r"[^\x20\x09-\x0D]+", lower(text)) + ["</end>"]
        base = sum(np.log10((counts[w] + 1) / (len(tokens) + len(counts) + 1)) for w in own)
        assert r["train_tokens"] == len(tokens) and r["n_tokens"] == len(own) and abs(base - r["base_score"]) < 1e-6 * abs(base)
    assert score_texts(empty).count() == 0


def test_language_gradient_and_accuracy(spark, docs, empty):
    network = language_id.Network(["a", "b", "c"])
    rng = np.random.RandomState(0)
    codes, y = rng.randint(97, 120, (9, 5)), rng.randint(0, 3, 5)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    _, g = network.gradients(codes, y)
    for k, at in (("out", (3, 1)), ("uf", (2, 5)), ("ub", (1, 20)), ("xf", (int(codes[3, 2]), 5))):
        old, e = network.p[k][at], 1e-4
        network.p[k][at] = old + e
        up = network.gradients(codes, y)[0]
        network.p[k][at] = old - e
        down = network.gradients(codes, y)[0]
        network.p[k][at] = old
        assert abs((up - down) / (2 * e) - g[k][at]) < 1e-3 * max(1.0, abs(g[k][at]))
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    assert got[0]["lang_pred"] == got[1]["lang_pred"] == got[13]["lang_pred"] == "und" and got[13]["score"] == 0
    assert all(r["lang_pred"] in ("en", "de", "und") for r in got.values())
    assert language_id.identify(empty).count() == 0
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = language_id.identify(table).join(table.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert found.filter("lang = lang_pred").count() >= 0.9 * found.count()


def test_packing(docs, empty):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_file())
    got = pack(docs, tokenizer_file(), capacity=256).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in by.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 256
    want = collections.Counter()
    for i, t in rows_of(docs):
        ids = np.array(tokenizer.encode(t, add_special_tokens=False).ids + [2], "<u4")
        for s in range(0, len(ids), 256):
            part = ids[s:s + 256]
            want[(i, s, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    assert pack(empty, tokenizer_file()).count() == 0


def test_cutting_stock_holds_every_item():
    rng = np.random.RandomState(1)
    lengths = collections.Counter(np.clip(rng.lognormal(4, 1, 3000).astype(int), 1, 1000).tolist())
    sizes, index = cutting_stock.length_classes(lengths)
    demand = [0] * len(sizes)
    for length, n in lengths.items():
        assert sizes[index[length]] >= length
        demand[index[length]] += n
    plan, held = cutting_stock.solve(sizes, demand, 1000), [0] * len(sizes)
    for times, content in plan:
        assert sum(sizes[c] * k for c, k in content.items()) <= 1000
        for c, k in content.items():
            held[c] += times * k
    assert held == demand
    assert sum(t for t, _ in plan) <= 1.02 * sum(k * v for k, v in lengths.items()) / 1000 + 1


def test_line_dedup(docs, empty):
    got = {r["doc_id"]: r for r in dedup_lines(docs).collect()}
    texts = dict(rows_of(docs))
    assert got[0]["text"] is None and got[9]["text"] == texts[9] and got[9]["n_removed_lines"] == 0
    assert 0 < got[10]["n_removed_lines"] < got[10]["n_lines"] and got[10]["text"].startswith("first\nsecond")
    assert all(got[i]["text"] == texts[i] for i in (3, 5, 8, 11, 12))
    assert dedup_lines(docs).count() == docs.count() and dedup_lines(empty).count() == 0


def test_pii(docs, empty):
    got = {r["doc_id"]: r["s"] for r in find_pii(docs).select("doc_id", span_text(F.col("spans")).alias("s")).collect()}
    text = dict(rows_of(docs))
    assert got[8] == f"email:5:11,ip:{text[8].index('1.2.3.4')}:{len(text[8])}" and got[0] == got[3] == got[None] == ""
    assert got[11] == ""          # the phone and card patterns each run over both numbers and fail, without a retry
    assert find_pii(empty).count() == 0


def test_pii_matches_plain_patterns(spark):
    texts = ["a@b.c_d@e.f x.y@z", "1.2.3.4.5.6.7.8 999.1.1.1 0001.02.3.255", "++1 (2) 3.4-5 67890 +12", "4111-1111 1111 1111 and 4111 1111 1111 1112",
             "é" * 5 + "q@w.e-r.t." + "9" * 400, "call tel 020 7946 0958 now", "IBAN GB82 WEST 1234 5698 7654 32 ok", "GB82 WEST 1234 5698 7654 33"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in find_pii(df).select("doc_id", span_text(F.col("base")).alias("b"), span_text(F.col("spans")).alias("s")).collect()}
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def good(kind, m):
        d = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(x) <= 255 for x in m.split("."))
        if kind == "card":
            return 16 <= len(d) <= 19 and sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(d[::-1])) % 10 == 0
        return kind != "phone" or 8 <= len(d) <= 15

    for i, t in enumerate(texts):
        assert got[i]["b"] == ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in plain.items() for m in re.finditer(p, t) if good(k, m[0]))
    assert "local_phone:9:22" in got[5]["s"] and "iban:5:32" in got[6]["s"] and "iban" not in got[7]["s"]


def test_chat_round_trip_and_branches(spark):
    rows = [(1, 2, "assistant", "b\\<|end|> <"), (1, 0, "user", "<|turn|>\\|"), (1, 1, None, None), (2, 5, "assistant", ""), (None, 1, "user", "n"),
            (3, 0, "user", "same"), (3, 0, "user", "same")]
    read = {r["tree_id"]: r for r in read_back(format_trees(linear_nodes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).collect()}
    assert [tuple(t) for t in read[1]["turns"]] == [("user", "<|turn|>\\|"), ("", ""), ("assistant", "b\\<|end|> <")]
    assert read[1]["loss_text"] == "b\\<|end|> <" and read[2]["loss_text"] == "" and len(read[3]["turns"]) == 2 and len(read) == 4
    nodes = [(1, 0, None, "user", "q", 0.0), (1, 1, 0, "assistant", "bad", 0.1), (1, 2, 0, "assistant", "good", 0.9), (1, 3, 2, "user", "more", 0.5), (1, 9, 77, "user", "lost", 0.0)]
    tree = spark.createDataFrame(nodes, "tree_id long, node_id long, parent_id long, role string, text string, score double")
    best = read_back(format_trees(tree)).collect()
    assert [t["text"] for t in best[0]["turns"]] == ["q", "good", "more"]
    assert format_trees(tree, best_only=False).count() == 3
    assert format_trees(linear_nodes(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0
