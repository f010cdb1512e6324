"""Line dedup against a brute force over all pairs of runs: passages of 1 to 20 lines in varied surroundings."""

import collections
import re

import numpy as np

from lendlens.llm.line_dedup import dedup_lines


def brute(rows, words=50):
    """(text, removed lines): a line goes when a run of ``words`` words around it occurs at an earlier place."""
    cut = [t.split("\n") for _, t in rows]
    count = lambda lines: sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in lines)
    places, runs = collections.defaultdict(list), []
    for d, lines in enumerate(cut):
        for lo in range(len(lines)):
            for hi in range(lo, len(lines)):
                body = lines[lo:hi + 1]
                if body[0].strip() and body[-1].strip() and count(body) >= words:
                    places[tuple(body)].append((rows[d][0], lo))
                    runs.append((d, lo, hi))
    gone = [set() for _ in rows]
    for d, lo, hi in runs:
        if min(places[tuple(cut[d][lo:hi + 1])]) != (rows[d][0], lo):
            gone[d].update(range(lo, hi + 1))
    return {rows[d][0]: ("\n".join(x for k, x in enumerate(lines) if k not in gone[d]), len(gone[d])) for d, lines in enumerate(cut)}


def test_passages_in_varied_surroundings(spark):
    rng = np.random.RandomState(5)
    fresh = lambda n: " ".join(f"w{k}" for k in rng.randint(0, 10 ** 9, n))
    shapes = [(1, 60), (2, 30), (3, 20), (5, 12), (6, 10), (8, 8), (20, 10), (2, 10)]
    rows, passages = [], []
    for lines, each in shapes:
        passage = [fresh(each) for _ in range(lines)]
        if lines == 5:
            passage[2:2] = ["", "  "]
        passages.append("\n".join(passage))
        for _ in range(6):
            around = ["\n".join(fresh(rng.randint(1, 30)) for _ in range(rng.randint(0, 4))) for _ in range(2)]
            rows.append((len(rows), "\n".join([around[0], passages[-1], around[1]])))
    rows.append((len(rows), "\n".join(passages[:3] + [passages[1]] + passages[5:6])))      # passages next to each other and twice in one text
    rows.append((len(rows), "\n".join([fresh(30)] * 4)))                                   # a run over its own earlier place
    got = {r["doc_id"]: (r["text"], r["n_removed_lines"]) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)
    for s, (lines, each) in enumerate(shapes):
        for d in range(6 * s + 1, 6 * s + 6):
            assert (passages[s] in got[d][0]) == (lines * each < 50)
