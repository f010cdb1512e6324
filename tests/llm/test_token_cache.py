"""The word cache of the packing stage stays within its bounds and never changes ids."""

import numpy as np

from lendlens.llm import token_pieces as T
from lendlens.llm.queries import tokenizer_file


def texts(n=60):
    rng = np.random.RandomState(6)
    common = [f"word{k}" for k in range(40)] + ["it's", "x1y2", "a-b", "don't!"]
    return [" ".join([common[k] for k in rng.randint(0, len(common), 50)] + [f"only{i}z{j} {'v' * (i + j)}'s" for j in range(20)]) for i in range(n)]


def test_bounded_cache_same_ids(monkeypatch):
    code = T.Coder(tokenizer_file())
    rows = texts()
    whole = [code.whole(t) for t in rows]
    for words, chars in ((200, 1 << 20), (1 << 20, 3000)):
        monkeypatch.setattr(T, "CACHE_WORDS", words)
        monkeypatch.setattr(T, "CACHE_CHARS", chars)
        code = T.Coder(tokenizer_file())
        got, most, held = [], 0, 0
        for t in rows:
            got += code.ids([t])
            most = max(most, len(code.known) + len(code.older))
            held = max(held, sum(map(len, code.known)) + sum(map(len, code.older)))
        assert got == whole
        # each half may be passed by the words and parts of one text
        assert most <= words + 2 * 200 and held <= chars + 2 * 4000


def test_cache_of_a_worker_is_small():
    """Words in the cache at most some tens of MB, whatever the corpus holds: many workers live beside one executor."""
    assert 160 * T.CACHE_WORDS + 4 * T.CACHE_CHARS <= 100 << 20


def test_frequent_words_are_not_learnt_again(monkeypatch):
    monkeypatch.setattr(T, "CACHE_WORDS", 400)
    code, learnt = T.Coder(tokenizer_file()), []
    monkeypatch.setattr(code, "learn", lambda new, f=code.learn: (learnt.extend(new), f(new))[1])
    for t in texts():
        list(code.ids([t]))
    assert len(learnt) > 1000 and learnt.count("word7") == 1
