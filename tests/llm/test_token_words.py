"""The packing stage's ids equal the library's, whatever characters meet; a word is learnt once whatever stands beside it."""

import numpy as np

from lendlens.llm import token_pieces as T
from lendlens.llm.queries import tokenizer_file

CODE = T.Coder(tokenizer_file())


def random_texts(alphabet, n=300, seed=3):
    rng = np.random.RandomState(seed)
    return ["".join(alphabet[k] for k in rng.randint(0, len(alphabet), rng.randint(0, 60))) for _ in range(n)]


def same_ids(texts):
    assert list(T.Coder(tokenizer_file()).ids(texts)) == [CODE.whole(t) for t in texts]


def test_ids_of_every_character_pair_kind():
    same_ids(random_texts(["'", "'", "s", "re", "ve", "ll", "T", "d", "m", "x", "7", ",", '"', " ", "\n", "é", "Ÿ"]))
    same_ids(random_texts([chr(c) for c in range(0x20, 0x7F)] + list("\n\r\t")))
    same_ids(random_texts(list(T._LATIN) + [" ", "a", "'", "."]))


def test_ids_of_empty_whole_and_plain_texts_in_order():
    same_ids(["", " \n", "one", "“two”", "'", "a<|endoftext|>b", "three's", "é", "'s", "", "four\x1cfive", "don't''s"])
    same_ids(["“none plain”"])
    same_ids([])


def test_long_text_in_stretches(monkeypatch):
    monkeypatch.setattr(T, "GROUP_CHARS", 50)
    long = " ".join(f"It's{k} wörter, {k}" for k in range(60))
    assert max(map(len, T.stretches(long))) < 100 and "".join(T.stretches(long)) == long
    same_ids([long, "short", "x" * 300 + " y", long[:49]])


def test_a_word_is_learnt_once_beside_any_punctuation(monkeypatch):
    code, learnt, encoded = T.Coder(tokenizer_file()), [], []
    monkeypatch.setattr(code, "learn", lambda new, f=code.learn: (learnt.extend(new), f(new))[1])
    monkeypatch.setattr(code, "encode_parts", lambda new, f=code.encode_parts: (encoded.extend(new), f(new))[1])
    words = [f"wort{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    texts = [" ".join(a + w + b for w in words) for a, b in [("", ""), ("", ","), ("", "."), ("(", ")"), ('"', '"'), ("", "***")]]
    for t in texts:
        assert list(code.ids([t])) == [CODE.whole(t)]
    assert len(learnt) == len(set(learnt)) == len(encoded) == len(words) + 6
