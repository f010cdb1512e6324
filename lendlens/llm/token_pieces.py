"""Token ids of whole texts by a public tokenizer file, cut into pieces no longer than a sequence.

The tokenizer splits at white space, and between letters or digits and other
characters, before anything else.  The texts of a group are cut there into words
as one byte array, and Arrow numbers the distinct ones; only those are looked
up in a bounded cache of each Python worker.  New words are split by the
tokenizer's own pattern, and only unseen parts are encoded by its model.  The
ids of the texts are then gathered by the words' numbers.  An apostrophe is not
cut from its neighbours, because the pattern has endings like 's.

Workers live on beside later stages, so the cache is small: two halves, of
which the older one goes when the newer one is full; words met again stay in the
newer half.  Texts with any character outside plain ASCII and Latin letters
(where normalisation could reach across a word, or differ) and texts holding a
special token are encoded whole by the library.
"""

from __future__ import annotations

import codecs
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm import memory  # noqa: F401 (workers give freed memory back)
from lendlens.llm.common import column

END_ID = 2
CACHE_WORDS = 300_000        # of both halves, about 160 bytes each
CACHE_CHARS = 8_000_000      # of both halves
GROUP_CHARS = 500_000
_LATIN = "".join(chr(c) for c in range(0xC0, 0x180) if chr(c).isalpha() and len(chr(c).lower()) == 1
                 and unicodedata.is_normalized("NFC", chr(c)) and c not in (0x130, 0x149, 0x17F))
_PLAIN = re.compile(f"[\x20-\x7e\n\r\t{_LATIN}]*")
_LOWER = "a-z" + "".join(sorted({c.lower() for c in _LATIN}))
_PARTS = re.compile(f"[{_LOWER}]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\\s{_LOWER}0-9]+")
_SPACE = re.compile("[ \n\r\t]")
_KIND = np.full(256, 2, np.uint8)        # of the bytes of lower-case plain text; no other character has bytes from 128
_KIND[list(b"\0 \n\r\t")] = 0
_KIND[list(b"0123456789abcdefghijklmnopqrstuvwxyz") + list(range(128, 256))] = 1
# the characters that stand for bytes in the vocabulary: printable ones for themselves, the others from 256 on; a space parts words
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _SHOWN]
_BYTE_CHARS = "".join(" " if b == 32 else chr(b) if b in _SHOWN else chr(256 + _HIDDEN.index(b)) for b in range(256))
_CODERS: dict[str, "Coder"] = {}


class Coder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}                               # ids of words and of their parts
        self.older: dict[str, bytes] = {}
        self.chars = 0                                                  # of the words in ``known``

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def unseen(self, words: list[str]) -> set[str]:
        """Those of the distinct ``words``, none of them in the newer half, whose ids are not held; the others move to that half."""
        ids = list(map(self.older.get, words))
        self.known.update([(w, i) for w, i in zip(words, ids) if i is not None])
        self.chars += sum(map(len, words))
        return {w for w, i in zip(words, ids) if i is None}

    def make_room(self) -> None:
        if 2 * len(self.known) > CACHE_WORDS or 2 * self.chars > CACHE_CHARS:
            self.known, self.older, self.chars = {}, self.known, 0

    def encode_parts(self, new: list[str]) -> None:
        encode = self.model.tokenize
        bytewise = codecs.charmap_decode(" ".join(new).encode(), "strict", _BYTE_CHARS)[0].split(" ")
        self.known.update([(part, array("I", [t.id for t in encode(b)]).tobytes()) for part, b in zip(new, bytewise)])

    def learn(self, words: set[str]) -> None:
        """Adds the ids of unseen words; a word of one part is that part."""
        rows = [(w, _PARTS.findall(w)) for w in words if not w.isalpha()]
        rows = [(w, row) for w, row in rows if row[0] != w]
        new = words.difference([w for w, _ in rows])
        parts = set(chain.from_iterable([row for _, row in rows])).difference(new)
        new.update(self.unseen([p for p in parts if p not in self.known]))
        if new:
            self.encode_parts(list(new))
        known = self.known
        known.update([(w, b"".join(map(known.__getitem__, row))) for w, row in rows])

    def plain(self, text: str) -> bool:
        return bool(_PLAIN.fullmatch(text)) and not any(s in text for s in self.special)

    def plain_ids(self, texts: list[str]) -> list[bytes]:
        """Ids of plain texts, whose words are looked up and learnt together."""
        words, of, ends = distinct_words(texts)
        self.make_room()
        found = list(map(self.known.get, words))
        missing = [w for w, ids in zip(words, found) if ids is None]
        new = self.unseen(missing)
        if new:
            self.learn(new)
        filled = map(self.known.__getitem__, missing)
        found = [next(filled) if ids is None else ids for ids in found]
        ids, size = np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4
        first, n = (np.cumsum(size) - size)[of], size[of]
        stop = np.concatenate([[0], np.cumsum(n)])
        ids = ids[np.repeat(first - stop[:-1], n) + np.arange(stop[-1])]
        ends = stop[ends].tolist()
        return [ids[s:e].tobytes() for s, e in zip([0, *ends], ends)]

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        plain = list(map(self.plain, texts))
        short = [p and len(t) <= GROUP_CHARS for t, p in zip(texts, plain)]
        together = iter(self.plain_ids([t for t, s in zip(texts, short) if s]))
        for text, p, s in zip(texts, plain, short):
            if s:
                yield next(together)
            elif p:
                yield b"".join([self.plain_ids([t])[0] for t in stretches(text)])
            else:
                yield self.whole(text)


def distinct_words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words of plain texts, number of each word in order, words up to the end of each text).

    A word ends at white space and between letters or digits and other characters, but not beside an apostrophe.
    """
    data = np.frombuffer("\0".join([*texts, ""]).lower().encode(), np.uint8)
    kind = _KIND[data]
    cut = np.ones(len(data), bool)
    np.not_equal(kind[1:], kind[:-1], out=cut[1:])
    quote = np.flatnonzero(data == ord("'"))                             # every text ends with \0: quote + 1 exists
    cut[quote] &= kind[quote - 1] != 1
    cut[quote + 1] &= kind[quote + 1] != 1
    at = np.flatnonzero(cut)
    size = np.diff(at, append=len(data))
    is_word = kind[at] > 0
    first = at[is_word]
    offsets = np.concatenate([[0], np.cumsum(size[is_word])]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data[kind > 0])).dictionary_encode()
    ends = np.searchsorted(first, np.flatnonzero(data == 0))
    return words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy(), ends


def stretches(text: str) -> Iterator[str]:
    """A long text in stretches of about GROUP_CHARS characters that end with white space."""
    start = 0
    while (space := _SPACE.search(text, start + GROUP_CHARS)):
        yield text[start:space.end()]
        start = space.end()
    yield text[start:]


def coder(path: str) -> Coder:
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def text_groups(batch: pa.RecordBatch) -> Iterator[list[tuple]]:
    """(doc_id, text) rows of a batch in groups of about GROUP_CHARS characters; a longer text is a group of its own."""
    rows, chars = [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        rows.append((doc_id, text.as_py() or ""))
        chars += len(rows[-1][1])
        if chars >= GROUP_CHARS:
            yield rows
            rows, chars = [], 0
    if rows:
        yield rows


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens.  All but a document's last piece are full."""
    def cut(batches):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        code = coder(tokenizer_path)
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            doc, start, length, crc, total = [], [], [], [], []
            for rows in text_groups(batch):
                for doc_id, ids in zip([r[0] for r in rows], code.ids([r[1] for r in rows])):
                    ids += end
                    n = len(ids) // 4
                    for s in range(0, n, capacity):
                        part = ids[4 * s:4 * (s + capacity)]
                        doc.append(doc_id)
                        start.append(s)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        total.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (doc, start, length, crc, total)],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"))
    return rows.mapInArrow(cut, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")
