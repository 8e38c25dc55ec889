"""Token sequences of a fixed length, packed by multiway differencing (Karmarkar and Karp).

A document's ids fill whole sequences as long as they can; what is left, cut into pieces of at most an
eighth of a sequence, is packed in groups. Differencing keeps partial partitions (one load per window) in a heap
by their imbalance and merges the two most imbalanced with opposing loads, until one partition with
near-equal windows remains. When a window would hold more than its capacity, the window count rises.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import chunks, text_rows, tidy, worker_cache

#: Of the id that ends each document.
END = np.asarray([1], "<u4").tobytes()


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """The indexes of sizes, dealt to so many windows with near-equal sums."""
    if windows == 1 or not sizes:
        return [list(range(len(sizes))), *([] for _ in range(windows - 1))]
    heap = []
    for i, size in enumerate(sizes):
        heap.append((-size, i, [size] + [0] * (windows - 1), [[i]] + [[] for _ in range(windows - 1)]))
    heapq.heapify(heap)
    n = len(sizes)
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)
        _, _, b, y = heapq.heappop(heap)
        loads = [p + q for p, q in zip(a, reversed(b), strict=True)]  # largest with smallest
        order = sorted(range(windows), key=loads.__getitem__, reverse=True)
        least = loads[order[-1]]
        y.reverse()
        for p, q in zip(x, y, strict=True):
            p += q
        n += 1
        heapq.heappush(heap, (least - loads[order[0]], n, [loads[i] - least for i in order], [x[i] for i in order]))
    return heap[0][3]


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows of at most capacity; each size is at most capacity."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        parts = difference(sizes, k)
        if max(sum(sizes[i] for i in w) for w in parts) <= capacity:
            return [w for w in parts if w]
        k += 1


class _Seen:
    """A dictionary of bounded size: what isn't asked for during a whole generation is forgotten."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def missing(self, words: set[bytes]) -> list[bytes]:
        """After this, `young` has all words but those returned."""
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        out = []
        for w in words.difference(self.young):
            if (ids := self.old.get(w)) is None:
                out.append(w)
            else:
                self.young[w] = ids
        return out


_TAIL = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordTokens:
    """Ids of words as little-endian bytes.

    The tokenizer never looks across white space, so a word's ids don't depend on its neighbours. It also parts
    letters from what follows them and reads them in lower case, so a word of Latin-1 letters with marks behind it is
    looked up as the letters and the marks, which go straight to the tokenizer's merges, one character for each
    byte; all other words are asked for as they are.
    """

    def __init__(self, path: str, most: int = 500_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words, self.parts = _Seen(most), _Seen(most)
        plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
        beyond = iter(range(256, 512))
        #: byte-level vocabularies write printable bytes as themselves and the others as characters from 256 on
        self.written = {b: b if b in plain else next(beyond) for b in range(256)}

    def _merge(self, parts: list[bytes], into: dict[bytes, bytes]) -> None:
        tokenize, written = self.tokenizer.model.tokenize, self.written
        for p in parts:
            into[p] = np.asarray([t.id for t in tokenize(p.decode("latin-1").translate(written))], "<u4").tobytes() if p else b""

    def _ask(self, words: list[bytes], into: dict[bytes, bytes]) -> None:
        for k in range(0, len(words), 2000):
            part = words[k : k + 2000]
            enc = self.tokenizer.encode([w.decode("utf-8", "replace") for w in part], is_pretokenized=True, add_special_tokens=False)
            ids = np.asarray(enc.ids, "<u4").tobytes()
            ends = np.cumsum(np.bincount(np.asarray(enc.word_ids, np.int64), minlength=len(part))) * 4
            at = 0
            for w, end in zip(part, ends.tolist(), strict=True):
                into[w] = ids[at:end]
                at = end

    def learn(self, words: set[bytes]) -> None:
        split: list[tuple[bytes, bytes, bytes]] = []
        odd = []
        for w in self.words.missing(words):
            core = w.rstrip(_TAIL)
            tail = w[len(core) :]
            if core.isalpha():
                split.append((w, core.lower(), tail))
                continue
            text = core.decode("utf-8", "replace")
            if text.isalpha() and max(text) < "\u0100":
                split.append((w, text.lower().encode(), tail))
            else:
                odd.append(w)
        self._ask(odd, self.words.young)
        self._merge(self.parts.missing({p for s in split for p in s[1:]}), self.parts.young)
        got = self.parts.young
        self.words.young.update((w, got[core] + got[tail]) for w, core, tail in split)

    def encode(self, words: list[bytes]) -> bytes:
        return b"".join(map(self.words.young.__getitem__, words))


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack(path: str, capacity: int, group: int):
    names = [x.split()[0] for x in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_cache(f"packing {path}", lambda: WordTokens(path))
        sequence = TaskContext.get().partitionId() << 33
        small = max(1, capacity // 8)
        target = max(1, group * (capacity - capacity // 100))  # a little room, so that near-equal windows fit
        rest: list[tuple[int, int, int, int, int]] = []
        held, out = 0, []

        def flush():
            nonlocal rest, held, sequence
            for window in windows_of([p[2] for p in rest], capacity) if rest else []:
                offset = 0
                for i in sorted(window):
                    out.append((*rest[i], sequence, offset))
                    offset += rest[i][2]
                sequence += 1
            rest, held = [], 0

        def batch():
            cols = list(zip(*out, strict=True)) or [[]] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)

        for part in chunks(batches):
            texts = [(t or b"").split() for t in part.column(1).to_pylist()]
            tokens.learn(set().union(*texts))
            for doc_id, words in zip(part.column(0).to_pylist(), texts, strict=True):
                ids = tokens.encode(words) + END
                n, at = len(ids) // 4, 0
                while at < n:
                    length = capacity if n - at >= capacity else min(small, n - at, target - held)
                    piece = (doc_id, at, length, zlib.crc32(ids[4 * at : 4 * (at + length)]), n)
                    at += length
                    if length == capacity:
                        out.append((*piece, sequence, 0))
                        sequence += 1
                    else:
                        rest.append(piece)
                        held += length
                        if held >= target:
                            flush()
            yield batch()
        flush()
        yield batch()
        tidy()

    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, group: int = 16) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are one id, the end. Rows that repeat are packed each. A null doc_id is carried. Extra
    columns are ignored. An empty table gives no rows. Very long texts are cut, and need no more memory than their
    ids. Groups never leave a task, so nothing is shuffled; a task's last group may end with one window part full.
    """
    return text_rows(docs).mapInArrow(_pack(tokenizer_path, capacity, group), PIECES)
