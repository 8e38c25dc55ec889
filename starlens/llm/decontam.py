"""Benchmark passages in training text, found with suffix arrays over the training text.

Each shard (a few MB of documents inside one task) gets a suffix array of its words; every suffix of
every benchmark item is looked up in it by binary search, which yields the longest verbatim match
and all its places. Documents never move: only the benchmark travels, in blocks of a fixed size.

Words that no benchmark item has can't be part of a match, so they act as ends of text, and stretches
shorter than the shortest window are left out of the array; that changes no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, row_type, text_rows, whole_row

#: 0-9, a-z and all bytes of characters beyond ASCII stay, A-Z become lower case, the rest are gaps.
_WORDS = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORDS).split()


class Benchmark:
    """The words of some items as one array of word numbers (1 and up) and its suffixes."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int) -> None:
        self.window, self.vocab = window, {}
        self.ids = [i for i, _ in items]
        tokens: list[int] = []
        sizes = np.zeros(len(items), np.int64)
        number = self.vocab.setdefault
        for k, (_, text) in enumerate(items):
            w = words(text)
            sizes[k] = len(w)
            tokens += [number(x, len(self.vocab) + 1) for x in w]
        self.tokens = np.asarray([*tokens, 0], np.int32)
        item = np.repeat(np.arange(len(items)), sizes)
        pos = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        left = sizes[item] - pos
        #: words from here that make a window: `window`, or the whole of an item with fewer
        need = np.where(left >= window, window, np.where(pos == 0, left, 0))
        self.start = np.arange(len(tokens), dtype=np.int32)
        self.item, self.pos, self.left, self.need = (x.astype(np.int32) for x in (item, pos, left, need))
        self.shortest = int(need[need > 0].min()) if len(need) else 0


def suffix_array(x: np.ndarray, depth: int) -> np.ndarray:
    """The order of x's suffixes by their first `depth` numbers (prefix doubling); what lies beyond the end is less than all."""
    rank, done = np.unique(x, return_inverse=True)[1].astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while done < depth and len(x) > 1:
        behind = np.zeros_like(rank)
        behind[:-done or None] = rank[done:] + 1 if done < len(x) else 0
        key = rank * (len(x) + 1) + behind
        order = np.argsort(key, kind="stable")
        s = key[order]
        rank = np.empty_like(rank)
        rank[order] = np.concatenate([[0], np.cumsum(s[1:] != s[:-1])])
        if rank.max() == len(x) - 1:
            break
        done *= 2
    return order


def _bound(column, lo: np.ndarray, hi: np.ndarray, want: np.ndarray, right: bool) -> np.ndarray:
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) >> 1
        v = column(np.where(open_, mid, 0))
        go = open_ & ((v <= want) if right else (v < want))
        lo, hi = np.where(go, mid + 1, lo), np.where(open_ & ~go, mid, hi)


class Shard:
    """A suffix array over the words of some documents."""

    def __init__(self, texts: list[bytes | None], bench: Benchmark) -> None:
        get = bench.vocab.get
        ids, self.counts = [], []
        for t in texts:
            w = words(t)
            ids.append(np.fromiter(map(get, w, repeat(0)), np.int64, len(w)))
            self.counts.append(len(w))
        #: words of all documents, one 0 after each
        flat = np.zeros(sum(self.counts) + len(ids), np.int64)
        self.first = np.concatenate([[0], np.cumsum(np.asarray(self.counts, np.int64) + 1)])[:-1] if ids else np.zeros(0, np.int64)
        for at, x in zip(self.first, ids, strict=True):
            flat[at : at + len(x)] = x
        self.size = len(flat)
        edge = np.diff(np.concatenate([[0], (flat > 0).view(np.int8), [0]]))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long_ = end - begin >= max(bench.shortest, 1)
        begin, end = begin[long_], end[long_]
        lens = end - begin + 1  # with the word that ends the stretch
        total = int(lens.sum())
        offs = np.concatenate([[0], np.cumsum(lens)])[:-1] if len(lens) else np.zeros(0, np.int64)
        self.at = np.repeat(begin - offs, lens) + np.arange(total)
        self.x = flat[np.minimum(self.at, self.size - 1)] if total else np.zeros(0, np.int64)
        if total:
            self.x[offs + lens - 1] = 0
        self.order = suffix_array(self.x, int(bench.left.max()) if len(bench.left) else 1) if total else np.zeros(0, np.int64)

    def lookup(self, bench: Benchmark) -> dict[str, np.ndarray]:
        """For each suffix of the benchmark: its longest match in words, where that lies in the suffix array, and where its window lies."""
        n, m = len(self.order), len(bench.start)
        out = {k: np.zeros(m, np.int64) for k in ("length", "lo", "hi", "wlo", "whi")}
        if not n or not m:
            return out
        # Most suffixes begin with two words that the shard has nowhere side by side: they match one word at most, which is a window for an item of one alone.
        size = np.int64(len(bench.vocab) + 1)
        pair = bench.tokens[bench.start].astype(np.int64) * size + bench.tokens[bench.start + 1]
        there = np.zeros(int(size), bool)
        there[self.x] = True
        live = np.flatnonzero(there[bench.tokens[bench.start]])
        twos = np.unique(self.x[:-1].astype(np.int64) * size + self.x[1:])
        at = np.minimum(np.searchsorted(twos, pair[live]), max(len(twos) - 1, 0))
        live = live[(bench.need[live] == 1) | ((twos[at] == pair[live]) if len(twos) else False)]
        lo, hi = np.zeros(m, np.int64), np.full(m, n, np.int64)
        d = 0
        while len(live):
            live = live[bench.left[live] > d]
            want = bench.tokens[bench.start[live] + d]
            column = lambda i: self.x[np.minimum(self.order[i] + d, n - 1)] * (self.order[i] + d < n)  # noqa: B023, E731
            a, b = lo[live], hi[live]
            a, b = _bound(column, a, b, want, False), _bound(column, a, b, want, True)
            found = a < b
            live, a, b, d = live[found], a[found], b[found], d + 1
            lo[live], hi[live] = a, b
            out["length"][live], out["lo"][live], out["hi"][live] = d, a, b
            full = live[bench.need[live] == d]
            out["wlo"][full], out["whi"][full] = lo[full], hi[full]
        return out

    def places(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the range and word position for everything in the ranges."""
        size = hi - lo
        which = np.repeat(np.arange(len(lo)), size)
        i = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
        return which, self.at[self.order[i]]

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, at, side="right") - 1


def _spans(hit: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _benchmarks(blocks: list):
    """One block after the other, made in the driver once; a worker holds a single block, whatever their number."""
    held: dict[int, Benchmark] = {}
    while True:
        for k, block in enumerate(blocks):
            if k not in held:
                held.clear()
                held[k] = block.value
                vars(block).pop("_value", None)
            yield held[k]


def _scan(blocks: list, window: int):
    kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        benchmarks = _benchmarks(blocks)
        for part in chunks(batches):
            texts, hits, items = part.column(1).to_pylist(), None, [set() for _ in range(part.num_rows)]
            longest = np.zeros(part.num_rows, np.int64)
            for bench in islice(benchmarks, len(blocks)):
                shard = Shard(texts, bench)
                got = shard.lookup(bench)
                hits = np.zeros(shard.size + window, bool) if hits is None else hits
                k = np.flatnonzero(got["whi"] > got["wlo"])
                ranges = np.unique(np.stack([got["wlo"][k], got["whi"][k], bench.need[k]], 1), axis=0)
                which, at = shard.places(ranges[:, 0], ranges[:, 1])
                for j in range(window):
                    hits[at[ranges[which, 2] > j] + j] = True
                which, at = shard.places(got["wlo"][k], got["whi"][k])
                pairs = np.unique(np.stack([shard.doc_of(at), bench.item[k][which]], 1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
                for doc, item in pairs.tolist():
                    items[doc].add(bench.ids[item])
                which, at = shard.places(got["lo"][k], got["hi"][k])
                np.maximum.at(longest, shard.doc_of(at), got["length"][k][which])
            counts = [len(words(t)) for t in texts] if hits is None else shard.counts
            first = np.cumsum(np.asarray(counts, np.int64) + 1) - np.asarray(counts, np.int64) - 1
            spans = [_spans(hits[a : a + n]) if x else [] for a, n, x in zip(first.tolist(), counts, items, strict=True)]
            ordered = [sorted(x, key=lambda i: (i is not None, i or 0)) for x in items]
            yield pa.RecordBatch.from_arrays(
                [part.column(2), pa.array(counts, pa.int64()), pa.array([[{"first": a, "end": b} for a, b in s] for s in spans], kind), pa.array(ordered, pa.list_(pa.int64())), pa.array(longest)],
                ["row", "n_words", "spans", "items", "longest"],
            )

    return run


def _longest(blocks: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["item_id", "item_pos", "doc_id", "doc_pos", "length"]
        benchmarks = _benchmarks(blocks)
        for part in chunks(batches):
            for bench in islice(benchmarks, len(blocks)):
                shard = Shard(part.column(1).to_pylist(), bench)
                got = shard.lookup(bench)
                k = np.flatnonzero((got["length"] >= bench.need) & (bench.need > 0))
                which, at = shard.places(got["lo"][k], got["hi"][k])
                doc = shard.doc_of(at)
                ids = [bench.ids[i] for i in bench.item[k][which].tolist()]
                cols = [ids, bench.pos[k][which], None, at - shard.first[doc], got["length"][k][which]]
                arrays = [pa.array(c, pa.int64()) if c is not None else part.column(0).take(pa.array(doc)) for c in cols]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def _blocks(benchmark: DataFrame, max_bytes: int, window: int) -> list:
    """The benchmark's rows, read once, as broadcasts of suffixes of about max_bytes of text each."""
    out, block, size = [], [], 0
    send = benchmark.sparkSession.sparkContext.broadcast
    for r in text_rows(benchmark, id_col="item_id").toLocalIterator():
        block.append((r[0], bytes(r[1] or b"")))
        size += len(block[-1][1]) + 16
        if size >= max_bytes:
            out.append(send(Benchmark(block, window)))
            block, size = [], 0
    return [*out, send(Benchmark(block, window))] if block or not out else out


def find(docs: DataFrame, benchmark: DataFrame, window: int = 10, carry: list[str] | None = None, block_bytes: int = 16 << 20) -> DataFrame:
    """Each input row as a struct `row` with n_words, spans (word ranges inside occurring windows), items (ids, sorted) and longest.

    A window is `window` consecutive item words; an item of fewer, but not none, is one window. longest is the number of words of the
    longest verbatim match that holds a window. Null and empty texts have no words and match nothing, nor does an empty
    benchmark. Items with equal texts are all reported. Items without an id hit like any other and are one null, first in `items`.
    Rows that repeat are each reported; an empty table gives no rows; further columns are carried in `row`. The benchmark is read once,
    and so are the documents; a task goes through the benchmark block by block.
    """
    kept = docs.select(*(F.col(f"`{c}`") for c in carry or docs.columns))
    types = f"{row_type(kept)}, n_words long, spans array<struct<first:bigint,end:bigint>>, items array<bigint>, longest long"
    return text_rows(docs, whole_row(kept)).mapInArrow(_scan(_blocks(benchmark, block_bytes, window), window), types)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 16 << 20) -> DataFrame:
    """item_id, item_pos, doc_id, doc_pos, length: for each item suffix the longest verbatim matches in each shard, of a window or more."""
    return text_rows(docs).mapInArrow(_longest(_blocks(benchmark, block_bytes, window)), "item_id long, item_pos long, doc_id long, doc_pos long, length long")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows that no window of the benchmark occurs in, with their own columns."""
    return find(docs, benchmark, window).filter(F.size("items") == 0).select("row.*")
