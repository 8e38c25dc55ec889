"""Repeated passages across documents, found with super-k-mers.

A window is so many consecutive words. Its minimiser is the first of its words in a fixed order: longer words come
first, words of one length in the order of a hash. Long words are rare, so most buckets stay even. Runs of
windows with the same minimiser travel together as one packed string to the minimiser's bucket, where
the windows are sorted and counted by their words. Equal windows always meet, since they have equal minimisers.
A first pass adds up the bytes of each bucket; the windows of one that would be too large (around a word that many
texts share, say) travel one by one to parts of it, chosen by the hash of the whole window, so that equal ones meet still.

Before anything is shuffled, each task settles what it can alone: a window that a document with a smaller id
in the same few MB also holds is known to be repeated and need not travel. So a passage that a third
of all documents share is sent about once per few MB of input, not once per document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, chunks, rolled, row_type, text_rows, tidy, whole_row

_SPANS = "doc_id long, key long, first long, end long"


def _sliding_min(v: np.ndarray, n: int) -> np.ndarray:
    """The first place of the least value among v[i:i+n], by doubling. Values are compared by their upper 36 bits."""
    best = (v & np.uint64(0xFFFFFFFFF0000000)) | np.arange(len(v), dtype=np.uint64)
    size = 1
    while size < n:
        step = min(size, n - size)
        best[:-step] = np.minimum(best[:-step], best[step:])
        size += step
    return (best & np.uint64(0x0FFFFFFF)).astype(np.int64)


def _later(words: Words, at: np.ndarray, keys: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
    """For each window (n words from `at`, in ascending order) whether a smaller doc has an equal one among them."""
    order = np.argsort(keys)
    sorted_ = keys[order]
    same = np.concatenate([[False], sorted_[1:] == sorted_[:-1], [False]])
    order = np.sort(order[same[1:] | same[:-1]])  # only windows that are there twice
    order = order[np.lexsort((docs[order], keys[order]))]
    new = np.ones(len(order), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    begin = np.flatnonzero(new)
    model = np.arange(len(at))
    model[order] = np.repeat(order[begin], np.diff(np.concatenate([begin, [len(order)]])))
    later = docs > docs[model]
    # Equal hashes are held against the words themselves, stretch by stretch.
    k = np.flatnonzero(model != np.arange(len(at)))
    a, b = _runs(at[k], words.owner[at[k]], at[model[k]] - at[k], words.owner[at[model[k]]])
    here, there = at[k], at[model[k]]
    w = words
    first, last = w.starts[here[a]].tolist(), w.ends[here[b] + n - 1].tolist()
    first_, last_ = w.starts[there[a]].tolist(), w.ends[there[b] + n - 1].tolist()
    if all(w.buffer[p:q] == w.buffer[p_:q_] for p, q, p_, q_ in zip(first, last, first_, last_, strict=True)):
        return later
    least: dict[bytes, int] = {}  # two texts with one hash: by the words alone
    spans = [w.span(i, i + n) for i in at.tolist()]
    for x, d in zip(spans, docs.tolist(), strict=True):
        least[x] = min(d, least.get(x, d))
    return np.asarray([least[x] < d for x, d in zip(spans, docs.tolist(), strict=True)], bool)


def _runs(at: np.ndarray, owner: np.ndarray, *also: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of runs of consecutive places with the same owner (and the same of what else is given)."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = (np.diff(at) != 1) | (np.diff(owner) != 0)
    for x in also:
        new |= x[1:] != x[:-1]
    begin = np.concatenate([[0], np.flatnonzero(new) + 1])
    return begin, np.concatenate([begin[1:] - 1, [len(at) - 1]])


def _packed(docs: np.ndarray, keys: np.ndarray, owner: np.ndarray, pos: np.ndarray, strings: list[bytes]) -> bytes:
    """Strings with their place; each document's id and key once."""
    which, at = np.unique(owner, return_inverse=True)
    head = [np.asarray([len(pos), len(which)], "<i8"), docs[which].astype("<i8"), keys[which].astype("<i8"), at.astype("<i4"), pos.astype("<i4")]
    return zstandard.compress(b"".join(x.tobytes() for x in head) + b"\n".join(strings), 3)


def _unpacked(blob: bytes) -> tuple[np.ndarray, bytes]:
    raw = zstandard.decompress(blob)
    n, m = np.frombuffer(raw, "<i8", 2).tolist()
    docs, keys = np.frombuffer(raw, "<i8", 2 * m, 16).reshape(2, m)
    at, pos = np.frombuffer(raw, "<i4", 2 * n, 16 + 16 * m).reshape(2, n)
    return np.stack([docs[at], keys[at], pos.astype(np.int64)]), raw[16 + 16 * m + 8 * n :]


def _minimisers(words: Words, h: np.ndarray, window: int) -> np.ndarray:
    """For each place the place of the minimiser of the window that begins there."""
    shorter = (255 - np.minimum(words.ends - words.starts, 255)).astype(np.uint64)
    return _sliding_min((shorter << np.uint64(56)) | (h >> np.uint64(8)), window)


def _weigh(window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy(forget=True)
        together, single = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for part in chunks(batches):
            w = Words(t for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) if i is not None)
            at = np.flatnonzero(w.pos <= w.sizes[w.owner] - window)
            if not len(at):
                continue
            h = w.hashes()
            where = _minimisers(w, h, window)[at]
            to = (h[where] % np.uint64(buckets)).astype(np.int64)
            np.add.at(single, to, w.ends[at + window - 1] - w.starts[at])
            a, b = _runs(at, w.owner[at], where)
            np.add.at(together, to[a], w.ends[at[b] + window - 1] - w.starts[at[a]])
            del w, at, h, where, to, a, b
            tidy()
        k = np.flatnonzero(single)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (k, together[k], single[k])], ["bucket", "together", "single"])

    return run


def _send(window: int, buckets: int, parts: dict[int, int]):
    names = ["bucket", "settled", "blob"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy(forget=True)
        parts_of = np.ones(buckets, np.int64)
        parts_of[list(parts)] = list(parts.values())
        for part in chunks(batches):
            ids, texts, keys = (c.to_pylist() for c in part.columns[:3])
            use = [k for k, i in enumerate(ids) if i is not None]
            w = Words(texts[k] for k in use)
            del texts
            doc_ids, keys = (np.asarray([x[k] for k in use], np.int64) for x in (ids, keys))
            at = np.flatnonzero(w.pos <= w.sizes[w.owner] - window)
            if not len(at):
                continue
            h = w.hashes()
            whole = rolled(h, window)[at]
            later = _later(w, at, whole, doc_ids[w.owner[at]], window)
            tidy()
            out = []
            gone = at[later]
            a, b = _runs(gone, w.owner[gone])
            if len(a):
                o = w.owner[gone[a]]
                spans = np.stack([doc_ids[o], keys[o], w.pos[gone[a]], w.pos[gone[b]] + window]).astype("<i8")
                out.append((zlib.crc32(spans.tobytes()) % buckets, True, spans.tobytes()))
            where = _minimisers(w, h, window)
            rest, whole = at[~later], whole[~later]
            to = (h[where[rest]] % np.uint64(buckets)).astype(np.int64)
            alone = parts_of[to] > 1
            one = rest[alone]
            to_one = to[alone] + buckets * (whole[alone] % parts_of[to[alone]].astype(np.uint64)).astype(np.int64)
            rest, to = rest[~alone], to[~alone]
            a, b = _runs(rest, w.owner[rest], where[rest])
            a, b, to = np.concatenate([rest[a], one]), np.concatenate([rest[b], one]) + window - 1, np.concatenate([to[a], to_one])
            order = np.argsort(to, kind="stable")
            a, b, to = a[order], b[order], to[order]
            strings = [w.buffer[i:j] for i, j in zip(w.starts[a].tolist(), w.ends[b].tolist(), strict=True)]
            cuts = [0, *(np.flatnonzero(np.diff(to)) + 1).tolist(), len(to)]
            o = w.owner[a]
            for i, j in zip(cuts, cuts[1:], strict=False):
                if j > i:
                    out.append((int(to[i]), False, _packed(doc_ids, keys, o[i:j], w.pos[a[i:j]], strings[i:j])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.bool_(), pa.binary()), strict=True)], names)
            del w, h, whole, where, strings, out
            tidy()

    return run


def _count(window: int):
    def run(table: pa.Table) -> pa.Table:
        settled, blobs = table.column("settled").to_pylist(), table.column("blob").to_pylist()
        found = [np.frombuffer(x, "<i8").reshape(4, -1) for x, s in zip(blobs, settled, strict=True) if s]
        parts = [_unpacked(x) for x, s in zip(blobs, settled, strict=True) if not s]
        del blobs
        if parts:
            docs, keys, pos = np.concatenate([p[0] for p in parts], 1)
            w = Words([x for p in parts for x in p[1].split(b"\n")], split=False)
            del parts
            at = np.flatnonzero(w.pos <= w.sizes[w.owner] - window)
            gone = at[_later(w, at, rolled(w.hashes(), window)[at], docs[w.owner[at]], window)]
            a, b = _runs(gone, w.owner[gone])
            if len(a):
                o = w.owner[gone[a]]
                found.append(np.stack([docs[o], keys[o], pos[o] + w.pos[gone[a]], pos[o] + w.pos[gone[b]] + window]))
            del w, at, gone, a, b
        tidy()
        all_ = np.concatenate(found, 1) if found else np.zeros((4, 0), np.int64)
        return pa.table([pa.array(x, pa.int64()) for x in all_], names=["doc_id", "key", "first", "end"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches):
        n_words, n_removed, kept = [], [], []
        for text, spans in zip(part.column(1).to_pylist(), part.column(3).to_pylist(), strict=True):
            words, gone, left, at = (text or b"").split(), 0, [], 0
            for s in sorted(spans or (), key=lambda s: s["first"]):
                if s["end"] > at:
                    begin = max(at, s["first"])
                    left += words[at:begin]
                    gone += s["end"] - begin
                    at = s["end"]
            n_words.append(len(words)), n_removed.append(gone), kept.append(b" ".join(left + words[at:] if gone else words))
        yield pa.RecordBatch.from_arrays([part.column(2), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())], ["row", "n_words", "n_removed", "kept"])
    tidy()


def send(docs: DataFrame, window: int, bucket_bytes: int, most: int = 8) -> DataFrame:
    """bucket, settled, blob: windows on their way to their buckets. A bucket of more than `most` times bucket_bytes is divided by the hash of its windows."""
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("key")
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = 1 + total // bucket_bytes
    parts: dict[int, int] = {}
    if total * window > most * bucket_bytes:  # else none can be larger
        sizes = text_rows(docs).mapInArrow(_weigh(window, buckets), "bucket long, together long, single long").groupBy("bucket").agg(F.sum("together").alias("together"), F.sum("single").alias("single"))
        parts = {r.bucket: 1 + r.single // (most * bucket_bytes // 2) for r in sizes.filter(F.col("together") > most * bucket_bytes).collect()}
    return text_rows(docs, key).mapInArrow(_send(window, buckets, parts), "bucket long, settled boolean, blob binary")


def repeated_spans(docs: DataFrame, window: int = 13, bucket_bytes: int = 5 << 19) -> DataFrame:
    """doc_id, key (hash of the text), first, end: word ranges covered by windows that a smaller doc_id also holds. Ranges may overlap."""
    return send(docs, window, bucket_bytes).groupBy("bucket").applyInArrow(_count(window), _SPANS)


def remove_repeats(docs: DataFrame, window: int = 13, carry: list[str] | None = None) -> DataFrame:
    """Each input row as a struct `row` with n_words, n_removed and kept (the words left, joined by one space).

    Windows are judged on the input as it is. Null and empty texts and those shorter than a window lose nothing.
    Rows with equal doc_id are one document as far as order goes: none removes from the other; of rows that repeat, ranges are gathered once. A row with a null
    doc_id neither loses words nor takes any from others. Ties can't arise otherwise: the smallest doc_id keeps a window. Extra
    columns are carried in `row`; an empty table gives no rows. Texts of any length are read whole.
    """
    kept = docs.select(*(F.col(f"`{c}`") for c in carry or docs.columns))
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("key")
    spans = repeated_spans(docs, window).groupBy("doc_id", "key").agg(F.collect_set(F.struct("first", "end")).alias("spans"))
    rows = text_rows(docs, whole_row(kept), key).join(spans, ["doc_id", "key"], "left")
    return rows.select("doc_id", "text", "row", "spans").mapInArrow(_cut, f"{row_type(kept)}, n_words long, n_removed long, kept binary")


def rewrite(docs: DataFrame, window: int = 13) -> DataFrame:
    """The documents with repeated words taken out of text (and n_chars, where there is such a column, counted anew).

    A text that loses nothing stays as it is, white space included; one that loses all its words becomes empty.
    """
    cut_ = remove_repeats(docs, window)
    text = F.when(F.col("n_removed") > 0, F.col("kept").cast("string")).otherwise(F.col("row.text"))
    out = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.char_length(text)).otherwise(F.col("row.n_chars") if "n_chars" in docs.columns else None)}
    return cut_.select(*((out[c].cast(docs.schema[c].dataType) if c in out else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
