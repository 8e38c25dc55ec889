"""Toxicity by the nearest labelled examples.

Examples and texts are TF-IDF vectors over words, and beginnings and ends of words. Every term of two or more examples
counts; a term weighs more, the better it tells the two labels apart. The nearest examples by exact cosine come from an inverted
index with a maximum for each term and block of examples: blocks that can't reach the k-th best are skipped.
Distance-weighted votes of the neighbours are calibrated on the examples themselves, each left out of its own vote;
the neighbours are the evidence.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, text_rows
from .decontam import words

BLOCK = 64
#: a term with this chi-square between the labels has half the weight of one that tells them apart for certain
HALF = 30.0
#: a term of more than one in DENSE examples has a matrix for each block; room for 32-bit rounding; texts weighed together
DENSE, MARGIN, BATCH = 20, 1e-4, 128


def terms(word: bytes) -> list[bytes]:
    out = [word]
    if len(word) > 4:
        out += [b"^" + word[:4], b"$" + word[-4:]]
    return out


def _ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Everything in the ranges, and the number of the range it is from."""
    size = end - begin
    which = np.repeat(np.arange(len(begin)), size)
    return np.arange(len(which)) + np.repeat(begin - (np.cumsum(size) - size), size), which


class Index:
    """Labelled examples (id, toxic, words joined by spaces, how often each is there) as an inverted index with block maxima."""

    def __init__(self, examples: list[tuple[int, int, bytes, np.ndarray]], weight: dict[int, float], k: int = 15) -> None:
        label = np.asarray([e[1] for e in examples], np.int64)
        ids: dict[bytes, int] = {}
        docs = []
        for _, _, raw, times in examples:
            of = [[ids.setdefault(t, len(ids)) for t in terms(w)] for w in raw.split()]
            ts, at = np.unique(np.fromiter(chain.from_iterable(of), np.int64), return_inverse=True)
            docs.append((ts, np.bincount(at, np.repeat(times, [len(x) for x in of]), len(ts))))
        df = np.bincount(np.concatenate([np.zeros(0, np.int64), *(ts for ts, _ in docs)]), minlength=len(ids))
        self.vocab = {t: i for i, t in enumerate(sorted(t for t, i in ids.items() if df[i] > 1))}
        number = np.full(len(ids), -1)
        for t, i in self.vocab.items():
            number[ids[t]] = i
        del ids
        for i, (ts, times) in enumerate(docs):
            known = number[ts] >= 0
            order = np.argsort(number[ts[known]])
            docs[i] = number[ts[known]][order], times[known][order]
        self.idf = self._weights(docs, label)
        vectors = [self.vector(*d) for d in docs]
        # Examples with one label and one strongest term lie side by side, so that few blocks are near a text.
        lead = [int(ts[ws.argmax()]) if len(ts) else -1 for ts, ws in vectors]
        order = sorted(range(len(docs)), key=lambda i: (label[i], lead[i], examples[i][0]))
        docs = [docs[i] for i in order]
        #: terms of each example and how often they are there: all that travels
        self.first = np.cumsum([0, *(len(ts) for ts, _ in docs)])
        self.term = np.concatenate([np.zeros(0), *(ts for ts, _ in docs)]).astype(np.int32)
        self.times = np.concatenate([np.zeros(0), *(times for _, times in docs)]).astype(np.int32)
        self.ids = np.asarray([examples[i][0] for i in order], np.int64)
        self.toxic = label[order]
        self.weight = np.asarray([weight[int(y)] for y in self.toxic])
        self.k = k
        self.blocks = -(-len(docs) // BLOCK)
        self.calibrate(np.full(len(order), -1.0))
        self._build()

    def __getstate__(self) -> dict:
        return {k: getattr(self, k) for k in ("vocab", "idf", "first", "term", "times", "ids", "toxic", "weight", "k", "blocks", "prior", "none", "mids", "rates")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._build()

    def _build(self) -> None:
        first, term = self.first, self.term.astype(np.int64)
        pairs = zip(first.tolist(), first[1:].tolist(), strict=False)
        value = np.concatenate([np.zeros(0), *(self.vector(term[a:b], self.times[a:b])[1] for a, b in pairs)])
        self.forward = (first, term, value)
        at = np.repeat(np.arange(len(self.ids)), np.diff(first))
        #: terms that one in DENSE examples has: their part of each block is a matrix, with the largest of each row
        n = np.bincount(term, minlength=len(self.vocab))
        self.column = np.where(n * DENSE > len(self.ids), np.cumsum(n * DENSE > len(self.ids)) - 1, -1)
        common, width = self.column[term] >= 0, int(self.column.max(initial=-1)) + 1
        self.dense = np.zeros((self.blocks, width, BLOCK), np.float32)
        self.dense[at[common] // BLOCK, self.column[term[common]], at[common] % BLOCK] = value[common]
        self.dense_most = self.dense.max(2, initial=0).T.copy()
        #: postings of the other terms in the order of terms, and within a term of examples
        term, at, value = term[~common], at[~common], value[~common]
        by = np.lexsort((at, term))
        self.at, self.value, term = at[by].astype(np.int32), value[by].astype(np.float32), term[by]
        #: where each term's part of each block begins
        part = term * max(self.blocks, 1) + self.at // BLOCK
        self.cell = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
        self.most = np.maximum.reduceat(self.value, self.cell) if len(part) else np.zeros(0, np.float32)
        self.block_of = part[self.cell] % max(self.blocks, 1)
        self.cell_end = np.append(self.cell[1:], len(part))
        self.cells = np.searchsorted(term[self.cell], np.arange(len(self.vocab) + 1))
        #: the terms of words met so far
        self.of: dict[bytes, tuple[int, ...]] = {}

    def _weights(self, docs: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray) -> np.ndarray:
        """Inverse document frequency, times chi-square / (chi-square + HALF) for the two labels (1 if there is but one)."""
        has = np.zeros((2, len(self.vocab)))
        for (ts, _), y in zip(docs, label.tolist(), strict=True):
            has[int(y == 1), ts] += 1
        n = np.asarray([(label != 1).sum(), (label == 1).sum()], float)
        idf = np.log(1 + len(docs) / np.maximum(has.sum(0), 1))
        if not n.all():
            return idf
        mean = has.sum(0) / n.sum()
        chi = (has[1] / n[1] - has[0] / n[0]) ** 2 / np.maximum(mean * (1 - mean), 1e-12) * n[0] * n[1] / n.sum()
        return idf * (chi + 1e-3) / (chi + HALF)

    def vector(self, ts: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(times)) * self.idf[ts]
        return ts, w / (np.linalg.norm(w) or 1.0)

    def text(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """The vector of a whole text."""
        tokens, of, vocab = words(text), self.of, self.vocab
        for w in set(tokens).difference(of):
            of[w] = tuple(vocab[t] for t in terms(w) if t in vocab)
        out = self.vector(*np.unique(np.fromiter(chain.from_iterable(map(of.__getitem__, tokens)), np.int64), return_counts=True))
        if len(of) > 500_000:
            of.clear()
        return out

    def nearest(self, docs: list[tuple[np.ndarray, np.ndarray]], without: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each vector the numbers and cosines of the k nearest examples with a positive cosine; the smaller number first in a tie.

        Blocks are weighed with 32-bit numbers and a margin; the cosines themselves are exact.
        """
        n, blocks, wide = len(docs), self.blocks, self.blocks * BLOCK
        if not n or not blocks:
            return [(np.zeros(0, np.int64), np.zeros(0))] * n
        owner = np.repeat(np.arange(n), [len(ts) for ts, _ in docs])
        ts, ws = np.concatenate([ts for ts, _ in docs]), np.concatenate([ws for _, ws in docs]).astype(np.float32)
        common = self.column[ts] >= 0
        x = np.zeros((n, self.dense.shape[1]), np.float32)
        x[owner[common], self.column[ts[common]]] = ws[common]
        cell, which = _ranges(self.cells[ts[~common]], self.cells[ts[~common] + 1])
        owner, w = owner[~common][which], ws[~common][which]
        block = self.block_of[cell]
        bound = x @ self.dense_most + np.bincount(owner * blocks + block, w * self.most[cell], n * blocks).reshape(n, blocks)
        cos = np.zeros((n, wide), np.float32)

        def weigh(use: np.ndarray) -> None:
            for k in np.flatnonzero(use.any(0)).tolist():
                rows = np.flatnonzero(use[:, k])
                cos[rows, k * BLOCK : (k + 1) * BLOCK] = x[rows] @ self.dense[k]
            some = use[owner, block]
            at, which = _ranges(self.cell[cell[some]], self.cell_end[cell[some]])
            cos[...] += np.bincount(owner[some][which] * wide + self.at[at], self.value[at] * w[some][which], n * wide).reshape(n, wide)
            if without is not None:
                cos[np.arange(n), without] = 0

        kth = lambda: np.partition(cos, -self.k, axis=1)[:, -self.k] if wide > self.k else np.zeros(n)
        few = min(max(2, blocks // 16), blocks)
        use = np.zeros((n, blocks), bool)
        np.put_along_axis(use, np.argpartition(-bound, few - 1, axis=1)[:, :few], True, 1)
        weigh(use)
        weigh(~use & (bound > 0) & (bound >= (kth() - MARGIN)[:, None]))
        near = (cos > 0) & (cos >= (kth() - MARGIN)[:, None])
        return [self._exact(np.flatnonzero(near[i]), *docs[i]) for i in range(n)]

    def _exact(self, at: np.ndarray, ts: np.ndarray, ws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, term, value = self.forward
        i, which = _ranges(first[at], first[at + 1])
        mine = np.zeros(len(self.vocab))
        mine[ts] = ws
        cos = np.bincount(which, value[i] * mine[term[i]], len(at))
        order = np.lexsort((at, -np.round(cos, 12)))[: self.k]
        order = order[cos[order] > 0]
        return at[order], cos[order]

    def example(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        first, term, value = self.forward
        return term[first[i] : first[i + 1]], value[first[i] : first[i + 1]]

    def vote(self, at: np.ndarray, cos: np.ndarray) -> float:
        """Negative where there is no neighbour."""
        w = cos**2 * self.weight[at]
        return float((w * self.toxic[at]).sum() / (w.sum() + 1e-9)) * float(cos.max(initial=0.0)) ** 0.25 if len(at) else -1.0

    def calibrate(self, raw: np.ndarray) -> None:
        """raw: each example's vote, without itself."""
        total = float(self.weight.sum()) or 1.0
        self.prior = float((self.weight * self.toxic).sum()) / total
        none = raw < 0
        self.none = float((self.weight * self.toxic)[none].sum() + self.prior) / (float(self.weight[none].sum()) + 1)
        edges, rates = np.linspace(0, 1, 11), []
        for a, b in zip(edges, edges[1:], strict=False):
            own = (raw >= a) & ((raw < b) | (b == 1)) & ~none
            rates.append([float((self.weight * self.toxic)[own].sum() + self.prior), float(self.weight[own].sum()) + 1])
        pools: list[list[float]] = []  # monotone: neighbouring bins that fall are pooled
        for x, n in rates:
            pools.append([x, n, 1])
            while len(pools) > 1 and pools[-2][0] / pools[-2][1] > pools[-1][0] / pools[-1][1]:
                x2, n2, m2 = pools.pop()
                pools[-1] = [pools[-1][0] + x2, pools[-1][1] + n2, pools[-1][2] + m2]
        self.mids = (edges[1:] + edges[:-1]) / 2
        self.rates = np.asarray([x / n for x, n, m in pools for _ in range(int(m))])

    def score(self, raw: float) -> float:
        return min(1.0, max(0.0, self.none if raw < 0 else float(np.interp(raw, self.mids, self.rates))))


def _drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches):
        found = [Counter(words(t)) for t in part.column(1).to_pylist()]
        cols = [part.column(0), part.column(2), pa.array([b" ".join(c) for c in found], pa.binary()), pa.array([np.asarray(list(c.values()), "<i4").tobytes() for c in found], pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "toxic", "words", "times"])


def examples(docs: DataFrame, labels: DataFrame, toxic: int = 1500, clean: int = 3000) -> tuple[list[tuple[int, int, bytes, np.ndarray]], dict[int, float]]:
    """Labelled rows (id, toxic, different words, how often each is there), and how many labelled rows one example of each label stands for.

    A sample of about so many toxic and clean ids, drawn by a hash of the id (at most twice as many together). An id with clashing labels is toxic. Labels that are null, or
    of ids without a text, are left out; rows with one id and one text count once; texts are read whole.
    """
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    n = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("example")), F.lit(1 << 30)) / float(1 << 30)
    drawn = known.filter(draw < F.when(F.col("toxic") == 1, toxic / max(n.get(1, 1), 1)).otherwise(clean / max(n.get(0, 1), 1)))
    ids = drawn.limit(2 * (toxic + clean))  # far above what the draw gives: a bound for the broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").filter("text is not null").dropDuplicates(["doc_id", "text"])
    got = text_rows(rows, "toxic").mapInArrow(_drawn, "doc_id long, toxic int, words binary, times binary").collect()
    out = sorted((r.doc_id, r.toxic, bytes(r["words"]), bytes(r.times)) for r in got)
    have = Counter(e[1] for e in out)
    return [(*e[:3], np.frombuffer(e[3], "<i4")) for e in out], {y: n.get(y, 0) / max(have[y], 1) for y in (0, 1)}


def _own_votes(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            index: Index = held.value
            at = part.column(0).to_pylist()
            votes = [index.vote(*x) for k in range(0, len(at), BATCH) for x in index.nearest([index.example(i) for i in at[k : k + BATCH]], at[k : k + BATCH])]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(votes, pa.float64())], ["id", "vote"])

    return run


def fit(docs: DataFrame, labels: DataFrame, toxic: int = 1500, clean: int = 3000, k: int = 15) -> Index:
    """An index of the `examples`, calibrated on the votes that each gets from the others."""
    spark = docs.sparkSession
    index = Index(*examples(docs, labels, toxic, clean), k)
    held = spark.sparkContext.broadcast(index)
    votes = spark.range(0, len(index.ids), 1, max(1, len(index.ids) // 256)).mapInArrow(_own_votes(held), "id long, vote double").collect()
    held.destroy()
    index.calibrate(np.asarray([r.vote for r in sorted(votes)], float))
    return index


def _score(held, evidence: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = held.value
        for part in chunks(batches):
            scores, near, texts = [], [], part.column(1).to_pylist()
            for k in range(0, len(texts), BATCH):
                vectors = [index.text(t) for t in texts[k : k + BATCH]]
                for at, cos in index.nearest(vectors):
                    scores.append(index.score(index.vote(at, cos))), near.append(index.ids[at[:evidence]].tolist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64()), pa.array(near, pa.list_(pa.int64()))], ["doc_id", "score", "evidence"])

    return run


def score(docs: DataFrame, index: Index, evidence: int = 3) -> DataFrame:
    """doc_id, score (0 to 1) and evidence (ids of the nearest examples) for every row.

    Null and empty texts, and texts without any term of the examples, have no neighbour and get the share of toxic rows
    among such examples; with no examples (or an empty `labels` or `documents`) that is 0. Repeated rows get equal scores; ties between
    neighbours go to the one that comes first in the index; a null doc_id is scored like any other; extra columns are ignored; texts are read whole,
    whatever their length.
    """
    held = docs.sparkSession.sparkContext.broadcast(index)
    return text_rows(docs).mapInArrow(_score(held, evidence), "doc_id long, score double, evidence array<long>")
