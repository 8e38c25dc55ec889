"""Codes of vectors: integer components, one codebook for each of a few parts, nearest entries found by a tree of distance ranges (GNAT).

Codebooks are small (at most 256 entries a part) and live in the driver; vectors never leave their tasks. A round sends each task's
sums by part and entry, and the driver gets one row for each entry.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_row

_c = F.col
#: Components are floor(SCALE * x).
SCALE = 1024
#: Squared distances of larger components may not fit 64 bits: |x| below 2 ** 18, and 2 ** 12 values in a part.
LARGEST = 1 << 18
#: Relative error that bounds of distances allow for; that of one rounding is 2 ** -53.
SLACK = 2.0**-50


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between rows of integers, exact: by a product of float64 matrices where every term is below 2 ** 53, else in int64."""
    peak = max((int(np.abs(x).max(initial=0)) for x in (a, b)), default=0)
    if 4 * a.shape[1] * peak * peak < 1 << 53:
        x, y = a.astype(np.float64), b.astype(np.float64)
        return ((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T)).astype(np.int64)
    out = np.zeros((len(a), len(b)), np.int64)
    for k in range(a.shape[1]):
        out += (a[:, k, None].astype(np.int64) - b[:, k]) ** 2
    return out


class Gnat:
    """Nearest of some integer points for many queries at once; of equally near ones, that with the lowest index.

    A node has split points; every other point of it belongs to the child of its nearest split point. For each split point and child it
    keeps the least and greatest distance between that point and the child's points. A query at distance d of a split point whose best
    distance so far is r can't find a nearer or equal point in a child whose range lies wholly outside [d - r, d + r]. Ranges and
    distances are widened by SLACK before they are compared and a child goes only where the comparison is strict, so rounding costs
    time and never a result; which point wins is decided by integers alone.
    """

    def __init__(self, points: np.ndarray, arity: int = 8, leaf: int = 32) -> None:
        # Of equal points only the first can win.
        _, first = np.unique(points, axis=0, return_index=True)
        self.points, self.arity, self.leaf = points, arity, leaf
        self.root = self._node(np.sort(first))

    def _node(self, ids: np.ndarray) -> tuple:
        """Split points, ranges and children; a small node has all its points as split points and no children."""
        if len(ids) <= self.leaf:
            return ids, None, None, []
        chosen, near = [0], squared(self.points[ids], self.points[ids[:1]])[:, 0]
        while len(chosen) < self.arity:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, squared(self.points[ids], self.points[ids[chosen[-1:]]])[:, 0])
        splits = ids[np.sort(chosen)]
        rest = np.setdiff1d(ids, splits)
        d2 = squared(self.points[rest], self.points[splits])
        owner, d = d2.argmin(1), np.sqrt(d2.astype(np.float64))
        members = [np.flatnonzero(owner == j) for j in range(len(splits))]
        full = [j for j, m in enumerate(members) if len(m)]
        lo = np.stack([d[members[j]].min(0) for j in full], 1) * (1 - SLACK)
        hi = np.stack([d[members[j]].max(0) for j in full], 1) * (1 + SLACK)
        return splits, lo, hi, [(j, self._node(rest[members[j]])) for j in full]

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Index and squared distance of the nearest point of each query, and how many distances were computed."""
        best, at = np.full(len(queries), np.iinfo(np.int64).max), np.zeros(len(queries), np.int64)
        looked = 0

        def visit(node: tuple, rows: np.ndarray) -> None:
            nonlocal looked
            splits, lo, hi, children = node
            d2 = squared(queries[rows], self.points[splits])
            looked += d2.size
            k = d2.argmin(1)
            d, i = d2[np.arange(len(rows)), k], splits[k]
            won = (d < best[rows]) | ((d == best[rows]) & (i < at[rows]))
            best[rows[won]], at[rows[won]] = d[won], i[won]
            if not children:
                return
            dist = np.sqrt(d2.astype(np.float64))
            below, above = dist * (1 - SLACK), dist * (1 + SLACK)
            gap = np.full((len(rows), len(children)), -np.inf)
            for s in range(len(splits)):
                np.maximum(gap, below[:, s, None] - hi[s], out=gap)
                np.maximum(gap, lo[s] - above[:, s, None], out=gap)
            gap *= 1 - SLACK
            home = [k == j for j, _ in children]
            for first in (True, False):  # the child of the nearest split point makes r small for the others
                for c, (_, child) in enumerate(children):
                    open_ = home[c] if first else ~home[c] & ~(gap[:, c] > np.sqrt(best[rows].astype(np.float64)) * (1 + SLACK))
                    if open_.any():
                        visit(child, rows[open_])

        if len(queries):
            visit(self.root, np.arange(len(queries)))
        return at, best, looked


@dataclass
class Codebooks:
    """entries[part] is an array of integers, one row for each entry; length is that of the longest vector."""

    entries: list[np.ndarray]
    length: int

    @property
    def width(self) -> int:
        return self.entries[0].shape[1]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for part in self.entries for x in part.ravel().tolist()).encode()).hexdigest()


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector is neither null nor has a component that is null, NaN or infinite."""
    return vectors.filter(F.forall(f"`{vector}`", lambda x: F.abs(x) < F.lit(math.inf)))  # NaN is above infinity; of a null component comes null


def integers(column: pa.Array, width: int, parts: int) -> np.ndarray:
    """floor(SCALE * x) by row, part and place; shorter vectors are filled up with zeros at their end."""
    values, sizes = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), parts * width), np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.floor(values * SCALE)
    return out.reshape(len(column), parts, width)


def _blocks(batches: Iterable[pa.RecordBatch], width: int, parts: int, rows: int = 16384) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    rows = max(1, min(rows, (8 << 20) // (parts * width)))
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            some = batch.slice(k, rows)
            yield some, integers(some.column(0), width, parts)


def train(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", parts: int = 4, entries: int = 256, rounds: int = 4) -> Codebooks | None:
    """Codebooks from all usable vectors, or None where there is none.

    They start as the parts of the vectors with the smallest ids (null ids last; of equal ids, the smaller vectors first), at most 256 of them.
    In every round each part of each vector is given to its nearest entry, and an entry becomes the floor of the mean of its parts; entries
    without parts stay. Equal entries are kept, and the first of them gets all parts. All vectors count as long as the longest, or up to
    three longer, so that parts are equal; what is missing is zero. A component of 2 ** 18 or more, or a vector of more than 16,384, is an error.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    rows = usable(vectors, vector).select(_c(f"`{vector}`").alias("vector"), _c(f"`{vec_id}`").alias("vec_id"))
    high = F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector")))
    size, peak = rows.agg(F.max(F.size("vector")), F.max(high)).first()
    if size is None:
        return None
    if (peak or 0) >= LARGEST or size > parts << 12:
        raise ValueError(f"components must be below {LARGEST} and parts have at most 4096 of them")
    width = max(1, -(-size // parts))
    seeds = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()
    start = integers(pa.array([r.vector for r in seeds], pa.list_(pa.float64())), width, parts)
    books = Codebooks([start[:, p].copy() for p in range(parts)], size)
    for _ in range(rounds):
        books = _refined(rows.select("vector"), books)
    return books


def _refined(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: the codebooks with every entry replaced by the floor of the mean of its parts."""
    parts, width = len(books.entries), books.width
    trees = [Gnat(e) for e in books.entries]

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((len(t.points), width), np.int64) for t in trees]
        count = [np.zeros(len(t.points), np.int64) for t in trees]
        for _, x in _blocks(batches, width, parts):
            for p, tree in enumerate(trees):
                at = tree.nearest(x[:, p])[0]
                order = np.argsort(at, kind="stable")
                ids, first = np.unique(at[order], return_index=True)
                total[p][ids] += np.add.reduceat(x[order, p], first)
                count[p] += np.bincount(at, minlength=len(count[p]))
        for p in range(parts):
            ids = np.flatnonzero(count[p])
            if len(ids):
                cols = [np.full(len(ids), p, np.int32), ids.astype(np.int32), count[p][ids]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(list(total[p][ids]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    found = rows.mapInArrow(sums, "part int, entry int, n long, sums array<long>").groupBy("part", "entry")
    means = found.agg(F.sum("n").alias("n"), F.array(*(F.sum(F.get("sums", F.lit(k))) for k in range(width))).alias("sums"))
    new = [e.copy() for e in books.entries]
    for r in means.collect():  # one row for each entry at most
        new[r.part][r.entry] = [s // r.n for s in r.sums]
    return Codebooks(new, books.length)


def encode(vectors: DataFrame, books: Codebooks | None, vector: str = "embedding") -> DataFrame:
    """Every usable row as a struct `row`, with its code (two hex digits a part) and error (sum of the parts' squared distances to their entries).

    Vectors that are null, or have a null, NaN or infinite component, give no row; an empty vector is one of zeros. Repeated rows fare alike.
    Vectors must not be longer than those the codebooks were made from.
    """
    rows = usable(vectors, vector).select(_c(f"`{vector}`").alias("vector"), whole_row(vectors))
    schema = f"row {vectors.select(whole_row(vectors)).schema['row'].dataType.simpleString()}, code string, error long"
    if books is None:
        return vectors.sparkSession.createDataFrame([], schema)
    parts, width = len(books.entries), books.width
    trees = [Gnat(e) for e in books.entries]
    digits = [f"{k:02x}" for k in range(256)]

    def codes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, x in _blocks(batches, width, parts):
            found = [tree.nearest(x[:, p]) for p, tree in enumerate(trees)]
            text = ["".join(map(digits.__getitem__, c)) for c in zip(*(at.tolist() for at, _, _ in found), strict=True)]
            yield pa.RecordBatch.from_arrays([some.column(1), pa.array(text, pa.string()), pa.array(sum(d for _, d, _ in found))], ["row", "code", "error"])

    return rows.mapInArrow(codes, schema)


def decode(codes: DataFrame, books: Codebooks, code: str = "code") -> DataFrame:
    """codes with a column `decoded`: the entries' components in part order, divided by SCALE, as long as the longest vector; null for a null code."""
    tables = [F.array(*(F.array(*map(F.lit, e.tolist())) for e in part)) for part in books.entries]
    at = lambda p: F.conv(F.substring(f"`{code}`", 2 * p + 1, 2), 16, 10).cast("int")
    whole = F.slice(F.concat(*(F.get(t, at(p)) for p, t in enumerate(tables))), 1, books.length)
    return codes.withColumn("decoded", F.transform(whole, lambda x: x / F.lit(float(SCALE))))
