"""Helpers that the text operators share: tables, scratch space, words and Arrow batches."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z to a-z; every other byte stays.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(spark))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; without one, a temporary folder on a single machine and an error elsewhere."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="spark-")


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared checkpoint folder and goes on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def attach(rows: DataFrame, facts: DataFrame, key: str, small_mb: int = 16, salts: int = 16) -> DataFrame:
    """rows with the columns of facts, which has one row per key; null keys meet each other.

    facts is a table that was cut. It is broadcast where its keys have been measured to be few and short; else every row of it is
    sent for each of some salts, so that a key with very many rows is met in several tasks.
    """
    n, size = facts.agg(F.count("*"), F.sum(F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0)) + 64)).first()
    if not n or size <= small_mb << 20:
        facts, also = F.broadcast(facts), []
    else:
        rows = rows.withColumn("salt", F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in rows.columns)), F.lit(salts)).cast("int"))
        facts, also = facts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), ["salt"]
    a, b = rows.alias("a"), facts.alias("b")
    met = F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}"))
    for s in also:
        met &= F.col(f"a.{s}") == F.col(f"b.{s}")
    return a.join(b, met).select(*(f"a.`{c}`" for c in rows.columns if c != "salt"), *(f"b.`{c}`" for c in facts.columns if c not in (key, "salt")))


def text_rows(df: DataFrame, *more: Column | str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id, the text's bytes and what is named besides."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"), *more)


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, which goes through an operator untouched and can't clash with its columns."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")


_HELD: dict[str, Any] = {}


def worker_cache(key: str, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task. It serves many operators in turn, so only the last one's is kept."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def tidy(forget: bool = False) -> None:
    """Gives freed memory back to the system, which allocators else keep for the worker's next tasks."""
    if forget:
        _HELD.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def row_type(df: DataFrame) -> str:
    return f"row {df.schema.simpleString()}"


def chunks(batches: Iterable[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a few rows; the bytes of column 1 are at most max_bytes together, unless a single row has more."""
    for batch in batches:
        n, at = batch.num_rows, 0
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0), np.int64))
        while at < n:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to


def _stretches(starts: np.ndarray, size: int) -> tuple[list[int], list[int]]:
    """First and end index of runs of words that begin within the same `size` bytes."""
    cuts = np.unique(np.searchsorted(starts, np.arange(0, starts[-1] + 1, size))).tolist()
    return cuts, [*cuts[1:], len(starts)]


class Words:
    """The words of some texts in one buffer: one space between words, a line break between texts.

    Words are runs of anything but ASCII white space. Texts without a word are left out of the buffer and have
    size 0. Word hashes depend on the bytes alone, so they are the same in every process.
    """

    def __init__(self, texts: Iterable[bytes | None], lower: bool = False, split: bool = True) -> None:
        if split:
            texts = [b" ".join(((t or b"").translate(LOWER) if lower else (t or b"")).split()) for t in texts]
        else:
            texts = list(texts)
        self.sizes = np.asarray([t.count(b" ") + 1 if t else 0 for t in texts], np.int64)
        self.buffer = b"\n".join(t for t in texts if t)
        raw = np.frombuffer(self.buffer, np.uint8)
        gaps = np.flatnonzero((raw == 32) | (raw == 10))
        self.starts = np.concatenate([[0], gaps + 1]) if len(raw) else np.zeros(0, np.int64)
        self.ends = np.concatenate([gaps, [len(raw)]]) if len(raw) else np.zeros(0, np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        #: the text of each word
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.pos = np.arange(len(self.starts)) - self.first[self.owner] if len(self.starts) else np.zeros(0, np.int64)

    def hashes(self) -> np.ndarray:
        """For each word the sum of its bytes, each times a number that depends on its place in the word."""
        raw = np.frombuffer(self.buffer, np.uint8)
        if not len(raw):
            return np.zeros(0, np.uint64)
        sizes = (self.ends - self.starts).astype(np.int32)
        factors = mixed(np.arange(1, int(sizes.max()) + 2, dtype=np.uint64)) | np.uint64(1)
        factors[-1] = 0  # of the gap behind the longest word
        out = sizes.astype(np.uint64)
        # Some words at a time, since each byte takes 8 here.
        for i, j in zip(*_stretches(self.starts, 1 << 20), strict=True):
            begin, end = self.starts[i], self.ends[j - 1]
            place = np.arange(end - begin, dtype=np.int32)
            place -= np.repeat((self.starts[i:j] - begin).astype(np.int32), np.append(sizes[i : j - 1] + 1, sizes[j - 1]))
            v = factors[place]
            v *= raw[begin:end].astype(np.uint64) + np.uint64(1)
            v[(self.ends[i : j - 1] - begin)] = 0
            out[i:j] += np.add.reduceat(v, self.starts[i:j] - begin)
        return mixed(out)

    def span(self, begin: int, end: int) -> bytes:
        """The words begin to end - 1 (of one text), joined by one space."""
        return self.buffer[self.starts[begin] : self.ends[end - 1]]


def rolled(h: np.ndarray, n: int) -> np.ndarray:
    """A hash for every n consecutive numbers, by doubling; entry i covers i to i+n-1 (the last n-1 entries are void)."""
    out, size, have, at = None, 1, h, 0
    while True:
        if n & size:
            if out is None:
                out = have.copy()
            else:
                shifted = np.zeros_like(have)
                shifted[: len(have) - at] = have[at:]
                out = out * np.uint64(0x9E3779B97F4A7C15) + mixed(shifted)
            at += size
        size *= 2
        if size > n:
            return mixed(out)
        nxt = np.zeros_like(have)
        nxt[: -(size // 2) or None] = have[size // 2 :] if len(have) > size // 2 else 0
        have = mixed(have) * np.uint64(0xC2B2AE3D27D4EB4F) + nxt


class WordIds:
    """Numbers words in the order of their first appearance; hashes are the same in every process."""

    def __init__(self) -> None:
        self.ids: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        ids = self.ids
        for w in set(words).difference(ids):
            ids[w] = len(ids)
        return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))

    def hashes(self) -> np.ndarray:
        digest = xxhash.xxh3_64_intdigest
        return np.fromiter(map(digest, self.ids), np.uint64, len(self.ids))


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser for 64-bit hashes (the constants are those of a public mixing function)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def crc_fold(doc_id: str, mod: int):
    """crc32 of an id written as text, modulo mod; an expression inside the JVM."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod
