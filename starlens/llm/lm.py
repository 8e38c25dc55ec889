"""Log-bilinear language model, trained with noise-contrastive estimation.

Word counts come from all training texts. The commonest words are units of their own, thousands of them once the corpus
is large enough; every other word belongs to the unit of its ending. The model predicts the next unit from the two words
before it: the sum of a vector for the nearer and one for the farther word, times the vector of the predicted unit,
plus its bias. It is trained by noise-contrastive estimation on every word of all training texts, in parts of about half a million words, whose
parameters are averaged after each round. Texts are dealt to parts by hash, so that the result doesn't depend on how many tasks there are. The score is bilinear, so the normalising sums of all contexts are
one matrix product: the exponentials of the nearer words' scores times those of the farther words'. Within the unit of an ending,
words have their share of its count, less what unseen words get (the share of words seen once). The probabilities of all
known words and of one unseen word per ending add up to 1.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, Words, chunks, cut, text_rows, tidy

#: most units of single words (a word needs LEAST occurrences), of those the ones told apart as the farther word; endings
HEAD, FAR, LEAST, ENDINGS = 3840, 512, 20, 128
#: length of vectors; noise words of a batch; words of a batch; words that passes over the corpus add up to at least
DIM, NOISE, BATCH, LONG = 24, 64, 2048, 300_000
#: words of a part that is trained on by itself between two averages, and of a piece that texts are dealt to parts in
PART, PIECE = 1 << 19, 1 << 14
_c = F.col


def _ending(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % ENDINGS


#: the ending of each pair of last bytes (of one byte: itself after a zero)
_TABLE = np.asarray([_ending(bytes(x for x in (k >> 8, k & 255) if x)) for k in range(1 << 16)], np.int64)


def _ending_sql(word):
    return (F.crc32(F.expr(f"substring({word}, -2, 2)")) % ENDINGS).cast("int")


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[bytes] = Counter()

    def out():
        batch = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
        seen.clear()
        return batch

    for part in chunks(batches):
        for text in part.column(1).to_pylist():
            seen.update((text or b"").translate(LOWER).split())
            if len(seen) > 400_000:
                yield out()
    yield out()


def counts(train: DataFrame) -> DataFrame:
    """word (bytes), n: over all texts, A-Z lower-cased."""
    return text_rows(train).mapInArrow(_word_counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Known:
    """What a task must know of the counts: the commonest words (a fixed number) and the totals."""

    words: np.ndarray  # hashes, sorted
    n: np.ndarray
    unit: np.ndarray
    head: int  # how many words are units of their own
    far: np.ndarray  # the unit of each unit as the farther word
    total: int
    distinct: int
    of_unit: np.ndarray  # count of all words of a unit
    unseen: np.ndarray  # share of a unit that unseen words get

    @property
    def end(self) -> int:
        return self.head + ENDINGS

    @property
    def noise(self) -> np.ndarray:
        n = self.of_unit + 0.5
        return n / n.sum()

    def units(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """The unit of each word, and its count where it is among the commonest (else 0)."""
        h = w.hashes()
        at = np.minimum(np.searchsorted(self.words, h), max(len(self.words) - 1, 0))
        hit = self.words[at] == h if len(self.words) else np.zeros(len(h), bool)
        raw = np.frombuffer(w.buffer, np.uint8).astype(np.int64)
        last, size = w.ends - 1, w.ends - w.starts
        unit = self.head + _TABLE[np.where(size > 1, raw[np.maximum(last - 1, 0)], 0) << 8 | raw[last]] if len(raw) else np.zeros(0, np.int64)
        unit[hit] = self.unit[at[hit]]
        return unit, np.where(hit, self.n[at] if len(self.n) else 0, 0)

    def sequence(self, w: Words, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The units of all words and ends, and the text of each."""
        size = w.sizes + 1
        out = np.full(int(size.sum()), self.end, np.int64)
        out[np.arange(len(unit)) + w.owner] = unit
        return out, np.repeat(np.arange(len(size)), size)

    def contexts(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The unit before each unit, and that before it as the farther word; end + 1 before a text begins."""
        one, two = np.full_like(flat, self.end), np.full_like(flat, self.end)
        one[1:], two[2:] = flat[:-1], flat[:-2]
        two[one == self.end] = self.end
        return one + (one == self.end), self.far[two + (two == self.end)]


def known_words(table: DataFrame, n_docs: int, most: int = 200_000) -> Known:
    """Collects at most `most` of the commonest words: all above a count, and of those with the next lower count a part drawn by hash."""
    sizes = table.groupBy("n").agg(F.count("*").alias("words"))
    upto = sizes.select("n", "words", F.sum("words").over(Window.orderBy(_c("n").desc())).alias("upto"))
    rest = upto.filter(_c("upto") > most).orderBy(_c("n").desc()).limit(1).collect()
    floor, share = (rest[0].n, 0.9 * (most - rest[0].upto + rest[0].words) / rest[0].words) if rest else (0, 0.0)
    some = (_c("n") == floor) & (F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20)))
    got = [(bytes(r.word), r.n) for r in table.filter((_c("n") > floor) | some).collect()]
    got.sort(key=lambda r: (-r[1], r[0]))
    head = min(HEAD, sum(n >= LEAST for _, n in got))
    ending = np.asarray([_ending(w) for w, _ in got], np.int64)
    n = np.asarray([x for _, x in got], np.int64)
    stats = table.groupBy(_ending_sql("word").alias("ending")).agg(F.sum("n").alias("n"), F.sum((_c("n") == 1).cast("long")).alias("once")).collect()
    of_unit, unseen = np.zeros(head + ENDINGS + 1), np.zeros(head + ENDINGS + 1)
    of_unit[:head], of_unit[-1], unseen[head:-1] = n[:head], n_docs, 1.0
    mine = np.bincount(ending[:head], n[:head], ENDINGS)
    for r in stats:
        if (rest := r.n - int(mine[r.ending])) > 0:
            of_unit[head + r.ending], unseen[head + r.ending] = rest, min(0.9, (r.once + 1) / (rest + 2))
    few = min(FAR, head)
    far = np.concatenate([np.where(np.arange(head) < few, np.arange(head), few + ending[:head]), few + np.arange(ENDINGS), [few + ENDINGS] * 2]).astype(np.int64)
    h = Words([x for x, _ in got], split=False).hashes()
    order = np.argsort(h)
    unit = np.where(np.arange(len(got)) < head, np.arange(len(got)), head + ending)
    row = table.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    return Known(h[order], n[order], unit[order], head, far, row.n + n_docs, row.v + (n_docs > 0), of_unit, unseen)


def _encode(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Known = held.value
        copies: Counter[int] = Counter()
        for part in chunks(batches):
            w = Words(part.column(1).to_pylist(), lower=True)
            flat, owner = known.sequence(w, known.units(w)[0])
            flat, ends = flat.astype("<u2"), np.cumsum(np.bincount(owner, minlength=part.num_rows))
            out = []
            for key, i, j in zip(part.column(2).to_pylist(), (ends - (w.sizes + 1)).tolist(), ends.tolist(), strict=True):
                out += [(key, at - i, copies[key], flat[at : min(at + PIECE, j)].tobytes()) for at in range(i, j, PIECE)]
                copies[key] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["key", "piece", "copy", "units"])
        tidy()

    return run


def _gathered(table: pa.Table) -> pa.Table:
    """One row for a part: its pieces in the order of their keys."""
    rows = sorted(zip(table.column("key").to_pylist(), table.column("piece").to_pylist(), table.column("units").to_pylist(), strict=True))
    units = b"".join(r[2] for r in rows)
    return pa.table([table.column("part")[:1], pa.array([len(units) // 2], pa.int64()), pa.array([units], pa.binary())], names=["part", "n", "units"])


def dealt(train: DataFrame, known_held) -> tuple[DataFrame, int]:
    """part, n, units: all training texts as parts of about PART words, and their number.

    A piece goes to the part that the hash of its text, id and place names, and of how many equal rows its task saw before, so that rows copied many times
    are spread. Up to 32 parts are a task each, more share one by fours.
    """
    doc = F.coalesce(_c("doc_id").cast("string"), F.lit(""))
    key = F.xxhash64(F.coalesce(_c("text").cast("string"), F.lit("")), doc).alias("key")
    parts = 1 + known_held.value.total // PART
    rows = text_rows(train, key).mapInArrow(_encode(known_held), "key long, piece long, copy long, units binary")
    rows = rows.select("key", "piece", "units", F.pmod(F.xxhash64("key", "piece", "copy"), F.lit(parts)).cast("int").alias("part"))
    return cut(rows.repartition(parts if parts <= 32 else -(-parts // 4), "part").groupBy("part").applyInArrow(_gathered, "part int, n long, units binary")), parts


class Net:
    """Vectors of the nearer word, the farther word and the predicted unit, and a bias per unit."""

    NAMES = ("near", "far", "target", "bias")

    def __init__(self, known: Known) -> None:
        rng, size = np.random.default_rng(7), known.end + 1
        self.noise = known.noise
        self.near, self.far, self.target = (rng.normal(0, 0.2, (n, DIM)).astype(np.float32) for n in (size + 1, int(known.far.max()) + 1, size))
        self.bias = np.log(self.noise).astype(np.float32)

    def dump(self) -> bytes:
        return b"".join(getattr(self, k).astype("<f4").tobytes() for k in self.NAMES)

    def load(self, raw: bytes) -> Net:
        at = 0
        for k in self.NAMES:
            x = getattr(self, k)
            setattr(self, k, np.frombuffer(raw, "<f4", x.size, at).reshape(x.shape).copy())
            at += 4 * x.size
        return self

    def trainer(self, rate: float, seed: int):
        """Trains on units and their contexts; each batch shares its noise words (steps by Adagrad)."""
        rng = np.random.default_rng(seed)
        past = {k: np.ones(getattr(self, k).shape, np.float32) for k in self.NAMES}
        log_noise = np.log(self.noise * NOISE).astype(np.float32)
        cumulative = np.cumsum(self.noise)

        def move(name: str, rows: np.ndarray, x: np.ndarray) -> None:
            order = np.argsort(rows, kind="stable")
            begin = np.flatnonzero(np.diff(rows[order], prepend=-1))
            at, step = rows[order[begin]], np.add.reduceat(x[order], begin, axis=0)
            past[name][at] += step * step
            getattr(self, name)[at] += rate * step / np.sqrt(past[name][at])

        def train(word: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
            for at in np.array_split(rng.permutation(len(word)), -(-len(word) // BATCH)):
                w, i, j = word[at], one[at], two[at]
                drawn = np.minimum(np.searchsorted(cumulative, rng.random(NOISE)), len(cumulative) - 1)
                p, t, q = self.near[i] + self.far[j], self.target[w], self.target[drawn]
                right = 1 / (1 + np.exp(np.clip(np.einsum("bd,bd->b", p, t) + self.bias[w] - log_noise[w], -30, 30)))
                wrong = -1 / (1 + np.exp(np.clip(log_noise[drawn] - self.bias[drawn] - p @ q.T, -30, 30)))
                back = right[:, None] * t + wrong @ q
                rows = np.concatenate([w, drawn])
                move("near", i, back)
                move("far", j, back)
                move("target", rows, np.concatenate([right[:, None] * p, wrong.T @ p]))
                move("bias", rows, np.concatenate([right, wrong.sum(0)]))

        return train

    def log_sums(self) -> np.ndarray:
        """The logarithm of the sum over all units, for every nearer and every farther word: one matrix product."""
        far = self.far @ self.target.T + self.bias
        top = far.max(1)
        far = np.exp(far - top[:, None]).T
        out = np.empty((len(self.near), len(self.far)), np.float32)
        for k in range(0, len(out), 512):
            near = self.near[k : k + 512] @ self.target.T
            most = near.max(1, keepdims=True)
            out[k : k + 512] = np.log(np.exp(near - most) @ far) + most + top
        return out

    def log10(self, word: np.ndarray, one: np.ndarray, two: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """log10 P(unit | nearer, farther word)."""
        out = np.empty(len(word), np.float32)
        for k in range(0, len(word), 1 << 16):
            w, i, j = (x[k : k + (1 << 16)] for x in (word, one, two))
            out[k : k + (1 << 16)] = np.einsum("bd,bd->b", self.near[i] + self.far[j], self.target[w]) + self.bias[w] - sums[i, j]
        return out / np.float32(np.log(10))


def _train(known_held, net_held, k: int, rounds: int, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Known = known_held.value
        mean, total = 0.0, 0
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                n = len(raw) // 2
                begin, end = n * (k % rounds) // rounds, n * (k % rounds + 1) // rounds
                if end > begin:
                    before = min(2, begin)  # words that only give a context
                    flat = np.frombuffer(raw, "<u2", end - begin + before, 2 * (begin - before)).astype(np.int64)
                    one, two = (x[before:] for x in known.contexts(flat))
                    net = Net(known).load(net_held.value)
                    net.trainer(rate, 1009 * k + part)(flat[before:], one, two)
                    mean = mean + (end - begin) * np.frombuffer(net.dump(), "<f4").astype(np.float64)
                    total += end - begin
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([float(total)]), pa.array([(mean / total).astype("<f4").tobytes()], pa.binary())], ["weight", "net"])

    return run


def _mean(table: pa.Table) -> pa.Table:
    rows = sorted(zip(table.column("weight").to_pylist(), table.column("net").to_pylist(), strict=True))
    total = sum(w for w, _ in rows)
    mean = sum(np.frombuffer(x, "<f4").astype(np.float64) * (w / total) for w, x in rows)
    return pa.table([table.column("part")[:1], pa.array([total]), pa.array([mean.astype("<f4").tobytes()], pa.binary())], names=["part", "weight", "net"])


def train_net(parts: DataFrame, n_parts: int, known_held, fan: int = 8) -> Net:
    """Rounds of training, each on the next slice of every part, from the mean of all parts' parameters (about 1 MB) after the round before.

    Parts hold a fixed number of words, and a pass has more rounds the more parts there are, so that they don't drift apart. The mean is taken of `fan` tasks at a time,
    in as many levels as it needs, so that one set alone comes to the driver. Small corpora are passed several times, until LONG words are reached or 8 passes.
    """
    sc = parts.sparkSession.sparkContext
    net = Net(known_held.value)
    words = parts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rounds = 3 + n_parts.bit_length()
    for k in range(rounds * min(8, max(1, LONG // max(words, 1))) if words else 0):
        sent = sc.broadcast(net.dump())
        made = parts.mapInArrow(_train(known_held, sent, k, rounds, 0.02), "weight double, net binary").select(F.spark_partition_id().cast("long").alias("part"), "weight", "net")
        n = parts.rdd.getNumPartitions()
        while n > 1:
            n = -(-n // fan)
            made = made.withColumn("part", _c("part") % n).groupBy("part").applyInArrow(_mean, "part long, weight double, net binary")
        for r in made.collect():
            net.load(bytes(r.net))
        sent.destroy()
    return net


def _score(known_held, net_held, sums_held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Known = known_held.value
        net, sums = Net(known).load(net_held.value), sums_held.value
        within = np.log10(np.maximum(1 - known.unseen, 1e-300) / np.maximum(known.of_unit, 1))
        for part in chunks(batches):
            ids, texts, keys = (c.to_pylist() for c in part.columns[:3])
            w = Words(texts, lower=True)
            unit, n = known.units(w)
            flat, owner = known.sequence(w, unit)
            docs = len(ids)
            neural = np.bincount(owner, net.log10(flat, *known.contexts(flat), sums), docs)
            common = n > 0
            add = lambda v: np.bincount(w.owner[common], v[common], docs)  # noqa: B023, E731
            base, inner = add(np.log10(n + 1.0)), add(np.where(unit >= known.head, np.log10(np.maximum(n, 1)) + within[unit], 0.0))
            n_known = np.bincount(w.owner[common], minlength=docs)
            yield _rows(ids, keys, [b"\x20" + repr((i, k)).encode() for i, k in zip(ids, keys, strict=True)], np.ones(docs), np.zeros(docs), w.sizes + 1, n_known, base, neural + inner)
            rare = np.flatnonzero(~common)
            tally = Counter(zip(w.owner[rare].tolist(), [w.buffer[a:b] for a, b in zip(w.starts[rare].tolist(), w.ends[rare].tolist(), strict=True)], strict=True))
            if tally:
                o, words = zip(*tally, strict=True)
                z = np.zeros(len(o))
                yield _rows([ids[i] for i in o], [keys[i] for i in o], list(words), z, np.fromiter(tally.values(), np.int64), z, z, z, z)

    return run


_PARTS = "doc_id long, key long, word binary, is_doc long, times long, n_tokens long, n_known long, base double, score double"


def _rows(ids, keys, words, is_doc, times, tokens, known, base, score) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
    cols = [x.astype(np.int64) if isinstance(x, np.ndarray) and t == pa.int64() else x for x, t in zip((ids, keys, words, is_doc, times, tokens, known, base, score), types, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types, strict=True)], [x.split()[0] for x in _PARTS.split(", ")])


def train_and_score(docs: DataFrame, train: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score (log10) for every row of docs.

    A null or empty text is one token, its end. Without training texts every token has probability 1/(0+0+1) in
    base_score, and score comes from untrained parameters. An empty `docs` gives no rows. Repeated rows are each scored alike; a null doc_id is a value
    like any other; extra columns are ignored; texts are read whole, whatever their length. Rare words (all but a fixed
    number of the commonest) meet their counts in a join, so nothing that grows with the corpus is broadcast.
    """
    sc = docs.sparkSession.sparkContext
    n_docs = train.count()
    table = cut(counts(train))
    known = known_words(table, n_docs)
    held = sc.broadcast(known)
    net = train_net(*dealt(train, held), held)
    key = F.xxhash64(F.coalesce(_c("text").cast("string"), F.lit(""))).alias("key")
    parts = text_rows(docs, key).mapInArrow(_score(held, sc.broadcast(net.dump()), sc.broadcast(net.log_sums())), _PARTS)
    kind = _ending_sql("word")
    at = lambda x: F.get(F.lit(np.log10(np.maximum(x[known.head : known.end], 1e-300))), kind)
    c = F.coalesce("n", F.lit(0))
    seen = _c("times") * F.when(c > 0, F.log10(c) + at((1 - known.unseen) / np.maximum(known.of_unit, 1))).otherwise(at(known.unseen))
    met = parts.join(table, "word", "left").select(
        "doc_id", "key", "is_doc", (_c("n_tokens")).alias("t"), (_c("n_known") + F.when(c > 0, _c("times")).otherwise(0)).alias("k"),
        (_c("base") + _c("times") * F.log10(c + 1.0)).alias("b"), (_c("score") + F.when(_c("times") > 0, seen).otherwise(0.0)).alias("s"),
    )
    sums = met.groupBy("doc_id", "key").agg(*(F.sum(x).alias(x) for x in ("is_doc", "t", "k", "b", "s")))
    space, end = np.log10(known.total + known.distinct + 1.0), np.log10(n_docs + 1.0)
    each = sums.select("doc_id", *((_c(x) / _c("is_doc")).alias(x) for x in "tkbs"), F.explode(F.sequence(F.lit(1), _c("is_doc"))))
    return each.select(
        "doc_id", _c("t").cast("long").alias("n_tokens"), (_c("k") + int(n_docs > 0)).cast("long").alias("n_known"), F.lit(known.total).cast("long").alias("train_tokens"),
        (_c("b") + F.lit(float(end)) - _c("t") * F.lit(float(space))).alias("base_score"), _c("s").alias("score"),
    )
