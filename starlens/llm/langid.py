"""Language by the nearest centroid of TF-IDF weighted n-grams.

Texts become counts of hashed byte n-grams (1 to 4 bytes of the lower-cased text, everything that is no letter
read as one kind of gap), damped, weighted by inverse document frequency and normalised. Each language is described by several
centroids, found by spherical k-means. A text gets the language of the centroid with the highest cosine; a text
further from it than nearly all training texts of that centroid is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, cut, text_rows

FEATURES = 4096
_GAP = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
_BEYOND = bytes(range(128))
_FACTOR = np.uint32(0x9E3779B1)


def has_letter(text: bytes) -> bool:
    plain = text.translate(_GAP, b"")
    if len(plain.strip(b" ")) and plain.translate(None, bytes(range(128, 256))).strip():
        return True
    return any(map(str.isalpha, text.translate(None, _BEYOND).decode("utf-8", "replace")))


def counts(text: bytes) -> np.ndarray:
    """How often each hashed n-gram is there, over the whole text."""
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    a = np.frombuffer(b" ".join([b"", *text.translate(_GAP).split(), b""]), np.uint8).astype(np.uint32)
    out, gram = np.zeros(FEATURES, np.int64), np.zeros(len(a), np.uint32)
    for n in range(1, 5):
        if len(a) < n:
            break
        gram = (gram[: len(a) - n + 1] << np.uint32(8)) | a[n - 1 :]
        h = ((gram + np.uint32(n)) * _FACTOR) >> np.uint32(20)
        out += np.bincount(h, minlength=FEATURES)
    return out


def _damped(c: np.ndarray) -> np.ndarray:
    return np.log1p(c.astype(np.float32))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # rows of length 1
    language_of: np.ndarray
    least: np.ndarray  # per centroid the cosine below which a text is rejected

    def vectors(self, c: np.ndarray) -> np.ndarray:
        v = _damped(c) * self.idf
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def predict(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score (softmax over each language's best cosine) and whether the text is rejected."""
        cos = self.vectors(c) @ self.centroids.T
        per = np.full((len(c), len(self.languages)), -1.0)
        for k in range(len(self.languages)):
            per[:, k] = cos[:, self.language_of == k].max(1)
        best = per.argmax(1)
        e = np.exp(30 * (per - per.max(1, keepdims=True)))
        near = cos.argmax(1)
        return best, (e / e.sum(1, keepdims=True)).max(1), cos[np.arange(len(c)), near] < self.least[near]


def _clusters(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means that begins with rows far from one another."""
    k = min(k, len(x))
    at = [int((x @ x.mean(0)).argmax())]
    for _ in range(k - 1):
        at.append(int((x @ x[at].T).max(1).argmin()))
    c = x[at]
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        c = np.stack([x[near == j].sum(0) if (near == j).any() else c[j] for j in range(k)])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[tuple[str, int]] = set()
    for part in chunks(batches):
        new: dict[tuple[str, int], bytes] = {}
        for text, key in zip(part.column(1).to_pylist(), zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True), strict=True):
            if key not in seen:
                seen.add(key)
                new[key] = counts(text).astype("<u4").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in new], pa.string()), pa.array([k[1] for k in new], pa.int64()), pa.array(new.values(), pa.binary())], ["lang", "key", "counts"])


def sample(train: DataFrame, per_language: int, most_languages: int = 500) -> DataFrame:
    """lang, key (hash of the text) and counts of about per_language different texts of each language, and at least one.

    Equal texts of a language count as one, both in the rate and in what is drawn. Values of lang beyond the `most_languages` with
    the most different texts are left out (the bound of the labelled sample; ties by name).
    """
    known = train.filter("lang is not null").filter(F.col("text").rlike(r"\p{L}")).select("doc_id", "lang", "text", F.xxhash64("text").alias("key"))
    draw = F.pmod("key", F.lit(1 << 30))
    sizes = known.select("lang", "key").distinct().groupBy("lang").agg(F.count("*").alias("n"), F.min(draw).alias("least")).orderBy(F.col("n").desc(), "lang").limit(most_languages)
    drawn = known.join(F.broadcast(sizes), "lang").filter((draw / float(1 << 30) < F.lit(float(per_language)) / F.col("n")) | (draw == F.col("least")))
    # Copies are left out within each task, and then across tasks.
    once = text_rows(drawn, F.col("lang").cast("string").alias("lang"), "key").mapInArrow(_sample_counts, "lang string, key long, counts binary")
    return once.groupBy("lang", "key").agg(F.max("counts").alias("counts"))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts each feature is; feature -1 counts the texts."""
    n, df = 0, np.zeros(FEATURES, np.int64)
    for part in batches:
        for c in part.column(0).to_pylist():
            n, df = n + 1, df + (np.frombuffer(c, "<u4") > 0)
    yield pa.RecordBatch.from_arrays([pa.array([-1, *range(FEATURES)], pa.int32()), pa.array([n, *df.tolist()], pa.int64())], ["feature", "n"])


def _learned(idf: np.ndarray, clusters: int):
    """One language's centroids, and for each the cosine below which a text is rejected, from its drawn texts (a bounded number)."""

    def run(table: pa.Table) -> pa.Table:
        c = np.stack([np.frombuffer(x, "<u4") for x in sorted(table.column("counts").to_pylist())])
        x = Model([], idf, np.zeros((0, FEATURES)), np.zeros(0), np.zeros(0)).vectors(c)
        centroids = _clusters(x, clusters)
        cos = x @ centroids.T
        near = cos.argmax(1)
        own = cos[np.arange(len(x)), near]
        least = [float(0.8 * np.quantile(own[near == j], 0.01)) if (near == j).any() else 0.0 for j in range(len(centroids))]
        k = len(centroids)
        cols = [pa.array([table.column("lang")[0].as_py()] * k), pa.array(range(k), pa.int32()), pa.array([v.astype("<f4").tobytes() for v in centroids], pa.binary()), pa.array(least, pa.float64())]
        return pa.table(cols, names=["lang", "cluster", "centroid", "least"])

    return run


def fit(train: DataFrame, per_language: int = 400, clusters: int = 4) -> Model | None:
    """Learns from a sample of about per_language different texts of each language (drawn by a hash of the text).

    Rows with null lang, and texts that are null or have no letter, are left out. None if nothing is left. Languages are learned each in a task; what comes to the
    driver is a weight for each feature and, for each of at most 500 languages, `clusters` centroids of 16 KB.
    """
    drawn = cut(sample(train, per_language))
    n = {r.feature: r.n for r in drawn.select("counts").mapInArrow(_features, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    if not n.get(-1):
        return None
    idf = np.log((1 + n[-1]) / (1 + np.asarray([n[k] for k in range(FEATURES)]))).astype(np.float32) + np.float32(0.1)
    got = drawn.select("lang", "counts").groupBy("lang").applyInArrow(_learned(idf, clusters), "lang string, cluster int, centroid binary, least double").collect()
    got.sort(key=lambda r: (r.lang, r.cluster))
    languages = sorted({r.lang for r in got})
    centroids = np.stack([np.frombuffer(r.centroid, "<f4") for r in got])
    return Model(languages, idf, centroids, np.asarray([languages.index(r.lang) for r in got]), np.asarray([r.least for r in got]))


def _predict(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model | None = held.value
        for part in chunks(batches):
            texts = [t or b"" for t in part.column(1).to_pylist()]
            use = [i for i, t in enumerate(texts) if has_letter(t)] if model else []
            lang, score, far = ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
            for k in range(0, len(use), 512):
                some = use[k : k + 512]
                for i, l, s, r in zip(some, *model.predict(np.stack([counts(texts[i]) for i in some])), strict=True):
                    lang[i], score[i], far[i] = model.languages[l], float(s), bool(r)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang), pa.array(score, pa.float64()), pa.array(far)], ["doc_id", "lang_pred", "score", "rejected"])

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1), rejected for every row.

    Texts that are null, empty or have no letter get `und` with score 0 and are rejected, and so does every text if
    there is no model. A rejected text still names its nearest language. Ties go to the first language by name.
    Repeated rows and null ids are predicted like any other; extra columns are ignored; long texts are read whole.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    return text_rows(docs).mapInArrow(_predict(held), "doc_id long, lang_pred string, score double, rejected boolean")
