"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words one edit apart the shorter one, of length L, contributes two disjoint chunks, its first and last L // 2 letters; the edit
leaves one of them whole. The other word contributes its positional grams of that size. A chunk can only lie where it lay, or one
place on where it is the last and the other word is longer, so of all grams just those within that shift travel. Many words share a
chunk (every word of six letters in -ing), so the rest of the word, which holds the edit, is chunked once more in the same way, and a
key is a chunk with a chunk of the rest: about three quarters of a word. Words that meet are verified letter by letter.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, chunks, cut, text_rows

_c = F.col
KINDS = 4


def count_words(docs: DataFrame, shortest: int = 6, fewest: int = 5, misspell: int = 199, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: runs of the letters A to Z and U+00C0 to U+00FF with A to Z lowered, of at least `shortest` letters and `fewest` occurrences in all texts.

    Where `misspell` divides the crc32 of "<doc_id>:<run>", the run loses its letter number crc32 % length. A null doc_id is written as nothing; null
    and empty texts have no runs; repeated rows count each. With misspell = 0 runs stay as they are.
    """
    runs_of = re.compile(f"[a-zÀ-ÿ]{{{shortest},}}").finditer  # a shorter run can't get longer

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for some in chunks(batches):
            for doc, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                runs = map(re.Match.group, runs_of(text.translate(LOWER).decode("utf-8", "replace")))
                while part := Counter(itertools.islice(runs, 1 << 18)):
                    for w, n in part.items():
                        h = zlib.crc32(w.encode(), seed)
                        if misspell and h % misspell == 0:
                            k = h % len(w)
                            w = w[:k] + w[k + 1 :]
                            if len(w) < shortest:
                                continue
                        total[w] += n
                    if len(total) > 1 << 18:
                        yield _rows(total)
                        total.clear()
        if total:
            yield _rows(total)

    found = text_rows(docs, id_col=id_col, text_col=text_col).mapInArrow(counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(_c("n") >= fewest)


def _rows(total: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])


def _sizes(length: Column) -> list[tuple[Column, Column]]:
    """How many letters of the beginning and of the end of a word of that length make a key of each kind.

    q letters are a chunk, r are its rest and s a chunk of the rest: first chunk with the rest's first or last, last chunk with the rest's first or last.
    """
    q = F.floor(length / 2)
    s, none = F.floor((length - q) / 2), F.lit(0)
    as_int = lambda *xs: tuple(x.cast("int") for x in xs)
    return [as_int(q + s, none), as_int(q, s), as_int(s, q), as_int(none, q + s)]


def _pieces(word: str, length: Column) -> list[Column]:
    """What a word has where a word of that length has the chunks of each kind, counted from its beginning and from its end."""
    return [F.struct(F.left(word, i).alias("head"), F.right(word, j).alias("tail")) for i, j in _sizes(length)]


def _keyed(words: DataFrame, length: Column) -> DataFrame:
    """A row for each word and kind: key, kind, word, n."""
    keys = [F.struct(F.xxhash64(length, F.lit(k), p["head"], p["tail"]).alias("key"), F.lit(k).alias("kind")) for k, p in enumerate(_pieces("word", length))]
    return words.select("word", "n", F.explode(F.array(*keys)).alias("k")).select("k.key", "k.kind", "word", "n")


def near_pairs(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n: each pair of different words, one inserted, deleted or replaced letter apart, once; a is the shorter one, or of equally long ones the smaller.

    words has word and n of 1 or more, each word once. Words of one letter, and null words, are near to nothing. Words that differ in more than about a
    quarter of their letters never meet. A pair that meets at several keys is kept at the first one only, so that nothing has to be made distinct.
    """
    words = words.select("word", "n").filter(F.length("word") > 1)
    size = F.length("word")
    chunk_side = _keyed(words, size).toDF("key", "kind", "a", "a_n")
    grams = _keyed(words, size).unionByName(_keyed(words.filter(size > 2), size - 1)).toDF("key", "kind", "b", "b_n")
    met = chunk_side.join(grams, ["key", "kind"]).filter((F.length("a") < F.length("b")) | ((F.length("a") == F.length("b")) & (_c("a") < _c("b"))))
    first = F.lit(KINDS)
    for k, (p, q) in reversed(list(enumerate(zip(_pieces("a", F.length("a")), _pieces("b", F.length("a")), strict=True)))):
        first = F.when(p == q, k).otherwise(first)
    return met.filter((_c("kind") == first) & (F.levenshtein("a", "b", 1) == 1)).select("a", "a_n", "b", "b_n")


def group(words: DataFrame, ratio: int = 5) -> DataFrame:
    """word, n, form, root, n_near, form_n for each row of words (word, n of 1 or more; each word once); ratio is 2 or more.

    A word's form is its near word with the largest n (of equal ones the first by code point), if that n is at least `ratio` times the word's own;
    root is where following forms ends. Words without near words have n_near 0 and are their own root. An empty table gives no rows.
    """
    words = cut(words.select("word", "n"))
    pair = near_pairs(words)
    both = pair.select(F.explode(F.array(F.struct(_c("a").alias("word"), _c("b").alias("other"), _c("b_n").alias("m")), F.struct(_c("b").alias("word"), _c("a").alias("other"), _c("a_n").alias("m")))).alias("e")).select("e.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-_c("m")).alias("m"), "other")).alias("best"))
    large = -_c("best.m") >= ratio * _c("n")
    formed = words.join(best, "word", "left").select(
        "word", "n", F.when(large, _c("best.other")).alias("form"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(large, -_c("best.m")).alias("form_n")
    )
    formed = cut(formed)
    return formed.join(_roots(formed.filter("form is not null"), ratio), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(formed: DataFrame, ratio: int) -> DataFrame:
    """word, root of words with a form. Each step along forms multiplies n by ratio, so that a chain is no longer than the largest n allows; every round doubles what is known of it."""
    root = formed.select("word", _c("form").alias("root"))
    most, steps = formed.agg(F.max("form_n")).first()[0] or 1, 0
    while ratio ** (steps + 1) <= most:
        steps += 1
    for _ in range(max(0, steps - 1).bit_length()):
        on = root.toDF("middle", "end")
        root = cut(root.join(on, root.root == on.middle, "left").select("word", F.coalesce("end", "root").alias("root")))
    return root
