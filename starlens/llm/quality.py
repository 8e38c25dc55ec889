"""Quality rules as a ledger of bits.

Every rule is evaluated once for each document. The ledger keeps the measurements and one long whose
bits say which rules failed. Policies are named masks over those bits, so a new policy, or the
effect of leaving a rule out, needs no second look at the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordIds, chunks, row_type, text_rows, tidy, whole_row

_c = F.col


def rules() -> dict[str, Column]:
    """Each rule's condition of failure, in the order of the bits. New rules go to the end, so that old ledgers stay valid."""
    return {
        "few_words": _c("n_words") < 50,
        "repeated_windows": 100 * _c("n_repeat_words") > 50 * _c("n_words"),
        "symbols": 100 * _c("n_symbols") > 10 * _c("n_words"),
        "repeated_lines": 100 * _c("n_dup_lines") > 50 * _c("n_lines"),
        "short_words": _c("word_chars") < 3 * _c("n_words"),
        "long_words": _c("word_chars") > 12 * _c("n_words"),
        "capitals": 100 * _c("n_upper") > 40 * _c("word_chars"),
        "exclamations": 100 * _c("n_exclaim") > 50 * _c("n_words"),
        "digits": 100 * _c("n_digits") > 30 * _c("word_chars"),
    }


BASE = ("few_words", "repeated_windows")
#: version -> names of the rules that reject.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols", "repeated_lines", "short_words", "long_words", "capitals", "exclamations", "digits"),
}

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_exclaim long, n_digits long"
_SYMBOLS, _DIGITS, _SPACE = b"#*$%&|<>", b"0123456789", b" \t\n\r\x0b\x0c"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _repeated(ids: np.ndarray) -> int:
    """Words inside a window of three words that is found twice or more."""
    if len(ids) < 4:
        return 0
    win = (ids[:-2] << np.int64(42)) | (ids[1:-1] << np.int64(21)) | ids[2:]
    order = np.argsort(win, kind="stable")
    s = win[order]
    same = np.zeros(len(s) + 1, bool)
    same[1:-1] = s[1:] == s[:-1]
    twice = np.zeros(len(ids) + 3, bool)
    at = order[same[1:] | same[:-1]]
    for k in range(3):
        twice[at + k] = True
    return int(twice[: len(ids)].sum())


def _repeated_any(words: list[bytes], ids: np.ndarray) -> int:
    if ids.size and ids.max() >= 1 << 21:  # more distinct words than the packed windows have room for
        n, seen = len(words), {}
        wins = list(zip(ids.tolist(), ids[1:].tolist(), ids[2:].tolist(), strict=False))
        for w in wins:
            seen[w] = seen.get(w, 0) + 1
        hit = bytearray(n)
        for i, w in enumerate(wins):
            if seen[w] > 1:
                hit[i : i + 3] = b"\1\1\1"
        return sum(hit)
    return _repeated(ids)


def _upper(bare: bytes) -> int:
    beyond = bare.translate(None, bytes(range(128))).decode("utf-8", "replace")
    return len(bare) - len(bare.translate(None, _UPPER)) + sum(map(str.isupper, beyond))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["row", *(x.split()[0] for x in MEASURES.split(", "))]
    tidy(forget=True)
    for part in chunks(batches):
        number, out = WordIds(), []
        for text in part.column(1).to_pylist():
            t = text or b""
            words = t.split()
            lines = [x for x in t.split(b"\n") if x.strip()]
            bare = t.translate(None, _SPACE)
            inner = int((np.frombuffer(bare, np.uint8) & 0xC0 == 0x80).sum())  # bytes that begin no code point
            out.append((
                len(words), len(bare) - inner, len(t) - len(t.translate(None, _SYMBOLS)), len(lines) - len(set(lines)),
                _repeated_any(words, number(words)), len(lines), _upper(bare), t.count(b"!"), len(t) - len(t.translate(None, _DIGITS)),
            ))
        yield pa.RecordBatch.from_arrays([part.column(2), *(pa.array(c, pa.int64()) for c in zip(*out, strict=True))], names)
    tidy()


def measured(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """The input row (or the columns in carry) as a struct `row`, every measurement and failed_bits.

    Null and empty texts have no words and measure 0. Rows that repeat are measured again each time; other
    columns are only carried. An empty table gives an empty ledger.
    """
    kept = docs.select(*(F.col(f"`{c}`") for c in carry or docs.columns))
    m = text_rows(docs, whole_row(kept)).mapInArrow(_measure, f"{row_type(kept)}, {MEASURES}")
    bits = F.lit(0).cast("long")
    for k, failed in enumerate(rules().values()):
        bits = bits.bitwiseOR(F.when(failed, F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return m.withColumn("failed_bits", bits)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, every measurement and failed_bits (see measured)."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return measured(narrow, carry=["doc_id"]).select("row.doc_id", *(x.split()[0] for x in MEASURES.split(", ")), "failed_bits")


def mask(policy: str) -> int:
    names = list(rules())
    return sum(1 << names.index(x) for x in POLICIES[policy])


def apply_policy(led: DataFrame, policy: str = "v1") -> DataFrame:
    """Adds base_failed and kept by a policy's mask."""
    hit = lambda p: _c("failed_bits").bitwiseAND(F.lit(mask(p)).cast("long")) != 0
    return led.withColumn("base_failed", hit("base")).withColumn("kept", ~hit("base") & ~hit(policy))


def ablations(led: DataFrame, policy: str = "v1") -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail it alone, and that the policy keeps without it.

    Documents are first counted by their bits, so the shuffle carries one row per distinct mask and task.
    """
    m, names = mask(policy), list(rules())
    hist = led.groupBy(_c("failed_bits").bitwiseAND(F.lit(m).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    rows = hist.select("bits", "n", F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit")) for r in POLICIES[policy]))).alias("r")).select("bits", "n", "r.*")
    n_if = lambda cond: F.coalesce(F.sum(F.when(cond, _c("n"))), F.lit(0))
    without = _c("bits").bitwiseAND(F.bitwise_not(_c("bit"))) == 0
    return rows.groupBy("rule").agg(
        n_if(_c("bits").bitwiseAND(_c("bit")) != 0).alias("failed"), n_if(_c("bits") == _c("bit")).alias("failed_alone"), n_if(without).alias("kept_without")
    )


def filter_documents(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The rows a policy keeps, with all their columns and only those."""
    return apply_policy(measured(docs), policy).filter("kept").select("row.*")
