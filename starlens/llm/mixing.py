"""Mixing sources to target weights by nested hash thresholds; DataFrame functions only.

Every document has a key of 60 hashed bits. The first 12 bits give a histogram of sizes for each source, whose running sums show the one
bucket in which the source's budget ends. Only the documents of that bucket are looked at again, by the next 12 bits, until it holds one
document. What a source takes is then a comparison of keys with one number for each source; nothing is sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import attach, cut

_c = F.col
BITS, LEVELS = 12, 5
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def words(text: Column) -> Column:
    """How many runs of other characters than ASCII white space a text has (null: 0): its length with every run replaced by one letter, less the white space."""
    t = F.coalesce(text, F.lit(""))
    gaps = F.length(t) - F.length(F.translate(t, SPACE, ""))
    return (F.length(F.regexp_replace(t, r"[^\x20\x09-\x0D]++", "w")) - gaps).cast("long")


def hashed(*cols: Column) -> Column:
    """60 bits of a digest of the values, as a number."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *cols).cast("binary")), 1, 5 * BITS // 4), 16, 10).cast("long")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size in words, key; `mark` tells rows apart that are equal in all of these."""
    text = F.coalesce(_c(f"`{text_col}`").cast("string"), F.lit(""))
    name = F.coalesce(_c(f"`{id_col}`").cast("string"), F.lit(""))
    mark = hashed(F.monotonically_increasing_id().cast("string"))
    return docs.select(_c(f"`{id_col}`").alias("doc_id"), _c(f"`{source_col}`").alias("source"), words(text).alias("size"), hashed(name, F.md5(text.cast("binary"))).alias("key"), mark.alias("mark"))


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """sizes (source, source_size) with `target`: share times all sizes, divided by weight, at most `most` times the source's own size.

    Sources have the weights in turn, by code point, null last. What a source can't take goes to the others by weight, until none is above its
    bound: the common factor f of weights, where min(bound, f * weight) adds up to the whole, is found by a few sums over the sources.
    """
    by_range = cut(sizes.repartitionByRange(F.asc_nulls_last("source")).sortWithinPartitions(F.asc_nulls_last("source")).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    # one row for each partition, not for each source
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    skipped = by_range.groupBy(part.alias("part")).count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("skip"))
    rank = _c("skip") + _c("at").bitwiseAND((1 << 33) - 1)
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (rank % len(weights) + 1).cast("int"))
    weighed = cut(by_range.join(F.broadcast(skipped), part == skipped.part).select("source", "source_size", weight.alias("weight")))
    bound = _c("source_size") * F.lit(float(most))
    total, whole_weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    budget, full = share * (total or 0), -1.0
    factor = budget / whole_weight if whole_weight else 0.0
    while True:
        over = bound <= _c("weight") * F.lit(factor)
        stopped, free = weighed.agg(F.sum(F.when(over, bound).otherwise(0.0)), F.sum(F.when(~over, _c("weight")).otherwise(0.0))).first() if total else (0.0, 0.0)
        if not free or stopped == full:  # a source that stops once stays stopped, as the factor only grows
            break
        factor, full = (budget - stopped) / free, stopped
    return weighed.select("source", "source_size", F.least(bound, _c("weight") * F.lit(factor)).alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: int = 2, **cols: str) -> DataFrame:
    """doc_id, source, size, source_size, target, times (how often the mix takes the document), taken (times * size).

    A source's documents are taken floor(target / source_size) times each, and once more in the order of their keys as long as the middle of a
    document lies within what is left of the target: taken and target differ by half a document at most. A longer target takes all that a
    shorter one takes. Keys come from doc_id and text, so that reruns agree; rows equal in both are told apart by their place in the
    input, which makes no difference but to other columns. Null texts have size 0; null sources are a source of their own, the last. Null ids and
    repeated rows are documents like any other. No document is taken more than `most` times. Extra columns are ignored. An empty table gives no rows.
    """
    rows = cut(keyed(docs, **cols))
    aims = cut(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most))
    full = F.when(_c("source_size") > 0, F.floor(_c("target") / _c("source_size"))).otherwise(0)
    aims = aims.withColumn("full", full).withColumn("rest", _c("target") - _c("full") * _c("source_size"))
    facts = cut(aims.join(thresholds(rows, aims.select("source", "rest")).withColumnRenamed("source", "s"), _c("source").eqNullSafe(_c("s")), "left").drop("s", "rest"))
    met = attach(rows, facts, "source")
    more = (_c("key") < _c("key_end")) | ((_c("key") == _c("key_end")) & (_c("mark") < _c("mark_end")))
    times = (_c("full") + F.coalesce(more, F.lit(False)).cast("int")).cast("int")
    return met.select("doc_id", "source", "size", "source_size", "target", times.alias("times"), (times * _c("size")).alias("taken"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """source, key_end, mark_end: the documents of a source whose (key, mark) is below that pair fill its budget `rest`.

    Five levels of 12 bits of the key, then, for rows equal in key, five of the mark; the loop ends when no budget ends within a bucket of several documents.
    """
    here, done = rows.select("source", "size", "key", "mark"), None
    open_ = budgets.filter("rest > 0").select("source", "rest", F.lit(0).cast("long").alias("key_end"), F.lit(0).cast("long").alias("mark_end"))
    for level in range(2 * LEVELS):
        col, shift = ("key", "mark")[level // LEVELS], BITS * (LEVELS - 1 - level % LEVELS)
        digit = F.shiftright(col, shift).bitwiseAND((1 << BITS) - 1).alias("digit")
        bucket = here.groupBy("source", digit).agg(F.sum("size").alias("bytes"), F.count("*").alias("docs"))
        up_to = Window.partitionBy("source").orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = bucket.withColumn("end", F.sum("bytes").over(up_to)).withColumnRenamed("source", "s")
        at = open_.join(sums, _c("source").eqNullSafe(_c("s")), "left")
        step = F.lit(1 << shift)
        # the bucket where the budget ends, if it ends within one
        within = (_c("end") - _c("bytes") < _c("rest")) & (_c("rest") < _c("end"))
        cutting = F.max(F.when(within, F.struct("digit", "bytes", "docs", "end"))).alias("cutting")
        below = F.coalesce(F.max(F.when(_c("end") <= _c("rest"), _c("digit") + 1)), F.lit(0)).alias("below")
        found = at.groupBy("source", "rest", "key_end", "mark_end").agg(cutting, below)
        left = _c("rest") - (_c("cutting.end") - _c("cutting.bytes"))
        last = _c("cutting.docs") == 1
        # a single document is taken if its middle lies within the budget
        digits = F.when(_c("cutting").isNull(), _c("below")).otherwise(_c("cutting.digit") + (last & (2 * left >= _c("cutting.bytes"))).cast("int"))
        moved = (_c(f"{col}_end") + digits * step).alias(f"{col}_end")
        other = "mark_end" if col == "key" else "key_end"
        new = cut(found.select("source", moved, other, left.alias("rest"), F.coalesce(~last, F.lit(False)).alias("more"), _c("cutting.digit").alias("digit")))
        ended = new.filter("not more").select("source", "key_end", "mark_end")
        done = ended if done is None else done.unionByName(ended)
        open_ = new.filter("more").select("source", "rest", "key_end", "mark_end")
        if open_.isEmpty():
            return done
        inner = open_.select("source", F.shiftright(f"{col}_end", shift).bitwiseAND((1 << BITS) - 1).alias("edge"))
        here = cut(attach(here, inner, "source").filter(digit == _c("edge")).drop("edge"))
    # rows that agree in all 120 bits: the budget ends before them
    return done.unionByName(open_.select("source", "key_end", "mark_end"))
