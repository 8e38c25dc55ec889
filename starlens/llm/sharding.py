"""Shards of near-equal bytes by sampled splitters; DataFrame functions only.

Rows are ordered by (hash of the text, doc_id), so equal texts lie side by side. A sample whose
probability follows each row's size gives the splitters: quantiles of the sampled keys. Ranges that
turn out overfull (one text copied many times) are subdivided by a second key. The ranges, a few
thousand whatever the input, are then dealt to shards in order.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

_c = F.col


def _uniform(*cols: Column | str) -> Column:
    """A number in [0, 1) that depends on the values alone, so that a task run again draws the same rows."""
    return F.pmod(F.xxhash64(F.lit("draw"), *cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _range_of(key: Column, bounds: Column, n: int) -> Column:
    """How many of the sorted bounds are <= key: binary search with log2(n) steps per row."""
    steps, s = [], 1
    while s <= n:
        steps, s = [s, *steps], s * 2
    if not steps:
        return F.lit(0)
    step = lambda at, s: F.when((at + s <= F.size(bounds)) & (F.get(bounds, at + s - 1) <= key), at + s).otherwise(at)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1; null text: 1), text_crc32, the key and a mark for rows without an id; the text stays behind."""
    text = F.coalesce(_c("text").cast("string"), F.lit(""))
    mark = F.when(_c("doc_id").isNull(), F.monotonically_increasing_id()).alias("mark")
    return docs.select(_c("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"), mark, *more)


def assign(docs: DataFrame, shards: int = 16, ranges_per_shard: int = 256, sample_per_range: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (gapless from 0 within a shard), grown_shard (null under this law).

    Shard sizes differ by about one range: 1/ranges_per_shard of a shard, or one document if that is larger. Equal
    texts share a shard unless their range is overfull. Null and empty texts have size 1 and crc32 0. Rows that
    repeat, and null ids, are rows like any other; rows without an id are told apart by their place in the input where a range is overfull. Extra columns are ignored. An empty table gives no rows.
    """
    placed = _placed(cut(keyed(docs)), shards, ranges_per_shard, sample_per_range)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _placed(rows: DataFrame, shards: int, ranges_per_shard: int = 256, sample_per_range: int = 24) -> DataFrame:
    """Keyed rows, written before, with shard and slot."""
    n_ranges = shards * ranges_per_shard
    total = F.broadcast(rows.agg(F.sum("size").alias("total")))
    drawn = rows.crossJoin(total).filter(_uniform("key", "doc_id", "mark") < _c("size") * float(n_ranges * sample_per_range) / _c("total"))
    quantiles = F.lit(np.arange(1, n_ranges) / n_ranges)  # numpy only to write the literal
    bounds = drawn.agg(F.array_sort(F.array_distinct(F.percentile_approx("key", quantiles, 20 * n_ranges))).alias("bounds"), F.first("total").alias("total"))
    ranged = rows.crossJoin(F.broadcast(bounds)).withColumn("range", _range_of(_c("key"), F.coalesce(_c("bounds"), F.array().cast("array<long>")), n_ranges))
    target = F.greatest(_c("total") / F.lit(n_ranges), F.lit(1.0))
    full = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.first(target).alias("target"))
    parts = full.select("range", F.greatest(F.lit(1), F.when(_c("bytes") > 2 * _c("target"), F.ceil(_c("bytes") / _c("target"))).otherwise(1)).cast("int").alias("parts"))
    divided = ranged.drop("bounds").join(F.broadcast(parts), "range", "left")  # at most n_ranges rows
    cell = divided.withColumn("part", F.when(_c("parts") > 1, F.pmod(F.xxhash64("doc_id", "mark", F.lit("part")), _c("parts"))).otherwise(0).cast("int"))
    # at most 2 * n_ranges + 2 * n_ranges cells: an overfull range has as many parts as targets fit into it
    sums = cell.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.first("total").alias("total"))
    order = Window.partitionBy(F.lit(0)).orderBy("range", "part")
    before = lambda c: F.sum(c).over(order.rowsBetween(Window.unboundedPreceding, -1))
    dealt = sums.withColumn("shard", F.least(F.lit(shards - 1), F.floor((F.coalesce(before("bytes"), F.lit(0)) + _c("bytes") / 2) * shards / _c("total"))).cast("int"))
    in_shard = Window.partitionBy("shard").orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.select("range", "part", "shard", F.coalesce(F.sum("rows").over(in_shard), F.lit(0)).alias("skip"))
    within = Window.partitionBy("range", "part").orderBy("key", "doc_id", "text_crc32", "mark")
    return cell.join(F.broadcast(dealt), ["range", "part"]).withColumn("slot", (_c("skip") + F.row_number().over(within) - 1).cast("long"))


def write_shards(docs: DataFrame, path: str, shards: int = 16) -> None:
    """Writes every row of docs, in folders by shard, each shard in slot order; columns shard and slot are added.

    Null ids, null texts and repeated rows are written like any other. If docs has a column shard or slot itself, ours get an underscore behind
    their name. An empty table writes no rows. Rows are written to the shared folder once, with their texts, before they are placed.
    """
    name = {c: c + "_" * next(k for k in range(len(docs.columns) + 1) if c + "_" * k not in docs.columns) for c in ("shard", "slot")}
    placed = _placed(cut(keyed(docs, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))), shards)
    out = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    out.select("row.*", *(_c(f"`{old}`").alias(new) for old, new in name.items())).write.partitionBy(name["shard"]).parquet(path)
