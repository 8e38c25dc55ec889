"""Exact ranks, percentiles and neighbours where few keys hold many rows.

A window over such a key would sort all its rows in one task. Here each key is divided at approximate quantiles of the value
into pieces of about ROWS rows, windows sort pieces, and the counts of the pieces say where each begins. The cuts are
checkpointed, so that a repeated task divides alike. Rows of equal value share a piece.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..sources.frames import cut

_c = F.col
#: rows of a piece; pieces of a key at least and at most; rows up to which a key is not divided
ROWS, PIECES, MOST, WHOLE = 1 << 20, 64, 4096, 1 << 16


def _pieces(df: DataFrame, key: str, value: str) -> DataFrame:
    """df with _piece, which rises with the value within a key; null values are in piece 0, as is all of a key of few rows: quantiles are sought for the few large keys alone."""
    large = cut(df.groupBy(_c(key).alias("_key")).count().filter(_c("count") > WHOLE))
    largest = large.agg(F.max("count")).first()[0] or 0
    if not largest:
        return df.withColumn("_piece", F.lit(0))
    n = min(MOST, max(PIECES, -(-largest // ROWS)))
    if isinstance(df.schema[value].dataType, StringType):  # quantiles are of numbers: those of the first bytes, which have the strings' order
        as_number = lambda c: F.conv(F.rpad(F.substring(F.hex(c.cast("binary")), 1, 12), 12, "0"), 16, 10).cast("long")
    else:
        as_number = lambda c: c
    cuts = cut(df.join(large.select("_key"), _c(key).eqNullSafe(_c("_key")), "left_semi").groupBy(_c(key).alias("_key")).agg(F.percentile_approx(as_number(_c(value)), [k / n for k in range(1, n)], max(10_000, 20 * n)).alias("_cuts")))
    piece = F.coalesce(F.size(F.filter("_cuts", lambda c: c < as_number(_c(value)))), F.lit(0))
    return df.join(cuts, _c(key).eqNullSafe(_c("_key")), "left").withColumn("_piece", F.greatest(piece, F.lit(0))).drop("_cuts", "_key")


def _with_counts(t: DataFrame, key: str, *counts: Column) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Counts by piece, a few rows a key, and how a table made of them is joined to t."""
    s = t.groupBy(_c(key).alias("_k"), _c("_piece").alias("_p")).agg(*counts)
    return s, lambda made: t.join(made, _c(key).eqNullSafe(_c("_k")) & (_c("_piece") == _c("_p")), "left").drop("_k", "_p")


def ranks(df: DataFrame, key: str, value: str, rising: bool = False) -> DataFrame:
    """df with rank_ and dense_ (long): places by falling (or rising) value within the key, from 1; nulls come last where values fall, else first."""
    s, joined = _with_counts(_pieces(df, key, value), key, F.count("*").alias("_n"), F.count_distinct(value).alias("_d"))
    way = F.asc if rising else F.desc
    higher = Window.partitionBy("_k").orderBy(way("_p"))
    s = s.select("_k", "_p", *((F.sum(n).over(higher) - _c(n)).alias(f"{n}_above") for n in ("_n", "_d")))
    inside = Window.partitionBy(key, "_piece").orderBy(way(value))
    out = joined(s).withColumns({"rank_": F.rank().over(inside) + _c("_n_above"), "dense_": F.dense_rank().over(inside) + _c("_d_above")})
    return out.drop("_piece", "_n_above", "_d_above")


def percentiles(df: DataFrame, key: str, value: str, wanted: dict[str, tuple[float, bool]]) -> DataFrame:
    """key and one exact percentile a name, linear between neighbours. wanted: name -> (share, whether ends are excluded).

    Null values don't count; a percentile with excluded ends that lies outside the values is null. Only the pieces that hold
    a wanted place are sorted.
    """
    s, joined = _with_counts(_pieces(df.select(key, value).filter(_c(value).isNotNull()), key, value), key, F.count("*").alias("_n"))
    all_, up_to = Window.partitionBy("_k"), Window.partitionBy("_k").orderBy("_p")
    s = s.select("_k", "_p", (F.sum("_n").over(up_to) - _c("_n")).alias("_before"), F.sum("_n").over(up_to).alias("_upto"), F.sum("_n").over(all_).alias("_all"))
    place = {name: (F.lit(p) * (_c("_all") + 1) if outside else F.lit(p) * (_c("_all") - 1) + 1) for name, (p, outside) in wanted.items()}  # from 1
    ends = lambda h: (F.floor(h), F.ceil(h))
    held = s.filter(F.greatest(*((e > _c("_before")) & (e <= _c("_upto")) for h in place.values() for e in ends(h)), F.lit(False)))
    t = joined(held.select("_k", "_p", "_before", "_all")).filter("_before is not null")
    t = t.withColumn("_i", F.row_number().over(Window.partitionBy(key, "_piece").orderBy(value)) + _c("_before"))
    at = lambda e: F.max(F.when(_c("_i") == e, _c(value)))
    out = [(at(F.floor(h)) + F.max(h - F.floor(h)) * (at(F.ceil(h)) - at(F.floor(h)))).alias(name) for name, h in place.items()]
    return t.groupBy(key).agg(*out)


def neighbourhood(df: DataFrame, key: str, value: str, tie: str, back: int, ahead: int, columns: dict[str, Callable], size: int = 4096) -> DataFrame:
    """df with columns over at most `back` rows before and `ahead` after, by falling value, then rising tie, within the key.

    columns: name -> function of a window in that order. Rows are numbered first; then stretches of `size` rows, each with
    copies of its neighbours' last and first rows, are sorted by themselves. Rows of one value are numbered in one task.
    """
    s, joined = _with_counts(_pieces(df, key, value), key, F.count("*").alias("_n"))
    higher = Window.partitionBy("_k").orderBy(_c("_p").desc())
    t = joined(s.select("_k", "_p", (F.sum("_n").over(higher) - _c("_n")).alias("_above")))
    t = t.withColumn("_i", F.row_number().over(Window.partitionBy(key, "_piece").orderBy(_c(value).desc(), tie)) + _c("_above") - 1)
    stretch = lambda shift: F.greatest(F.floor((_c("_i") + shift) / size), F.lit(0))
    t = t.withColumn("_s", F.explode(F.array_distinct(F.array(stretch(0), stretch(back), stretch(-ahead)))))
    w = Window.partitionBy(key, "_s").orderBy("_i")
    return t.withColumns({n: f(w) for n, f in columns.items()}).filter(_c("_s") == stretch(0)).drop("_piece", "_above", "_i", "_s")
