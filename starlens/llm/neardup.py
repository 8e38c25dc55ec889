"""Near duplicates by HyperMinHash.

A document's set of word shingles is reduced to registers. Each register keeps, of the least hash under one
permutation, the number of leading zeros and the first mantissa bits (16 bits together). Registers are cut into
bands; documents that agree on a band are candidates. Candidates are estimated from their registers, with
a correction for registers that agree by chance, and every link is confirmed on the full sets.

Groups of any size are handled without listing their pairs. Equal texts count as one. Each member of a band is first
held against the one it shares most bands with, of the smallest members of its bands, on full sets: this joins
nearly all copies, and each text travels once. What stays open are bands whose members are not all joined; there the
registers of members not yet joined are compared, without texts, in blocks of bounded size. Texts travel again only for documents
with such a candidate, and are compared only with those that they are not joined with.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, chunks, cut, mixed, rolled, text_rows, tidy, whole_row

MANTISSA = 10
_c = F.col


def shape(percent: int, miss: float = 1e-6) -> tuple[int, int]:
    """Bands and rows such that a pair at the threshold shares no band with probability below `miss`."""
    rows = 6 if percent >= 85 else 5
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows)), rows


def shingle_sets(words: Words, n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's n-word shingles; a text with fewer words, but not none, is one shingle."""
    h = words.hashes()
    if not len(h):
        return [np.zeros(0, np.uint64) for _ in words.sizes]
    by = rolled(h, n)
    out = []
    for first, size in zip(words.first.tolist(), words.sizes.tolist(), strict=True):
        if size >= n:
            out.append(np.unique(by[first : first + size - n + 1]))
        else:
            out.append(rolled(h[first : first + size], size)[:1] ^ np.uint64(size) if size else np.zeros(0, np.uint64))
    return out


def registers(sets: list[np.ndarray], count: int) -> np.ndarray:
    """One row of 16-bit registers per set, which must not be empty."""
    sizes = np.asarray([len(s) for s in sets], np.int64)
    starts = np.cumsum(sizes) - sizes
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    a = (mixed(np.arange(1, count + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    b = (mixed(np.arange(1001, count + 1001, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), count), np.uint16)
    buffer = np.empty_like(x)
    for k in range(count):
        np.multiply(x, a[k], out=buffer)
        np.add(buffer, b[k], out=buffer)
        # a multiplication moves nothing downwards: fold the upper half in before the least value is sought
        np.bitwise_xor(buffer, buffer >> np.uint32(15), out=buffer)
        np.multiply(buffer, np.uint32(0x2C1B3C6D), out=buffer)
        least = np.minimum.reduceat(buffer, starts).astype(np.uint64)
        zeros = 32 - np.ceil(np.log2(least + np.uint64(1))).astype(np.int64)
        mantissa = ((least << (zeros + 1).astype(np.uint64)) >> np.uint64(32 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
        out[:, k] = (zeros.astype(np.uint64) << np.uint64(MANTISSA)) | mantissa
    return out


@lru_cache(maxsize=4096)
def _chance(log_n: int, log_m: int) -> float:
    n, m = 2.0 ** (log_n / 2), 2.0 ** (log_m / 2)
    total = 0.0
    for zeros in range(33):
        low = 0.0 if zeros == 32 else 2.0 ** -(zeros + 1)
        edges = np.linspace(low, 2.0**-zeros, (1 << MANTISSA) + 1)
        p, q = (-np.diff(np.exp(k * np.log1p(-np.minimum(edges, 1 - 1e-15)))) for k in (n, m))
        total += float((p * q).sum())
    return total


def chance(n: int, m: int) -> float:
    """The probability that a register of two unrelated sets of these sizes agrees."""
    return _chance(round(2 * math.log2(max(n, 1))), round(2 * math.log2(max(m, 1))))


def chances(n: int, m: np.ndarray) -> np.ndarray:
    sizes, at = np.unique(np.maximum(m, 1), return_inverse=True)
    return np.asarray([chance(n, int(x)) for x in sizes])[at] if len(m) else np.zeros(0)


def estimate(agree: np.ndarray, count: int, by_chance: np.ndarray | float) -> np.ndarray:
    """Jaccard similarity from the share of agreeing registers, corrected for agreement by chance."""
    return np.clip((agree / count - by_chance) / (1 - by_chance), 0, 1)


def _signatures(n: int, count: int):
    names = ["doc_id", "text_key", "set_key", "n_shingles", "n_bytes", "registers"]
    types = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy(forget=True)
        for part in chunks(batches):
            ids, texts, text_keys = (c.to_pylist() for c in part.columns[:3])
            w = Words(texts, lower=True)
            spans = [w.span(a, a + k) if k else b"" for a, k in zip(w.first.tolist(), w.sizes.tolist(), strict=True)]
            keys = [xxhash.xxh3_128_digest(s) if s else None for s in spans]
            del spans
            sets = shingle_sets(w, n)
            seen: dict[bytes, int] = {}
            for i, k in enumerate(keys):
                if k is not None:
                    seen.setdefault(k, i)
            own = list(seen.values())
            regs: list[bytes | None] = [None] * len(ids)
            for i, r in zip(own, registers([sets[i] for i in own], count) if own else (), strict=True):
                regs[i] = r.tobytes()
            cols = [ids, text_keys, keys, [len(s) for s in sets], [len(t or b"") for t in texts], regs]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)
        tidy()

    return run


class _Sets:
    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _held_against_hub(n: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        w = Words(table.column("text").to_pylist(), lower=True)
        sets = shingle_sets(w, n)
        node, hub = (np.asarray(table.column(c).to_pylist(), np.int64) for c in ("node", "hub"))
        hubs: dict[int, list[np.ndarray]] = {}
        for i in np.flatnonzero(node == hub).tolist():
            hubs.setdefault(int(hub[i]), []).append(sets[i])
        found = [(int(node[i]), int(hub[i])) for i in np.flatnonzero(node != hub).tolist() if any(_linked(sets[i], x, percent) for x in hubs[int(hub[i])])]
        u, v = zip(*found, strict=True) if found else ((), ())
        tidy()
        return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.intersect1d(x, y, assume_unique=True).size
    return 100 * both >= percent * (len(x) + len(y) - both)


def _compared(percent: int, count: int, shingle: int | None):
    """Links between rows of a group that are not joined yet: by their registers, and confirmed on the sets where texts are there.

    Reports those links alone that join something new within the task.
    """
    theta = percent / 100
    floor = theta - 5 * math.sqrt(theta * (1 - theta) / count)

    def near(sizes, regs, i: int, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of `rest` that may be linked with i, and their estimates."""
        small, large = np.minimum(sizes[rest], sizes[i]), np.maximum(sizes[rest], sizes[i])
        rest = rest[100 * small >= percent * large]
        agree = (regs[rest] == regs[i]).sum(1)
        rest, agree = rest[agree >= floor * count - 1e-9], agree[agree >= floor * count - 1e-9]  # chance only adds to agreement
        value = estimate(agree, count, chances(int(sizes[i]), sizes[rest]))
        return rest[value >= floor], value[value >= floor]

    def by_registers(sizes, regs, comp, block) -> Iterator[tuple[int, int]]:
        part = np.arange(len(sizes))
        for i in range(len(sizes) - 1):
            rest = i + 1 + np.flatnonzero((part[i + 1 :] != part[i]) & (comp[i + 1 :] != comp[i]))
            rest, _ = near(sizes, regs, i, rest if block is None else rest[block[rest] != block[i]])
            parts, at = np.unique(part[rest], return_index=True)
            yield from ((i, j) for j in rest[at].tolist())
            if len(parts):
                part[np.isin(part, parts)] = part[i]

    def by_sets(sizes, regs, comp, block, sets) -> Iterator[tuple[int, int]]:
        found = [np.zeros((3, 0))]
        for i in range(len(sizes) - 1):
            rest = i + 1 + np.flatnonzero(comp[i + 1 :] != comp[i])
            rest, value = near(sizes, regs, i, rest if block is None else rest[block[rest] != block[i]])
            found.append(np.stack([-value, np.full(len(rest), i), rest]))
        pairs = np.concatenate(found, 1)
        pairs = pairs[1:, np.lexsort(pairs[::-1])].astype(np.int64)
        joined = _Sets()
        for i, j in zip(*pairs.tolist(), strict=True):
            if joined.find(int(comp[i])) != joined.find(int(comp[j])) and _linked(sets[i], sets[j], percent):
                joined.join(int(comp[i]), int(comp[j]))
                yield i, j

    def run(table: pa.Table) -> pa.Table:
        sets = shingle_sets(Words(table.column("text").to_pylist(), lower=True), shingle) if shingle else None
        regs = np.stack([np.frombuffer(r, np.uint16) for r in table.column("registers").to_pylist()])
        node, group, comp, block, size, cross = (np.asarray(table.column(c).to_pylist()) for c in ("node", "group", "comp", "block", "n_shingles", "cross"))
        out: list[tuple[int, int]] = []
        order = np.lexsort((node, group))
        for rows in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
            own = (size[rows], regs[rows], comp[rows], block[rows] if cross[rows[0]] else None)
            pairs = by_sets(*own, [sets[r] for r in rows]) if sets else by_registers(*own)
            out += ((int(node[rows[i]]), int(node[rows[j]])) for i, j in pairs)
        u, v = zip(*out, strict=True) if out else ((), ())
        tidy()
        return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


#: so many rows of one key are no burden for a task
FEW = 1 << 16
#: edges that a task joins at once
EDGES = 1 << 17


def _met(rows: DataFrame, facts: DataFrame, key: list[str], total: int) -> DataFrame:
    """rows joined with facts, which has one row a key and says in n how many of `total` rows have it.

    Keys of more than 1/4096 of the rows (so at most 4095, whose hashes come to the driver) are dealt to 64 tasks each.
    """
    mark = F.xxhash64(*key)
    hot = [r[0] for r in facts.filter((_c("n") * 4096 > F.lit(total)) & (_c("n") > FEW)).select(mark).collect()] if total > FEW else []
    if not hot:
        return rows.join(facts, key)
    often = mark.isin(hot)
    rows = rows.withColumn("salt", F.when(often, F.pmod(F.xxhash64(*rows.columns), F.lit(64))).otherwise(0).cast("int"))
    return rows.join(facts.withColumn("salt", F.explode(F.when(often, F.sequence(F.lit(0), F.lit(63))).otherwise(F.array(F.lit(0))))), [*key, "salt"]).drop("salt")


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets = _Sets()
    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sets.join(u, v)
    found = [(x, r) for x in sets.up if (r := sets.find(x)) != x]
    u, v = zip(*found, strict=True) if found else ((), ())
    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """node, label (smallest node reachable) for undirected edges (u, v); nodes without edges are not listed.

    About EDGES edges at a time are joined within a task. If that leaves more than one task, large-star and small-star steps alternate, each an aggregation and a join; the edges stay as many as the nodes or
    fewer, whatever a component's size, and each round is written to the checkpoint folder. The hub of a large component fills no task.
    """
    now = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    total = now.count()
    parts = 1 + total // EDGES
    now = now.coalesce(parts).mapInArrow(_contracted, "u long, v long")
    if parts == 1:
        now = cut(now)
        return now.select(_c("u").alias("node"), _c("v").alias("label")).unionByName(now.select(_c("v").alias("node"), _c("v").alias("label")).distinct())
    now = cut(now.distinct())
    while True:
        both = now.unionByName(now.select(_c("v").alias("u"), _c("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.least(F.min("v"), _c("u")).alias("m"), F.count_if(_c("v") > _c("u")).alias("n"), F.count_if(_c("v") < _c("u")).alias("below")))
        if least.filter("below > 1 or (below = 1 and n > 0)").isEmpty():  # stars alone
            return least.select(_c("u").alias("node"), _c("m").alias("label"))
        large = _met(both.filter("v > u"), least, ["u"], total).select(_c("v").alias("u"), _c("m").alias("v")).filter("u <> v")
        # smaller neighbours of a node are few after the first step: a large component's hub has none
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(_c("v").alias("u"), _c("m").alias("v"))
        now = cut(small.unionByName(least.select("u", _c("m").alias("v"))).distinct())


def _dealt(rows: DataFrame, block_rows: int, block_bytes: int) -> DataFrame:
    """Rows (group, comp, node, bytes and more) dealt to tasks so that each pair of a group with different comp meets once.

    The members of a comp that fills a block get blocks of their own, which never meet one another; the small comps of a group share
    blocks. A task holds two blocks, or several small groups. A row goes to as many tasks as its group has blocks of
    other comps.
    """
    filled = lambda n, size: F.ceil(F.greatest(n / F.lit(block_rows), size / F.lit(block_bytes))).cast("int")
    comps = rows.groupBy("group", "comp").agg(F.count("*").alias("n"), F.sum("bytes").alias("size"))
    comps = comps.withColumn("large", (_c("n") >= block_rows) | (_c("size") >= block_bytes)).withColumn("parts", F.when(_c("large"), filled(_c("n"), _c("size"))).otherwise(0))
    groups = comps.groupBy("group").agg(F.sum(F.when(~_c("large"), _c("n")).otherwise(0)).alias("few"), F.sum(F.when(~_c("large"), _c("size")).otherwise(0)).alias("light"), F.sum("parts").alias("own"), F.count("*").alias("comps"))
    groups = groups.filter("comps > 1").select("group", filled(_c("few"), _c("light")).alias("shared"), "own")
    before = F.sum("parts").over(Window.partitionBy("group").orderBy("comp").rowsBetween(Window.unboundedPreceding, -1))
    ranges = comps.filter("large").select("group", "comp", F.coalesce(before, F.lit(0)).cast("int").alias("skip"))
    facts = cut(comps.join(groups, "group").join(ranges, ["group", "comp"], "left").select("group", "comp", "n", "size", "large", "parts", "shared", "skip", (_c("shared") + _c("own")).cast("int").alias("blocks")))
    total, size = facts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    low = F.when(_c("large"), _c("shared") + _c("skip"))
    met = _met(rows, facts, ["group", "comp"], total).withColumn("low", low)
    block = F.when(_c("large"), _c("low") + F.pmod(F.xxhash64("node"), _c("parts"))).otherwise(F.pmod(F.xxhash64("comp"), F.greatest(_c("shared"), F.lit(1)))).cast("int")
    others = F.filter(F.sequence(F.lit(0), _c("blocks") - 1), lambda o: F.coalesce((o < _c("low")) | (o >= _c("low") + _c("parts")), F.lit(True)))
    met = met.withColumn("block", block).withColumn("other", F.explode(others))
    alone = F.concat(F.lit("s"), F.pmod(F.xxhash64("group"), F.lit(1 + size // block_bytes)).cast("string"))
    pair = F.concat_ws("_", "group", F.least("block", "other"), F.greatest("block", "other"))
    task = F.when(_c("blocks") == 1, alone).otherwise(pair).alias("task")
    return met.select(*rows.columns, "block", task, (_c("block") != _c("other")).alias("cross"))


def _text_key() -> Column:
    return F.xxhash64(F.coalesce(_c("text").cast("string"), F.lit(""))).alias("text_key")


def links(docs: DataFrame, reps: DataFrame, bands: int, rows: int, shingle: int, percent: int, block_docs: int = 256, block_bytes: int = 4 << 20, block_registers: int = 2048) -> DataFrame:
    """Confirmed links (u, v) between different sets, enough of them to join all that links join."""
    count, width = bands * rows, 2 * rows
    keys = F.array(*(F.xxhash64(F.lit(i), F.substring("registers", i * width + 1, width)) for i in range(bands)))
    banded = reps.select("node", F.explode(keys).alias("band"))
    groups = cut(banded.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("top"), F.count("*").alias("n")).filter("hub <> top").select("band", "hub", "n"))
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tied = cut(_met(banded, groups, ["band"], total).select("node", "band", "hub"))
    shared = tied.filter("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("shared"))
    most = F.max(F.struct("shared", F.bitwise_not("hub").alias("hub")))
    parent = cut(shared.groupBy("node").agg(most.alias("most")).select("node", F.bitwise_not("most.hub").alias("hub")))
    member = reps.join(tied.select("node").distinct(), "node").select("node", "text_key", "registers", "n_shingles", "n_bytes")
    texts = docs.select(_c("doc_id").alias("node"), _text_key(), _c("text").cast("binary").alias("text")).join(member, ["node", "text_key"])
    texts = cut(texts.groupBy("node", "text_key").agg(*(F.any_value(c).alias(c) for c in ("text", "registers", "n_shingles", "n_bytes"))))

    # Each member with the hub it shares most bands with; a hub's text goes to each block of its members.
    stars = parent.join(texts.select("node", "n_bytes"), "node").groupBy("hub").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("bytes"))
    stars = cut(stars.select("hub", "n", "bytes", F.ceil(F.greatest(_c("n") / block_docs, _c("bytes") / block_bytes)).cast("int").alias("blocks")))
    members, size = stars.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    alone = F.concat(F.lit("s"), F.pmod(F.xxhash64("hub"), F.lit(1 + size // block_bytes)).cast("string"))
    task = lambda block: F.when(_c("blocks") == 1, alone).otherwise(F.concat_ws("_", "hub", block)).alias("task")
    sent = _met(parent, stars, ["hub"], members).select("node", "hub", task(F.pmod(F.xxhash64("node"), _c("blocks"))))
    hubs = stars.withColumn("block", F.explode(F.sequence(F.lit(0), _c("blocks") - 1))).select(_c("hub").alias("node"), "hub", task(_c("block")))
    work = sent.unionByName(hubs).join(texts.select("node", "text"), "node")
    first = cut(work.groupBy("task").applyInArrow(_held_against_hub(shingle, percent), "u long, v long"))
    label = components(first)

    # Bands whose members are not all joined: registers alone, between members that are not joined.
    now = tied.join(label, "node", "left").select("node", "band", F.coalesce("label", "node").alias("comp"))
    sizes = now.groupBy("band").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.count("*").alias("n")).filter("a <> b").select("band", "n")
    large = label.groupBy(_c("label").alias("comp")).agg(F.count("*").alias("n")).filter(_c("n") >= block_docs).select("comp", F.lit(True).alias("large"))
    sizes = cut(sizes)
    unlike = cut(_met(now, sizes, ["band"], total).drop("n").join(large, "comp", "left"))
    # Small comps meet band by band; a large one meets, once and not by band, those that it shares a band with.
    few = unlike.filter("large is null").select(F.xxhash64(F.lit("band"), "band").alias("group"), "comp", "node")
    hosts = unlike.filter("large").groupBy("band").agg(F.collect_set("comp").alias("hosts"))  # at most one in block_docs of the band's rows
    guest = _met(unlike, sizes.join(hosts, "band"), ["band"], total).withColumn("host", F.explode("hosts"))
    guest = guest.filter((_c("comp") != _c("host")) & (_c("large").isNull() | (_c("comp") > _c("host"))))
    of = lambda host, comp: (F.xxhash64(F.lit("comp"), host).alias("group"), F.lit(comp).cast("long").alias("comp"), _c("node"))
    once = guest.select(*of("host", 1)).unionByName(unlike.filter("large").select(*of("comp", 0))).distinct()
    unlike = few.unionByName(once).join(texts.select("node", "registers", "n_shingles", F.lit(1).alias("bytes")), "node")
    likely = components(_dealt(unlike, block_registers, block_registers).groupBy("task").applyInArrow(_compared(percent, count, None), "u long, v long"))

    # Documents with a candidate, with their texts.
    again = likely.select("node", _c("label").alias("group")).join(label, "node", "left").select("node", "group", F.coalesce("label", "node").alias("comp"))
    again = again.join(texts.select("node", "text", "registers", "n_shingles", _c("n_bytes").alias("bytes")), "node")
    second = _dealt(again, block_docs, block_bytes).groupBy("task").applyInArrow(_compared(percent, count, shingle), "u long, v long")
    return label.select(_c("node").alias("u"), _c("label").alias("v")).unionByName(second)


def classes(docs: DataFrame, shingle: int = 3, percent: int = 85, **blocks: int) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id for every input row.

    component_id is the smallest doc_id that confirmed links reach. Texts with fewer words than a shingle are one
    shingle; null and empty texts have no shingle and link with nothing. Equal sets of different texts are linked like
    any other. Rows with equal doc_id count as one document. A row with a null doc_id links with nothing and has a null
    component_id. Extra columns are ignored; an empty table gives no rows. Texts of any length are read whole.
    `blocks` are the block sizes of `links`.
    """
    bands, rows = shape(percent)
    sig = cut(text_rows(docs, _text_key()).mapInArrow(_signatures(shingle, bands * rows), "doc_id long, text_key long, set_key binary, n_shingles long, n_bytes long, registers binary"))
    usable = sig.filter("set_key is not null and doc_id is not null")
    reps = usable.groupBy("set_key").agg(F.min(F.struct("doc_id", "text_key")).alias("r"), *(F.max(c).alias(c) for c in ("registers", "n_bytes", "n_shingles")))
    reps = cut(reps.select("set_key", _c("r.doc_id").alias("node"), _c("r.text_key").alias("text_key"), "registers", "n_bytes", "n_shingles"))
    linked = components(links(docs, reps, bands, rows, shingle, percent, **blocks))
    of = reps.select("set_key", "node").join(linked, "node", "left").select("set_key", F.coalesce("label", "node").alias("component"))
    out = sig.select("doc_id", "text_key", "n_shingles", "set_key").join(of, "set_key", "left")
    return out.select("doc_id", "text_key", "n_shingles", F.when(_c("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay when each class keeps the one with the smallest id; a row with a null id stays."""
    drop = classes(docs, shingle, percent).filter("doc_id <> component_id").select("doc_id", "text_key").distinct()
    return docs.select("doc_id", _text_key(), whole_row(docs)).join(drop, ["doc_id", "text_key"], "left_anti").select("row.*")
