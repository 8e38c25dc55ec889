import collections
import hashlib
import math
import random
import re
import textwrap
import time
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from starlens.llm import common, decontam, langid, license, lm, mixing, neardup, packing, quality, queries, sharding, substring, toxicity, variants, vectorcode

from ..support import rows_of, same

PASSAGE = " ".join(f"shared{k}" for k in range(60))
LETTERS = "bcdfghjklm"
LONG = " ".join("".join(LETTERS[int(d)] for d in str(k)) + "a" for k in range(120_000))
#: id, text, lang: nulls, blanks, a long text, copies, repeated rows, marks only
NASTY = [
    (1, None, "en"), (2, "", "en"), (3, " \t\n ", None), (4, "...!!! ###", "de"), (5, LONG, "en"), (6, PASSAGE, "en"), (7, "before " + PASSAGE + " after", "en"), (7, "before " + PASSAGE + " after", "en"),
    (None, PASSAGE, "en"), (8, "one", "fr"), (9, "one", "fr"), (10, "One  TWO", None), (11, "日本語 テキスト x", "ja"), (12, PASSAGE.upper(), "en"),
]
EXTRA = "row key n_words spans items kept text_key family label word n shard size bucket failed_bits score item_id".split()


def nasty(spark, rows=NASTY):
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, n_chars long")
    return df.withColumns({c: F.lit(f"extra {c}") for c in EXTRA})


def bench(spark, rows=((1, " ".join(PASSAGE.split()[5:25])), (2, "one"), (3, None), (4, ""), (5, "one"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, sf_dir, name):
    same(queries.QUERIES[name](spark, sf_dir), queries.ORACLES[name], sf_dir)


def test_quality_on_odd_rows(spark):
    led = quality.apply_policy(quality.ledger(nasty(spark)))
    got = {r.doc_id: r for r in led.collect()}
    assert led.count() == len(NASTY)
    assert got[1].n_words == got[2].n_words == got[3].n_words == 0 and got[1].base_failed
    assert got[5].n_words == 120_000 and got[5].kept and got[4].n_symbols == 3
    assert quality.filter_documents(nasty(spark)).columns == nasty(spark).columns
    assert quality.filter_documents(nasty(spark).limit(0)).count() == 0


def test_ablations_follow_the_bits(spark, sf_dir):
    led = quality.ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    bits = [r.failed_bits & quality.mask("v1") for r in led.collect()]
    names = list(quality.rules())
    for r in quality.ablations(led).collect():
        b = 1 << names.index(r.rule)
        assert (r.failed, r.failed_alone, r.kept_without) == (sum(x & b > 0 for x in bits), sum(x == b for x in bits), sum(x & ~b == 0 for x in bits))


@pytest.mark.parametrize("block", [16 << 20, 40])
def test_decontamination_on_odd_rows_and_in_blocks(spark, block):
    got = collections.defaultdict(list)
    for r in decontam.find(nasty(spark), bench(spark), block_bytes=block).collect():
        got[r.row.doc_id].append((r.n_words, sum(s.end - s.first for s in r.spans), list(r["items"])))
    assert got[6] == [(60, 20, [1])] and got[7] == [(62, 20, [1])] * 2 and got[12] == [(60, 20, [1])]
    assert got[8] == [(1, 1, [2, 5])] and got[10] == [(2, 1, [2, 5])] and got[1] == [(0, 0, [])]
    clean = decontam.decontaminate(nasty(spark), bench(spark))
    assert clean.columns == nasty(spark).columns and {r.doc_id for r in clean.select("doc_id").collect()} == {1, 2, 3, 4, 5, 11}
    assert decontam.decontaminate(nasty(spark), bench(spark, [])).count() == len(NASTY)


@pytest.mark.parametrize("block", [16 << 20, 40])
def test_items_without_id_and_longest_match(spark, block):
    items = bench(spark, [(None, "one"), (None, " ".join(PASSAGE.split()[5:25])), (3, " ".join(PASSAGE.split()[20:35])), (None, None)])
    got = {r.row.doc_id: (list(r["items"]), r.longest) for r in decontam.find(nasty(spark), items, block_bytes=block).collect()}
    assert got[6] == ([None, 3], 20) and got[8] == ([None], 1) and got[1] == ([], 0)
    assert decontam.find(nasty(spark).limit(0), items).count() == 0
    assert {r.item_id for r in decontam.longest_matches(nasty(spark), items, block_bytes=block).collect()} == {None, 3}


def test_suffix_array_against_brute_force():
    rng = random.Random(3)
    for _ in range(20):
        words = [rng.choice("abc") for _ in range(rng.randint(1, 60))]
        item = [rng.choice("abc") for _ in range(rng.randint(1, 12))]
        b = decontam.Benchmark([(1, " ".join(item).encode())], 4)
        got = decontam.Shard([" ".join(words).encode()], b).lookup(b)
        for k in range(len(item)):
            want = max((n for n in range(len(item) - k + 1) if any(words[i : i + n] == item[k : k + n] for i in range(len(words) - n + 1))), default=0)
            assert got["length"][k] == want or want < b.shortest


def test_longest_matches(spark):
    r = decontam.longest_matches(nasty(spark).filter("doc_id = 7"), bench(spark)).filter("item_pos = 0 and item_id = 1").collect()
    assert {(x.doc_pos, x.length) for x in r} == {(6, 20)}


def test_shards(spark):
    docs = nasty(spark, [*NASTY, *((100 + k, "hot text", "en") for k in range(600)), *((2000 + k, f"text {k} " + "y" * (k % 97), "en") for k in range(900))])
    rows = sharding.assign(docs.filter("doc_id <> 5 or doc_id is null"), 4).collect()
    assert len(rows) == len(NASTY) - 1 + 1500
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    for r in by.values():
        assert sorted(x.slot for x in r) == list(range(len(r)))
    sizes = [sum(x.size for x in r) for r in by.values()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) < 0.1 * sum(sizes)
    assert next(r for r in rows if r.doc_id == 1)[1:3] == (1, 0)
    assert sharding.assign(docs.limit(0), 4).count() == 0


def test_shards_against_plain_python(spark, sf_dir):
    rows = queries.op4_sampled_splitters(spark, sf_dir).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    sums, slots, homes = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for r in rows:
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]), "bytes", None)
        sums[r.shard] += r["size"]
        slots[r.shard].append((r.slot, r.text_crc32))
        homes[texts[r.doc_id]].add(r.shard)
    assert set(sums) <= set(range(16)) and max(sums.values()) < sum(sums.values()) / 16 + 2 * max(map(len, texts.values()))
    assert all(sorted(k for k, _ in x) == list(range(len(x))) for x in slots.values())
    assert sum(len(h) > 1 for h in homes.values()) <= 16


def test_written_shards_keep_every_row(spark, tmp_path):
    docs = nasty(spark, [*NASTY, *((None, "same", None) for _ in range(50))]).drop("bucket").withColumn("slot", F.lit(None).cast("string"))
    sharding.write_shards(docs, f"{tmp_path}/out", 3)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert set(back.columns) == {*docs.columns, "shard_", "slot_"}
    plain = lambda df: sorted(map(str, df.select(docs.columns).collect()))
    assert plain(back) == plain(docs)
    for r in back.groupBy("shard_").agg(F.count("*").alias("n"), F.countDistinct("slot_").alias("d"), F.max("slot_").alias("m")).collect():
        assert r.n == r.d == r.m + 1
    sharding.write_shards(docs.limit(0), f"{tmp_path}/none", 3)


def test_packing(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = nasty(spark)
    rows = packing.pack(docs.dropDuplicates(["doc_id"]).filter("doc_id is not null"), path).collect()
    tok, texts = Tokenizer.from_file(path), {r.doc_id: r.text or "" for r in docs.collect()}
    of, seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r), seq[r.sequence_id].append(r)
    for k, pieces in of.items():
        ids, at = [*tok.encode(texts[k], add_special_tokens=False).ids, 1], 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.asarray(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    assert packing.pack(docs.limit(0), path).count() == 0


def test_differencing_is_near_equal_and_count_rises():
    rng = random.Random(1)
    sizes = [rng.randint(1, 256) for _ in range(200)]
    sums = [sum(sizes[i] for i in w) for w in packing.difference(sizes, 10)]
    assert sum(sums) == sum(sizes) and max(sums) - min(sums) < 40
    assert len(packing.windows_of([60, 60, 60], 100)) == 3


def test_words_of_the_tokenizer():
    t = packing.WordTokens(public_tokenizers.path("word_bpe_49k.json"), most=20)
    for text in ("It's don't'S x'll. 'S '", "İstanbul ΣΑΣ ß ª é́ ﬁ ÀÉ!! naïve...", "a1b2 3.5% <|endoftext|> x<|endoftext|>y", "日本語 ＡＢ", "", "c\x1cd e f", "many other words so that a generation is forgotten again and again"):
        words = text.encode().split()
        t.learn(set(words))
        assert np.asarray(t.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() == t.encode(words)


def test_passages_on_odd_rows(spark):
    got = collections.defaultdict(list)
    for r in substring.remove_repeats(nasty(spark)).collect():
        got[r.row.doc_id].append((r.n_words, r.n_removed, bytes(r.kept).decode()))
    assert got[6][0][1] == 0 and got[7] == [(62, 60, "before after")] * 2 and got[None][0][1] == 0 and got[12][0][1] == 0 and got[1] == [(0, 0, "")]
    out = substring.rewrite(nasty(spark))
    assert out.columns == nasty(spark).columns and out.filter("doc_id = 7").first().n_chars == 12
    assert substring.rewrite(nasty(spark).limit(0)).count() == 0


def test_passages_across_batches(spark):
    rng = random.Random(5)
    rows = []
    for k in range(300):
        w = [rng.choice("abcdefgh") + str(rng.randint(0, 400)) for _ in range(80)]
        if k % 3 == 0:
            at = rng.randint(0, 60)
            w[at:at] = PASSAGE.split()[: rng.randint(10, 40)]
        rows.append((k, " ".join(w), "en"))
    first = {}
    for k, t, _ in rows:
        w = t.split()
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i : i + 13]), k)
    want = {}
    for k, t, _ in rows:
        w = t.split()
        gone = {j for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < k for j in range(i, i + 13)}
        want[k] = len(gone)
    docs = nasty(spark, rows).repartition(7, "doc_id")
    assert {r.row.doc_id: r.n_removed for r in substring.remove_repeats(docs).collect()} == want


def test_word_that_many_texts_share_fills_no_bucket(spark):
    rng = random.Random(8)
    rows, passage = [], [f"p{k}" for k in range(30)]
    for k in range(1500):
        w = [f"{rng.randint(0, 10**6)}" for _ in range(40)]
        if k % 3 == 0:
            w[20:20] = ["https://example.org/one-signature-of-a-source"]
        if k % 30 == 0:
            w[15:25] = [*passage[: 15 + k % 7], "https://example.org/one-signature-of-a-source", *passage[15:]]
        rows.append((k, " ".join(w), "en"))
    first, want = {}, {}
    for k, t, _ in rows:
        w = t.split()
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i : i + 13]), k)
    for k, t, _ in rows:
        w = t.split()
        want[k] = {j for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < k for j in range(i, i + 13)}
    docs = nasty(spark, rows).repartition(5, "doc_id")

    def largest(**most):
        size = collections.Counter()
        for r in substring.send(docs, 13, 2000, **most).filter("not settled").collect():
            size[r.bucket] += len(substring._unpacked(bytes(r.blob))[1])
        return max(size.values())

    assert largest(most=10**9) > 80_000 and largest() < 16_000
    got = collections.defaultdict(set)
    for r in substring.repeated_spans(docs, bucket_bytes=2000).collect():
        got[r.doc_id] |= set(range(r.first, r.end))
    assert {k: got[k] for k in want} == want and any(want.values())


def test_near_duplicates_on_odd_rows(spark):
    got = {(r.doc_id, r.component_id, r.n_shingles) for r in neardup.classes(nasty(spark)).collect()}
    assert {(6, 6, 58), (12, 6, 58), (7, 6, 60), (8, 8, 1), (9, 8, 1), (1, 1, 0), (2, 2, 0), (None, None, 58)} <= got
    assert {r.doc_id for r in neardup.keep_one(nasty(spark)).collect()} == {1, 2, 3, 4, 5, 6, 8, 10, 11, None}
    assert neardup.keep_one(nasty(spark).limit(0)).count() == 0


@pytest.mark.parametrize("few", [neardup.FEW, 4])
def test_large_family_in_blocks_against_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(neardup, "FEW", few)
    monkeypatch.setattr(neardup, "EDGES", 8 * few)
    rng = random.Random(2)
    base = [f"v{k}" for k in range(200)]
    rows = []
    for k in range(120):
        w = list(base)
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = f"z{rng.random()}"
        rows.append((k, " ".join(w), "en"))
    sets = {k: {tuple(t.split()[i : i + 3]) for i in range(198)} for k, t, _ in rows}
    up = {k: k for k in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    got = {r.doc_id: r.component_id for r in neardup.classes(nasty(spark, rows), block_docs=16, block_registers=24).collect()}
    assert got == {k: find(k) for k in sets}


def test_each_pair_of_different_comps_meets_once(spark):
    rng = random.Random(4)
    rows = [(g, (0 if k % 3 else k) + 1000 * g, 10_000 * g + k, rng.randint(1, 9)) for g, n in ((1, 90), (2, 3), (3, 40)) for k in range(n)] + [(4, 4000, 40_000 + k, 1) for k in range(50)]
    met = collections.defaultdict(list)
    for r in neardup._dealt(spark.createDataFrame(rows, "group long, comp long, node long, bytes long"), 8, 10**6).collect():
        met[r.group, r.task].append(r)
    seen = collections.Counter()
    for part in met.values():
        for k, x in enumerate(part):
            seen.update(tuple(sorted((x.node, y.node))) for y in part[k + 1 :] if x.comp != y.comp and (not x.cross or x.block != y.block))
        assert len(part) <= 60
    want = {tuple(sorted((x[2], y[2]))) for k, x in enumerate(rows) for y in rows[k + 1 :] if x[0] == y[0] and x[1] != y[1]}
    assert set(seen) == want and set(seen.values()) == {1}


def test_texts_that_share_much_but_not_enough_are_not_sent_again(spark, monkeypatch):
    rng, sent = random.Random(6), []
    rows = [(k, " ".join([f"b{x}" for x in range(85)] + [f"u{rng.random()}" for _ in range(63)]), "en") for k in range(300)]
    compared = neardup._compared
    monkeypatch.setattr(neardup, "_compared", lambda percent, count, shingle: sent.append(shingle) or compared(percent, count, shingle))
    dealt = neardup._dealt
    monkeypatch.setattr(neardup, "_dealt", lambda *a: sent.append(dealt(*a)) or sent[-1])
    assert neardup.classes(nasty(spark, rows)).filter("doc_id <> component_id").count() == 0
    assert sent[1] is None and sent[3] == 3 and sent[2].count() == 0 and sent[0].count() > 0


def test_register_estimate():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 3000).astype(np.uint64)
    regs = neardup.registers([x[:2000], x[500:2500]], 600)
    j = neardup.estimate((regs[0] == regs[1]).sum(), 600, neardup.chance(2000, 2000))
    assert abs(j - 0.6) < 0.08


def test_language(spark, sf_dir):
    got = queries.op1_language_id(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) > 0.95 * len(got)
    docs = nasty(spark)
    rows = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs)).collect()}
    assert rows[1].lang_pred == rows[2].lang_pred == rows[4].lang_pred == "und" and rows[8].lang_pred == "fr"
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(docs.limit(0))).collect()} == {"und"}


def test_language_against_plain_nearest_centroid(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.fit(docs)
    rows = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    for d in docs.collect():
        r, text = rows[d.doc_id], (d.text or "").encode()
        if not any(map(str.isalpha, d.text or "")):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        grams = collections.Counter()
        plain = b" ".join([b"", *(d.text if d.text.isascii() else d.text.lower()).encode().translate(langid._GAP).split(), b""])
        for n in range(1, 5):
            grams.update((((int.from_bytes(plain[i : i + n], "big") + n) * 0x9E3779B1) & 0xFFFFFFFF) >> 20 for i in range(len(plain) - n + 1))
        v = np.zeros(langid.FEATURES)
        for g, n in grams.items():
            v[g] = math.log1p(n) * model.idf[g]
        cos = model.centroids @ (v / np.linalg.norm(v))
        best = [max(c for c, l in zip(cos, model.language_of, strict=True) if l == k) for k in range(len(model.languages))]
        assert model.languages[int(np.argmax(best))] == r.lang_pred or np.ptp(np.sort(best)[-2:]) < 1e-5
        assert math.isclose(r.score, 1 / sum(math.exp(30 * (b - max(best))) for b in best), abs_tol=1e-3)
    assert langid.predict(docs.limit(0), model).count() == 0


def test_language_sample_counts_copies_once_and_keeps_each_language(spark):
    words = {"aa": "uno dos tres", "bb": "eins zwei drei", "cc": "yksi kaksi kolme", "dd": "ichi ni san", "ee": "satu dua tiga", "ff": "moja mbili tatu"}
    rows = [(k, f"{words[x]} {'x' * (k % 3)}", x) for x in words for k in range(900)] + [(k, f"one two three {'y' * k}", "gg") for k in range(400)] + [(k, f"... {k}", "aa") for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = collections.Counter(r.lang for r in langid.sample(docs, 40).collect())
    assert all(got[x] == 3 for x in words) and 15 < got["gg"] < 80  # 40 are expected
    few = collections.Counter(r.lang for r in langid.sample(docs, 1).collect())
    assert set(few) == {*words, "gg"} and max(few.values()) <= 8
    assert langid.fit(docs, per_language=1).languages == sorted(set(few))


def test_toxicity_against_plain_nearest_neighbours(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    index = toxicity.fit(docs, labels)
    own, _ = toxicity.examples(docs, labels)
    tf = {e[0]: collections.Counter() for e in own}
    for i, _, ws, times in own:
        for w, c in zip(ws.split(), times.tolist(), strict=True):
            tf[i].update(dict.fromkeys(toxicity.terms(w), 0))
            for t in toxicity.terms(w):
                tf[i][t] += c
    df = collections.Counter(t for d in tf.values() for t in d)
    label = {e[0]: e[1] for e in own}
    n1, n0 = sum(label.values()), sum(1 - y for y in label.values())
    weight = {}
    for t, n in df.items():
        if n > 1:
            x, m = sum(label[i] for i in tf if t in tf[i]), n / len(tf)
            chi = (x / n1 - (n - x) / n0) ** 2 / max(m * (1 - m), 1e-12) * n1 * n0 / len(tf)
            weight[t] = math.log(1 + len(tf) / n) * (chi + 1e-3) / (chi + toxicity.HALF)

    def vector(d):
        v = {t: (1 + math.log(c)) * weight[t] for t, c in d.items() if t in weight}
        size = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {t: x / size for t, x in v.items()}

    vectors = {i: vector(d) for i, d in tf.items()}
    texts = {r.doc_id: r.text for r in docs.limit(60).collect()}
    rows = {r.doc_id: r for r in toxicity.score(docs.filter(F.col("doc_id").isin(list(texts))), index, evidence=15).collect()}
    for k, text in texts.items():
        d = collections.Counter(t for w in decontam.words((text or "").encode()) for t in toxicity.terms(w))
        mine = vector(d)
        cos = {i: sum(x * v.get(t, 0.0) for t, x in mine.items()) for i, v in vectors.items()}
        best = sorted((x for x in cos.values() if x > 0), reverse=True)[:15]
        near = [cos[i] for i in rows[k].evidence]
        assert np.allclose(near, best) and len(near) == len(best)
        votes = [(cos[i], label[i], index.weight[np.flatnonzero(index.ids == i)[0]]) for i in rows[k].evidence]
        total = sum(c * c * w for c, _, w in votes)
        raw = sum(c * c * w for c, y, w in votes if y) / (total + 1e-9) * best[0] ** 0.25 if best else -1.0
        assert math.isclose(rows[k].score, index.score(raw), abs_tol=1e-9)


def test_toxicity_on_odd_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    index = toxicity.fit(docs, labels)
    got = toxicity.score(nasty(spark), index).collect()
    assert len(got) == len(NASTY) and all(0 <= r.score <= 1 for r in got) and len({r.score for r in got if r.doc_id == 7}) == 1
    for none in (toxicity.fit(docs, labels.limit(0)), toxicity.fit(docs.limit(0), labels)):
        assert {r.score for r in toxicity.score(nasty(spark), none).collect()} == {0.0}
    assert toxicity.score(nasty(spark).limit(0), index).count() == 0
    clash = spark.createDataFrame([(6, 0), (6, 1), (7, 0), (8, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    own, weight = toxicity.examples(nasty(spark), clash)
    assert [e[:2] for e in own] == [(6, 1), (7, 0)] and own[0][2].split() == PASSAGE.encode().split() and weight == {0: 1.0, 1: 2.0}
    assert all(0 <= r.score <= 1 for r in toxicity.score(nasty(spark), toxicity.fit(nasty(spark), clash)).collect())


def test_language_model(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: (r.text or "") for r in docs.collect()}
    words = lambda t: t.encode().translate(lm.LOWER).split()
    train = [k for k in texts if zlib.crc32(str(k).encode()) % 7 != 2]
    c = collections.Counter(w for k in train for w in [*words(texts[k]), None])
    n, v = sum(c.values()), len(c)
    rows = queries.op5_language_model(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ws = [*words(texts[r.doc_id]), None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    odd = lm.train_and_score(nasty(spark), nasty(spark).limit(0)).collect()
    assert len(odd) == len(NASTY) and all(r.base_score == 0 for r in odd)
    assert lm.train_and_score(nasty(spark).limit(0), nasty(spark)).count() == 0


def test_language_model_scores_against_plain_numpy(spark, sf_dir, monkeypatch):
    made = []
    known_words, log_sums = lm.known_words, lm.Net.log_sums
    monkeypatch.setattr(lm, "known_words", lambda *a: made.append(known_words(*a)) or made[-1])
    monkeypatch.setattr(lm.Net, "log_sums", lambda net: made.append(net) or log_sums(net))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: (r.text or "").encode().translate(lm.LOWER).split() for r in docs.collect()}
    train = [k for k in texts if zlib.crc32(str(k).encode()) % 7 != 2]
    rows = {r.doc_id: r.score for r in queries.op5_language_model(spark, sf_dir).collect()}
    known, net = made
    c = collections.Counter(w for k in train for w in texts[k])
    head = {w: i for i, (w, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[: known.head])}
    rest = collections.defaultdict(list)
    for w, n in c.items():
        if w not in head:
            rest[lm._ending(w)].append(n)
    p = {e: min(0.9, (ns.count(1) + 1) / (sum(ns) + 2)) for e, ns in rest.items()}
    total, at = 0.0, lambda k, ws: len(head) + lm.ENDINGS + 1 if k < 0 else head.get(ws[k], len(head) + lm._ending(ws[k]))
    for k in [*[k for k in texts if texts[k]][:12], *[k for k in texts if not texts[k]][:2]]:
        ws, score = texts[k], 0.0
        for i in range(len(ws) + 1):
            v = net.near[at(i - 1, ws)].astype(float) + net.far[known.far[at(i - 2, ws)]]
            s = net.target.astype(float) @ v + net.bias
            u = len(head) + lm.ENDINGS if i == len(ws) else at(i, ws)
            score += (s[u] - s.max() - math.log(np.exp(s - s.max()).sum())) / math.log(10)
            if i < len(ws) and ws[i] not in head:
                e = lm._ending(ws[i])
                score += math.log10(c[ws[i]] / sum(rest[e]) * (1 - p[e])) if c[ws[i]] else math.log10(p.get(e, 1.0))
        assert math.isclose(rows[k], score, rel_tol=1e-4, abs_tol=1e-3)
        total += score
    # all known words and one unseen word per ending share out what the network gives
    assert math.isclose(sum(c[w] / sum(rest[e]) * (1 - p[e]) for w in c if w not in head for e in [lm._ending(w)]) + sum(p.values()), len(rest))
    # the trained network, not the counts alone
    flat = lm.Net(known)
    flat.near[:], flat.far[:] = 0, 0
    held = docs.filter("crc32(cast(cast(doc_id as string) as binary)) % 7 = 2")
    w = lm.Words([r.text.encode() for r in held.collect() if r.text], lower=True)
    words, _ = known.sequence(w, known.units(w)[0])
    assert net.log10(words, *known.contexts(words), log_sums(net)).mean() > flat.log10(words, *known.contexts(words), log_sums(flat)).mean() + 0.05


def test_licences(spark):
    text = "Intro.\nThis program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as\npublished by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\nYou should have received a copy of the GNU General Public License along with this program."
    docs = nasty(spark, [*NASTY, (20, text, "en"), (21, "x\nReleased under the MIT License.\nAll rights reserved.", "en")])
    got = {r.doc_id: list(r.licences) for r in license.recognise(docs).collect()}
    assert got[21] == ["MIT"] and got[1] == [] and got[5] == []
    assert got[20] == ["GPL-3.0"]


GRANT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'
MIT = ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM.']
BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
]
BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.'
APACHE = [
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at', "    http://www.apache.org/licenses/LICENSE-2.0",
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
]


def test_whole_wrapped_licences(spark):
    right, whole = "Copyright (c) 2020 Foo Bar", {"MIT": ["MIT License", GRANT, *MIT], "BSD-2-Clause": [*BSD, BSD_END], "BSD-3-Clause": [*BSD, BSD_3, BSD_END], "Apache-2.0": APACHE}
    rows, want = [], {}
    for name, parts in whole.items():
        parts = [parts[0], right, *parts[1:]] if name == "MIT" else [right, *parts]
        for width in (78, 40):
            for margin, end in (("", "\n"), ("", "\r\n"), (" * ", "\n"), ("#" + " " * 99, "\n")):
                rows.append((len(rows), end.join(margin + x for p in parts for x in [*textwrap.wrap(p, width, break_long_words=False, break_on_hyphens=False), ""]), "en"))
                want[len(rows) - 1] = [name]
    rows.append((len(rows), "\n".join(["The MIT License (MIT)", right, "", *textwrap.wrap(GRANT, 78)]), "en"))
    rows.append((len(rows), "\n".join([right, "", *textwrap.wrap(MIT[0] + " " + MIT[1], 78), "", *textwrap.wrap(GRANT, 78)]), "en"))
    want |= {len(rows) - 2: ["MIT"], len(rows) - 1: []}
    assert {r.doc_id: list(r.licences) for r in license.recognise(nasty(spark, rows)).collect()} == want


def test_every_known_sentence_is_looked_at_and_every_licence_found(spark):
    known = license.known_sentences()
    assert all(re.search(license.TELLING_SENTENCE, s) and s == re.sub("[^a-z0-9]+", " ", s) for s in known)
    assert {i for _, rules in license.LICENCES.values() for rule in rules for i in rule} <= set(known.values())
    text = {i: s for s, i in known.items()}
    rows, want = [], {}
    for name, (_, rules) in license.LICENCES.items():
        for rule in rules:
            rows.append((len(rows), "Some words. " + " More of it! ".join(text[i].capitalize() + "." for i in rule), "en"))
            want[len(rows) - 1] = name
    got = {r.doc_id: list(r.licences) for r in license.recognise(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(name in got[k] if "listed_mit_or_apache" in str(rows[k]) or " or " in rows[k][1] else got[k] == [name] for k, name in want.items())
    other = [(0, "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", "en"), (1, "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.", "en"), (2, "Released under the GPLv3.\nThis project is licensed under the BSD 2-Clause License; see below.", "en")]
    got = {r.doc_id: list(r.licences) for r in license.recognise(spark.createDataFrame(other, "doc_id long, text string, lang string")).collect()}
    assert got == {0: [], 1: ["MPL-2.0"], 2: ["BSD-2-Clause", "GPL-3.0"]}


NOTICES = {
    "// SPDX-License-Identifier: Apache-2.0": (["Apache-2.0"], ["permissive"]), "code\n# SPDX-License-Identifier: MIT\nmore code": (["MIT"], ["permissive"]), "License: BSD-3-Clause": (["BSD-3-Clause"], ["permissive"]),
    "This code is licensed under the MIT license (see LICENSE).": (["MIT"], ["permissive"]), "All rights reserved. Licensed under the MIT License.": (["MIT"], ["permissive"]), "Copyright 2020 Foo. All rights reserved.": (["All-Rights-Reserved"], ["proprietary"]),
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.": (["GPL-2.0"], ["copyleft"]),
    "Released under the GNU General Public License version 2 only.": (["GPL-2.0"], ["copyleft"]), "SPDX-License-Identifier: MIT OR Apache-2.0": (["Apache-2.0", "MIT"], ["permissive"]), "License: to kill\nMIT is a university.": ([], []),
    "Copyright (c) 2020 Foo. All rights reserved.\n\n" + "\n".join([*BSD, BSD_3, BSD_END]): (["BSD-3-Clause"], ["permissive"]), "SPDX-License-Identifier: GPL-2.0-or-later": (["GPL-2.0"], ["copyleft"]),
}


def test_common_notices_and_their_sql(spark, tmp_path):
    texts = [*NOTICES, "\n".join(["MIT License", "", *textwrap.wrap(GRANT, 70), "", *textwrap.wrap(MIT[0], 70), "", *textwrap.wrap(MIT[1], 70)]), "\n\n".join("\n".join(textwrap.wrap(p, 60)) for p in ["x", *APACHE]), None, ""]
    rows = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (list(r.licences), list(r.classes)) for r in license.recognise(rows).collect()}
    assert [got[k] for k in range(len(NOTICES))] == list(NOTICES.values())
    assert got[len(NOTICES)] == (["MIT"], ["permissive"]) and got[len(NOTICES) + 1] == (["Apache-2.0"], ["permissive"])
    rows.coalesce(1).write.parquet(f"{tmp_path}/d")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    cur = con.execute(queries.ORACLES["op10_license_scan"])
    names = [c[0] for c in cur.description]
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    df = queries.op10_license_scan(spark, str(tmp_path))
    assert rows_of(df.columns, df.collect()) == rows_of(names, cur.fetchall())


def test_copies_of_one_row_gather_their_ranges_once(spark):
    text = " ".join(f"w{k}" for k in range(400))
    docs = spark.createDataFrame([(1, text)] + [(2, text)] * 800, "doc_id long, text string")
    began = time.time()
    got = substring.remove_repeats(docs).groupBy("row.doc_id", "n_removed").count().collect()
    assert sorted((r.doc_id, r.n_removed, r["count"]) for r in got) == [(1, 0, 1), (2, 400, 800)] and time.time() - began < 20


def _pipeline_on(spark, folder, rows, items):
    bench(spark, items).write.parquet(f"{folder}/benchmark.parquet")
    (rows if hasattr(rows, "write") else nasty(spark, rows)).write.parquet(f"{folder}/documents.parquet")
    return corpus_pipeline.run(spark, str(folder))


def test_pipeline_on_odd_rows(spark, tmp_path):
    got = _pipeline_on(spark, tmp_path / "a", NASTY, ((1, " ".join(PASSAGE.split()[5:25])), (2, "one"), (None, None)))
    assert got.select("doc_id").distinct().count() == 1  # only the long text stays
    assert _pipeline_on(spark, tmp_path / "b", nasty(spark).limit(0), ()).count() == 0


def test_pipeline_against_brute_force(spark, tmp_path):
    rng = random.Random(12)
    word = lambda: rng.choice("bcdfgklmnprst") + "".join(rng.choice("aeiou") + rng.choice("lmnrst") for _ in range(rng.randint(1, 3)))
    text = lambda n: [word() for _ in range(n)]
    shared, item = text(40), text(15)
    docs: dict[int, list[str]] = {}
    for k in range(60):
        w = text(rng.randint(30, 130))
        if k % 4 == 0:
            w[10:10] = shared[: rng.randint(10, 40)]
        if k % 9 == 1:
            w[5:5] = item[: rng.randint(8, 15)]
        if k % 7 == 3:
            w = w[:8] * 12
        if k % 10 == 5:
            w = list(docs[k - 3])
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = word()
        docs[k] = w
    rows = [(k, " ".join(w), "en") for k, w in docs.items()]

    def clean(w):
        win = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        hit = {j for i in range(len(w) - 2) if win[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        return len(w) >= 50 and 100 * len(hit) <= 50 * len(w) and 3 * len(w) <= sum(map(len, w)) <= 12 * len(w)

    left = {k: w for k, w in docs.items() if clean(w)}
    sets = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k, w in left.items()}
    up = {k: k for k in left}
    for _ in left:
        for a in left:
            for b in left:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    up[a] = up[b] = min(up[a], up[b])
    single = {k: w for k, w in left.items() if up[k] == k}
    first = {}
    for k, w in sorted(single.items()):
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i : i + 13]), k)
    cut = {k: [x for j, x in enumerate(w) if not any(first[tuple(w[i : i + 13])] < k for i in range(max(0, j - 12), min(j, len(w) - 13) + 1))] for k, w in single.items()}
    windows = {tuple(item[i : i + 10]) for i in range(len(item) - 9)}
    want = {k: w for k, w in cut.items() if not any(tuple(w[i : i + 10]) in windows for i in range(len(w) - 9))}
    assert 0 < len(want) < len(cut) < len(left) < len(docs) and any(len(cut[k]) < len(single[k]) for k in cut)
    got = collections.defaultdict(list)
    for r in _pipeline_on(spark, tmp_path, rows, [(1, " ".join(item))]).collect():
        got[r.doc_id].append(r)
    assert set(got) == set(want)
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for k, pieces in got.items():
        ids, at = [*tok.encode(" ".join(want[k]), add_special_tokens=False).ids, 1], 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.asarray(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)


def test_language_model_does_not_depend_on_partitions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sums = []
    for n in (2, 64):
        some = docs.repartition(n)
        held = F.expr("crc32(cast(cast(doc_id as string) as binary)) % 7 = 2")
        got = lm.train_and_score(some, some.filter(~held)).groupBy(held.alias("h")).agg(F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")).collect()
        sums.append({r.h: (r[1], r[2]) for r in got})
    for h in (True, False):
        assert abs(sums[0][h][0] - sums[1][h][0]) < 0.001 and sums[0][h][0] > sums[0][h][1]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit(f"extra {c}") for c in ("row", "code", "error", "vector", "entry", "part", "n", "sums")})


def brute_codes(rows, entries=256):
    """vec_id, code, error, label of the rows that have a code, and the codebooks; plain loops over integers."""
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = max(len(v) for _, v, _ in kept)
    w = max(1, -(-size // 4))
    kept = [(i, v + [0] * (4 * w - len(v)), lab) for i, v, lab in kept]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][p * w : p * w + w] for r in order] for p in range(4)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(4):
        new = []
        for p in range(4):
            got = collections.defaultdict(list)
            for _, v, _ in kept:
                got[nearest(p, v[p * w : p * w + w])[1]].append(v[p * w : p * w + w])
            new.append([[sum(c) // len(got[k]) for c in zip(*got[k], strict=True)] if k in got else e for k, e in enumerate(books[p])])
        books = new
    coded = []
    for i, v, lab in kept:
        found = [nearest(p, v[p * w : p * w + w]) for p in range(4)]
        coded.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), lab))
    return coded, books


def test_vector_codes_against_plain_loops(spark, tmp_path):
    rng = random.Random(3)
    rows = [(k, [rng.choice([-1.5, -0.25, 0.0, 0.0005, -0.0005, 0.7, 2.0]) for _ in range(8)], k % 3 if k % 5 else None) for k in range(60)]
    rows += [(60, None, 1), (61, [1.0, None] * 4, 1), (62, [math.nan] * 8, 1), (63, [math.inf, *[0.0] * 7], 1), (None, [0.5] * 8, 2), (5, rows[5][1], 1), (64, [0.25] * 3, 0), (65, [], None)]
    df = vectors(spark, rows)
    want, books = brute_codes(rows, entries=16)
    made = vectorcode.train(df, entries=16)
    assert [e.tolist() for e in made.entries] == books
    got = vectorcode.encode(df, made).select("row.vec_id", "code", "error", "row.label", "row.row")
    assert sorted(map(str, ((r.vec_id, r.code, r.error, r.label) for r in got.collect()))) == sorted(map(str, want))
    back = {r.vec_id: r.decoded for r in vectorcode.decode(got, made).filter("vec_id is not null").collect()}
    assert all(len(v) == 8 for v in back.values())
    vectors(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    full, books = brute_codes(rows)
    by = collections.Counter()
    for _, _, e, lab in full:
        by[lab] += e
    out = queries.op11_vector_codes(spark, str(tmp_path)).collect()
    assert sorted(map(str, ((r.vec_id, r.code, r.error, r.label_error) for r in out))) == sorted(str((i, c, e, by[lab])) for i, c, e, lab in full)
    assert {r.codebooks_sha256 for r in out} == {hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()}
    df.limit(0).write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert queries.op11_vector_codes(spark, f"{tmp_path}/none").count() == 0


@pytest.mark.parametrize("scale", [3, 1000, 1 << 27])
def test_tree_of_distance_ranges_finds_the_first_nearest(scale):
    rng = np.random.default_rng(scale)
    points = rng.integers(-scale, scale, (256, 3))
    points[200:] = points[:56]
    queries_ = np.concatenate([rng.integers(-scale, scale, (500, 3)), points, (points[:100] + points[100:200]) // 2])
    at, d, looked = vectorcode.Gnat(points).nearest(queries_)
    exact = ((queries_[:, None].astype(object) - points[None]) ** 2).sum(2)
    assert at.tolist() == [row.index(min(row)) for row in exact.tolist()] and d.tolist() == [min(row) for row in exact.tolist()]
    assert looked < 0.7 * len(queries_) * len(points)


def brute_mix(rows, weights=(5, 2, 1)):
    """The targets by source, after shares above twice a source's size have gone to the others."""
    size = collections.Counter()
    for _, text, source in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, full, left = {}, set(), 1.5 * sum(size.values())
    while True:
        free = [s for s in names if s not in full]
        unit = (left - sum(2 * size[s] for s in full)) / max(1, sum(w[s] for s in free))
        more = {s for s in free if w[s] * unit > 2 * size[s]}
        if not more:
            return size, {s: 2 * size[s] if s in full else w[s] * unit for s in names}
        full |= more


def test_mix_comes_near_its_targets(spark):
    rng = random.Random(8)
    rows = [(k, " ".join(["w"] * rng.choice([0, 1, 5, 40])), rng.choice(["b", "a", "é", "Z", "zz", None])) for k in range(400)]
    rows += [(1000 + k, "x " * 900, "huge") for k in range(60)] + [(7, "same words here", "copies")] * 300 + [(None, "same words", "copies")] * 200 + [(2000, None, "none"), (2001, "", "none"), (2002, "\t\n", "none"), (2003, LONG, "long"), (2004, "日本語 　x\x0by\x1cz", "odd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit(1) for c in ("key", "mark", "rest", "size", "target", "digit", "salt")})
    size, target = brute_mix(rows)
    got = mixing.mix(docs.repartition(7)).collect()
    assert len(got) == len(rows)
    taken = collections.Counter()
    for r in got:
        assert r.source_size == size[r.source] and math.isclose(r.target, target[r.source], abs_tol=1e-6) and r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    largest = collections.Counter()
    for _, t, s in rows:
        largest[s] = max(largest[s], len(re.findall(r"[^\x20\x09-\x0D]+", t or "")))
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in size)
    again = mixing.mix(docs.repartition(3)).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix(docs.limit(0)).count() == 0


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts, ratio=5):
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(((-counts[v], v) for v in near[w]), default=(0, None))
        form[w] = best[1] if best[1] and -best[0] >= ratio * n else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (n, form[w], root(w), len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def test_variants_against_all_pairs(spark):
    rng = random.Random(4)
    words = {"".join(rng.choice("abé") for _ in range(rng.choice([2, 3, 5, 6, 7, 8, 11]))) for _ in range(350)}
    words |= {"aaaaaa", "aaaaaaa", "aaaaab", "baaaaa", "xy", "a" * 4000, "a" * 4001, "a" * 2000 + "b" + "a" * 1999}
    counts = {w: rng.choice([5, 6, 25, 30, 130, 700, 4000]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: (r.n, r.form, r.root, r.n_near, r.form_n) for r in variants.group(df).collect()}
    want = brute_variants(counts)
    assert set(got) == set(want)
    assert {w: g for w, g in got.items() if g != want[w]} == {}
    assert variants.group(df.limit(0)).count() == 0


def test_words_are_misspelt_by_document(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in rows] + [(None, "Éclairage ÉCLAIRAGE×eclairs straße naïveté " * 9), (5, None), (6, ""), (7, "a" * 100_000 + " " + "Wörterbuch " * 300), (7, "repeated repeated"), (7, "repeated repeated")]
    want = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.encode().translate(lm.LOWER).decode()
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            want[w] += 1
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(2) for c in ("word", "n", "key")})
    assert {r.word: r.n for r in variants.count_words(df).collect()} == {w: n for w, n in want.items() if len(w) >= 6 and n >= 5}


@pytest.mark.parametrize("small_mb", [16, 0])
def test_facts_meet_rows_of_hot_and_null_keys(spark, small_mb):
    rows = spark.createDataFrame([(k, None if k % 7 == 0 else "hot" if k % 3 else f"s{k}") for k in range(600)], "n long, s string")
    facts = spark.createDataFrame([(s, len(s or "")) for s in {None if k % 7 == 0 else "hot" if k % 3 else f"s{k}" for k in range(600)}], "s string, size int")
    got = common.attach(rows, facts, "s", small_mb=small_mb)
    assert got.columns == ["n", "s", "size"] and sorted(tuple(r) for r in got.collect()) == sorted(((r.n, r.s, len(r.s or "")) for r in rows.collect()), key=lambda r: r[0])
    assert common.attach(rows, facts.limit(0), "s", small_mb=small_mb).count() == 0
