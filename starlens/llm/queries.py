"""The registered query of each operator and, where SQL can say it, its DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, langid, license, lm, mixing, neardup, packing, quality, sharding, substring, toxicity, variants, vectorcode
from .common import attach, crc_fold, cut, table

DOCS = "documents"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, DOCS)
    model = langid.fit(docs.filter(crc_fold("doc_id", 4) != 2))
    out = langid.predict(docs, model)
    return out.select("doc_id", (crc_fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality.apply_policy(quality.ledger(table(spark, sf_dir, DOCS)))
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_bits")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(table(spark, sf_dir, DOCS), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("row.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op4_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, DOCS))


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, DOCS)
    out = lm.train_and_score(docs, docs.filter(crc_fold("doc_id", 7) != 2))
    return out.select("doc_id", (crc_fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.remove_repeats(table(spark, sf_dir, DOCS), carry=["doc_id"])
    return cut.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.classes(table(spark, sf_dir, DOCS), shingle=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, DOCS)
    index = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(crc_fold("doc_id", 4) != 2))
    out = toxicity.score(docs, index)
    return out.select("doc_id", (crc_fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "evidence")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, DOCS), public_tokenizers.path("word_bpe_49k.json"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license.recognise(table(spark, sf_dir, DOCS))
    return found.select("doc_id", F.size("sentences").cast("long").alias("n_sentences"), F.array_join("licences", ",").alias("licences"), F.array_join("classes", ",").alias("classes"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    books = vectorcode.train(vectors)
    coded = cut(vectorcode.encode(vectors, books).select("row.vec_id", "row.label", "code", "error"))
    totals = cut(coded.groupBy("label").agg(F.sum("error").alias("label_error")))
    out = attach(coded, totals, "label")
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.sha256() if books else None).alias("codebooks_sha256"))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, DOCS)).select("doc_id", "size", "source_size", "target", "taken")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(variants.count_words(table(spark, sf_dir, DOCS)))


def _op2_sql() -> str:
    return r"""
with base as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from base),
win as (select doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] as g from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 1))) as i from w)),
rep as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as c from win) where c > 1),
cov as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i+1, i+2]) as p from rep) group by doc_id),
m as (select w.doc_id, len(ws) as n_words, len(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
  len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(cov.n, 0) as n_repeat_words,
  len(lines) as n_lines, len(regexp_replace(t, '\P{Lu}', '', 'g')) as n_upper, len(regexp_replace(t, '[^!]', '', 'g')) as n_exclaim, len(regexp_replace(t, '[^0-9]', '', 'g')) as n_digits
  from w left join cov using (doc_id)),
b as (select *, (n_words < 50)::bigint * 1 + (100 * n_repeat_words > 50 * n_words)::bigint * 2 + (100 * n_symbols > 10 * n_words)::bigint * 4
  + (100 * n_dup_lines > 50 * n_lines)::bigint * 8 + (word_chars < 3 * n_words)::bigint * 16 + (word_chars > 12 * n_words)::bigint * 32
  + (100 * n_upper > 40 * word_chars)::bigint * 64 + (100 * n_exclaim > 50 * n_words)::bigint * 128 + (100 * n_digits > 30 * word_chars)::bigint * 256 as failed_bits from m)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words,
  (failed_bits & 3) <> 0 as base_failed, failed_bits = 0 as kept, failed_bits from b
"""


def _op3_sql() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
with d as (select doc_id, regexp_extract_all({lower}, '{word}') as ws from documents),
b as (select item_id, regexp_extract_all({lower}, '{word}') as ws from benchmark),
bw as (select distinct item_id, least(len(ws), 10) as n, array_to_string(ws[i : i + 9], ' ') as g from (select item_id, ws, unnest(range(1, greatest(len(ws) - 8, 2))) as i from b where len(ws) > 0)),
dw as (select doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') as g from (select doc_id, ws, n, unnest(range(1, greatest(len(ws) - n + 2, 1))) as i from d, (select distinct n from bw) where len(ws) > 0)),
hit as (select doc_id, item_id, i, bw.n as n from dw join bw on dw.n = bw.n and dw.g = bw.g),
cov as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hit) group by doc_id),
it as (select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids from (select distinct doc_id, item_id from hit) group by doc_id)
select d.doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join cov using (doc_id) left join it using (doc_id)
"""


def _op6_sql() -> str:
    return r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
w as (select doc_id, i, array_to_string(ws[i : i + 12], ' ') as g from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 11, 1))) as i from d)),
f as (select doc_id, i from (select doc_id, i, min(doc_id) over (partition by g) as m from w) where m < doc_id),
gone as (select distinct doc_id, unnest(range(i, i + 13)) as p from f),
x as (select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as p from d),
k as (select doc_id, string_agg(w, ' ' order by p) as kept, count(*) as n from (select * from x anti join gone using (doc_id, p)) group by doc_id)
select d.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join k using (doc_id)
"""


def _op7_sql() -> str:
    return r"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
g as (select distinct doc_id, array_to_string(ws[i : i + 2], ' ') as g from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) as i from d where len(ws) > 0)),
z as (select doc_id, count(*) as n from g group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as i from g as a join g as b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
e as (select a, b from p join z as x on x.doc_id = a join z as y on y.doc_id = b where 100 * i >= 85 * (x.n + y.n - i)),
u as (select a, b from e union all select b, a from e),
r(x, y) as (select doc_id, doc_id from d union select r.x, u.b from r join u on u.a = r.y)
select d.doc_id, coalesce(z.n, 0)::bigint as n_shingles, c as component_id, c = d.doc_id as kept from d left join z using (doc_id) join (select x as doc_id, min(y) as c from r group by x) using (doc_id)
"""


def _op10_sql() -> str:
    known = ", ".join(f"('{k}', '{v}')" for v, k in license.known_sentences().items())
    rules = ", ".join(f"('{name}', '{kind}', '{',([a-z0-9_]+,)*?'.join(rule)}')" for name, (kind, rs) in license.LICENCES.items() for rule in rs)
    gone = ", ".join(f"('{name}', '{by}')" for name, bys in license.SUPPRESSED.items() for by in bys)
    return rf"""
with known(id, s) as (values {known}), rules(name, kind, p) as (values {rules}), gone(name, by_) as (values {gone}),
t as (select doc_id, coalesce(text, '') as t from documents where regexp_matches(text, '{license.TELLING}')),
v as (select doc_id, 1 as view, ln, idx from (select doc_id, unnest(string_split(t, chr(10))) as ln, generate_subscripts(string_split(t, chr(10)), 1) as idx from t) union all select doc_id, 2, replace(t, chr(10), ' '), 1 from t),
s as (select doc_id, view, idx, unnest(parts) as s, generate_subscripts(parts, 1) as j from (select doc_id, view, idx, string_split_regex(ln, '{license._END}') as parts from v)
  union all select doc_id, 3, idx, unnest(list_concat([p], string_split(p, chr(10)))), generate_subscripts(list_concat([p], string_split(p, chr(10))), 1)
    from (select doc_id, unnest(string_split_regex(t, '{license._END_WRAPPED}')) as p, generate_subscripts(string_split_regex(t, '{license._END_WRAPPED}'), 1) as idx from t)),
n as (select *, regexp_replace(regexp_replace(trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')), '{license.LEAD}', '\4 under'), '{license.TAIL}', '') as norm from s),
ids as (select doc_id, view, string_agg(known.id, ',' order by idx, j) as seq, count(*) as n from n join known on known.s = norm group by doc_id, view),
f as (select distinct doc_id, name, kind from ids join rules on regexp_matches(',' || seq || ',', ',(' || p || '),')),
g as (select * from f where not exists (select 1 from f as o join gone on gone.by_ = o.name where o.doc_id = f.doc_id and gone.name = f.name))
select d.doc_id, coalesce(max(i.n), 0)::bigint as n_sentences, coalesce(string_agg(distinct g.name, ',' order by g.name), '') as licences, coalesce(string_agg(distinct g.kind, ',' order by g.kind), '') as classes
from documents d left join (select doc_id, n from ids where view = 1) i using (doc_id) left join g using (doc_id) group by d.doc_id
"""


def _op11_sql() -> str:
    """Codebooks of parts p as rows (p, e, list); one materialised step for each round."""
    near = "select vec_id, label, p, v, e, d from (select *, row_number() over (partition by rid, p order by d, e) as k from (select x.*, b.e, (list_inner_product(v, v) + list_inner_product(b.w, b.w) - 2 * list_inner_product(v, b.w))::bigint as d from x join {b} b using (p))) where k = 1"
    steps = []
    for r in range(4):
        steps.append(f"n{r} as materialized ({near.format(b=f'b{r}')})")
        mean = f"select p, e, list(m order by i) as w from (select p, e, i, floor(sum(v[i]::hugeint)::double / count(*))::double as m from (select *, unnest(range(1, 17)) as i from n{r}) group by p, e, i) group by p, e"
        steps.append(f"b{r + 1} as materialized (select p, e, coalesce(m.w, b.w) as w from b{r} b left join ({mean}) m using (p, e))")
    return f"""
with k as (select row_number() over (order by vec_id) as rid, vec_id, label, list_transform(embedding, lambda z: floor(1024 * z::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda z: z is null or not isfinite(z))) = 0),
x as materialized (select rid, vec_id, label, p, v[16 * p + 1 : 16 * p + 16] as v from (select *, unnest(range(0, 4)) as p from k)),
b0 as materialized (select p, rid - 1 as e, v as w from x where rid <= 256),
{", ".join(steps)},
f as materialized ({near.format(b="b4")}),
g as (select vec_id, label, string_agg(format('{{:02x}}', e), '' order by p) as code, sum(d)::bigint as error from f group by vec_id, label),
s as (select sha256(string_agg(z::bigint::varchar, ',' order by p, e, i)) as h from (select p, e, unnest(w) as z, generate_subscripts(w, 1) as i from b4))
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, h as codebooks_sha256 from g, s
"""


def _op12_sql() -> str:
    return r"""
with recursive k as (select doc_id, source, (length(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'w', 'g')) - length(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]', '', 'g')))::bigint as size,
  ('0x' || md5(coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, '')))[:15])::bigint as key from documents),
s as (select source, sum(size)::bigint as source_size, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as w from k group by source),
t as (select sum(source_size)::bigint as total from s),
r(step, f) as (select 0, 1.5::double * (select total from t) / (select sum(w) from s)
  union all select step + 1, (1.5::double * (select total from t) - (select coalesce(sum(2 * source_size), 0) from s where 2 * source_size <= w * f)) / nullif((select sum(w) from s where 2 * source_size > w * f), 0) from r where step < 40 and f is not null),
l as (select max(f) as f from r),
g as (select source, source_size, least(2.0::double * source_size, w * f) as target from s, l),
b as (select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as full from g),
c as (select k.doc_id, k.source, size, source_size, target, b.full, target - b.full * source_size as rest, sum(size) over (partition by k.source order by key, k.doc_id rows unbounded preceding) as upto
  from k join b on k.source is not distinct from b.source)
select doc_id, size, source_size, target, (size * (c.full + (rest > 0 and 2 * (rest - (upto - size)) >= size)::int))::bigint as taken from c
"""


QUERIES = {f.__name__: f for f in (op1_language_id, op2_quality_rules, op3_benchmark_decontamination, op4_sampled_splitters, op5_language_model, op6_substring_dedup, op7_near_duplicates, op8_toxicity, op9_packing, op10_license_scan, op11_vector_codes, op12_source_mixing, op13_spelling_variants)}
ORACLES = {"op2_quality_rules": _op2_sql(), "op3_benchmark_decontamination": _op3_sql(), "op6_substring_dedup": _op6_sql(), "op7_near_duplicates": _op7_sql(), "op10_license_scan": _op10_sql(), "op11_vector_codes": _op11_sql(), "op12_source_mixing": _op12_sql()}
