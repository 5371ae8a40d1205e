"""Queries of the document operators: thin, each over the whole of its tables."""

from __future__ import annotations

from ..session import scratch_dir
from .common import load

QUERIES: dict = {}
ORACLE: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file (same place on every machine)."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_fingerprints(spark, sf_dir):
    """Threshold-scaled sketches of every text, its edited text and the next text."""
    from .sketch import edit_report
    return edit_report(load(spark, sf_dir, "documents"))


@query
def op2_token_counts(spark, sf_dir):
    """Token counts of every text through a digest cache (a new cache a run)."""
    from .tokens import token_counts
    docs = load(spark, sf_dir, "documents")
    return token_counts(docs, vocabulary(), scratch_dir(spark, "token-cache"))


@query
def op4_decontamination(spark, sf_dir):
    """Benchmark windows found in every document through shard suffix arrays."""
    from .suffix import contamination_report
    return contamination_report(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = rf"coalesce(regexp_extract_all(translate(text, {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

ORACLE["op4_decontamination"] = f"""
with b as (select row_number() over () item_no, item_id, {_WORDS} w from benchmark),
bw as (select item_no, cast(item_id as varchar) item_id, k, i j, array_to_string(w[i:i + k - 1], ' ') g
       from (select item_no, item_id, w, least(len(w), 10) k, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) i
             from b where len(w) > 0)),
d as (select doc_id, row_number() over () rid, {_WORDS} w from documents),
ks as (select distinct k from bw),
dw as (select rid, k, i, array_to_string(w[i:i + k - 1], ' ') g
       from (select rid, w, k, unnest(generate_series(1, len(w) - k + 1)) i from d, ks where len(w) >= k)),
hit as (select rid, i, k, item_id from dw join bw using (k, g)),
words as (select rid, count(distinct p) n_hit
          from (select rid, unnest(generate_series(i, i + k - 1)) p from (select distinct rid, i, k from hit)) group by rid),
items as (select rid, count(*) n_items, string_agg(item_id, ',' order by item_id) ids
          from (select distinct rid, item_id from hit) group by rid),
runs as (select rid, max(n) longest from (
           select rid, max(i + k) - min(i) n from (
             select *, i - row_number() over (partition by rid, item_no, diag order by i) isl
             from (select rid, item_no, dw.i - bw.j diag, dw.i, k from dw join bw using (k, g)))
           group by rid, item_no, diag, isl) group by rid)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated,
       coalesce(longest, 0) as longest
from d left join words using (rid) left join items using (rid) left join runs using (rid)
"""


@query
def op8_source_mix(spark, sf_dir):
    """Words taken of every document by the golden-ratio schedule of source blocks."""
    from .mixing import mix_report
    return mix_report(load(spark, sf_dir, "documents"))


ORACLE["op8_source_mix"] = r"""
with s as (select doc_id, source, len(coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), [])) as size,
                  md5(coalesce(cast(doc_id as varchar), '~') || '|17') as key from documents),
p as (select source, sum(size)::bigint source_size from s group by source),
r as (select *, row_number() over (order by source nulls last) - 1 src from p),
w as (select *, ([5.0, 2.0, 1.0]::double[])[src % 3 + 1] w, source_size * 2.0::double cap from r),
q as (select *, cap / w ratio, (sum(source_size) over ())::double * 1.5::double goal from w),
l as (select *, (goal - coalesce(sum(cap) over (order by ratio, src rows between unbounded preceding and 1 preceding), 0.0))
                / sum(w) over (order by ratio, src rows between current row and unbounded following) rate from q),
m as (select *, (select rate from l where ratio > rate order by ratio, src limit 1) lvl from l),
t as (select source, src, source_size,
             case when lvl is null then cap else least(cap, lvl * w) end target,
             cast(ceil(source_size / 128.0::double) as bigint) blocks from m),
t2 as (select *, case when source_size > 0 then target / source_size::double * blocks else 0.0::double end slots from t),
t3 as (select *, sum(slots) over (order by src rows between unbounded preceding and current row) / sum(slots) over () hi from t2),
t4 as (select *, coalesce(lag(hi) over (order by src), 0.0) lo from t3),
pt as (select slot, x - floor(x) u from (
         select slot, (floor(slot / 1048576.0::double) * 0.607787409740351::double) % 1.0::double
                      + (slot % 1048576)::double * 0.6180339887498949::double x
         from (select unnest(generate_series(0, (select cast(floor(sum(slots) + 0.5) as bigint) from t2) - 1)) slot))),
k as (select src, blocks, row_number() over (partition by src order by slot) - 1 rnk from pt join t4 on u >= lo and u < hi),
times as (select src, rnk % blocks block, count(*) times from k where rnk // blocks < 2 group by all),
d as (select doc_id, s.source, size, source_size, target, src,
             coalesce(sum(size) over (partition by src order by key, size, doc_id rows between unbounded preceding and 1 preceding), 0)::bigint pos
      from s join t4 on s.source is not distinct from t4.source),
pc as (select *, unnest(generate_series(pos // 128, (pos + size - 1) // 128)) block from d where size > 0),
g as (select doc_id, source, size, source_size, target, pos,
             sum((least(pos + size, (block + 1) * 128) - greatest(pos, block * 128)) * coalesce(times, 0)) taken
      from pc left join times using (src, block) group by doc_id, source, size, source_size, target, pos)
select doc_id, source, size::bigint as size, source_size, target, taken::bigint as taken from g
union all select doc_id, source, size::bigint, source_size, target, 0::bigint from d where size = 0
"""


@query
def op7_near_duplicates(spark, sf_dir):
    """Near-duplicate class of every document by Order MinHash and banded alignment."""
    from .near import classes
    return classes(load(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "n_links")


@query
def op3_language(spark, sf_dir):
    """Language of every text by script, trigram scores and Viterbi over its words."""
    from .language import languages
    return languages(load(spark, sf_dir, "documents"))


@query
def op6_secrets(spark, sf_dir):
    """Secrets of every text; weak parts only where complementary parts are in scope."""
    from .secrets import secret_report
    return secret_report(load(spark, sf_dir, "documents"))


def _secrets_sql() -> str:
    from .secrets import KINDS, NEEDS, SCOPE
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    kinds = ", ".join(f"({i}, {quote(k)}, {quote(r)}, {str(w).lower()}, {quote(p)})" for i, (k, r, w, p) in enumerate(KINDS))
    found = []
    for i, (k, _, _, p) in enumerate(KINDS):
        kept = "true"
        if k == "assign":
            kept = f"length(regexp_extract(m[i], {quote(p)}, 2)) >= 8"
        if k == "key":
            kept = "regexp_matches(m[i], '[a-z]') and regexp_matches(m[i], '[A-Z]') and regexp_matches(m[i], '[0-9]')"
        found.append(f"""select rid, {i} k, s + length(m[i]) "end", s "start" from (
            select rid, m, i, list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) s
            from (select rid, m, g, unnest(generate_series(1, len(m))) i from (
              select rid, regexp_extract_all(text, {quote(p)}) m, string_split_regex(text, {quote(p)}) g from t)))
            where {kept}""")
    needs = " or ".join("(w.role = '" + r + "' and " + " and ".join(
        f"exists (select 1 from f o where o.rid = w.rid and o.role = '{n}' and abs(o.start - w.start) <= {SCOPE})" for n in ns) + ")"
        for r, ns in NEEDS.items())
    return f"""
with t as (select row_number() over () rid, doc_id, coalesce(text, '') as text from documents),
kinds(k, kind, role, weak, pat) as (values {kinds}),
f0 as (select a.*, kind, role, weak from ({' union all '.join(found)}) a join kinds using (k)),
f as (select * from f0 w where not weak or not exists (
      select 1 from f0 b where b.rid = w.rid and not b.weak and b.start <= w.start and b."end" >= w."end")),
r as (select * from f w where not weak or {needs}),
s as (select rid, count(*) filter (where k = 0) n_assign, count(*) filter (where k = 1) n_access, count(*) filter (where k = 2) n_hex,
             string_agg(concat(kind, ':', start::bigint, ':', "end"::bigint), ',' order by start, k) filter (where k < 3) base,
             string_agg(concat(kind, ':', start::bigint, ':', "end"::bigint), ',' order by start, k) spans from r group by rid)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from t left join s using (rid)
"""


ORACLE["op6_secrets"] = _secrets_sql()


@query
def op10_personal_data(spark, sf_dir):
    """Personal data of every text by fixed patterns and a trained random field."""
    from .pii import pii_report
    return pii_report(load(spark, sf_dir, "documents"))


@query
def op5_toxicity(spark, sf_dir):
    """Toxicity categories of every text by a classifier chain."""
    from .toxicity import categories_of, toxicity
    labels = categories_of(load(spark, sf_dir, "labels"))
    return toxicity(load(spark, sf_dir, "documents"), labels, ["toxic", "toxic_junk"])


@query
def op9_quality(spark, sf_dir):
    """Quality of every document by co-training of a text and a metadata view."""
    from .quality import quality
    return quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query
def op11_centroid_clusters(spark, sf_dir):
    """Exact clusters of all embeddings in 5 rounds of 40 centroids with ns-bounds."""
    from .clustering import cluster_report
    return cluster_report(load(spark, sf_dir, "embeddings"))


def _clusters_sql(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """Rounds of plain assignment: distances as inner products of whole numbers, exact in doubles."""
    parts = [f"""e as materialized (
  select row_number() over () rid, vec_id, list_transform(embedding, lambda x: floor(256.0::double * x::double)) v
  from (select vec_id, embedding from embeddings
        where len(embedding) = {dim} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {dim}))""",
             f"""c0 as materialized (
  select (row_number() over (order by h nulls last, v) - 1)::int c, v from (
    select sha256('2:' || vec_id::varchar) h, v from e order by h nulls last, v limit {k}))"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} as materialized (
  select rid, any_value(vec_id) vec_id, min({{'d': list_inner_product(e.v, e.v) - 2 * list_inner_product(e.v, c.v) + list_inner_product(c.v, c.v), 'c': c}}) m
  from e, c{r} c group by rid)""")
        if r < rounds:
            parts.append(f"""c{r + 1} as materialized (
  select o.c, case when s.v is null then o.v else s.v end v from c{r} o left join (
    select c, list(((t - ((t % n) + n) % n) // n)::double order by i) v from (
      select m.c c, i, sum(x::hugeint) t, count(*)::hugeint n
      from (select m, unnest(v) x, unnest(range(1, {dim + 1})) i from a{r} join e using (rid)) group by all) group by c) s on s.c = o.c)""")
    return "with " + ",\n".join(parts) + f"""
select vec_id, m.c::int as cluster, m.d::bigint as distance, (sum(m.d::bigint) over (partition by m.c))::bigint as cluster_inertia,
       (sum(m.d::bigint) over ())::bigint as inertia,
       sha256(array_to_string(list_transform(c.v, lambda x: x::bigint::varchar), ',')) as centroid_sha256
from a{rounds} a join c{rounds} c on c.c = a.m.c
"""


ORACLE["op11_centroid_clusters"] = _clusters_sql()


@query
def op12_fill_in_middle(spark, sf_dir):
    """Fill-in-middle form of every text, and the text restored from it."""
    from .middle import middle_report
    return middle_report(load(spark, sf_dir, "documents"))


ORACLE["op12_fill_in_middle"] = """
with h as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(doc_id::varchar, '')) x from documents),
n as (select doc_id, t, length(t) n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(x, i, 8))::bigint) h from h),
c as (select *, least(h[1] % (n + 1), h[2] % (n + 1)) a, greatest(h[1] % (n + 1), h[2] % (n + 1)) b,
             case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h[3] % 100 >= 90 then 'plain'
                  when h[4] % 100 < 20 then 'spm' else 'psm' end form from n),
o as (select *, left(t, a) p, substr(t, a + 1, b - a) m, substr(t, b + 1) s from c)
select doc_id, n::bigint as n, form, case when form <> 'plain' then a end::bigint as prefix_chars,
       case when form <> 'plain' then b - a end::bigint as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                        else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(t) as restored_sha256
from o
"""


@query
def op13_byte_bpe(spark, sf_dir):
    """Ids of every text by a file of ranks, and the bytes they decode to."""
    import public_tokenizers
    from .bpe import bpe_report
    return bpe_report(load(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
