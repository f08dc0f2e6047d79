"""Registered queries of the operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

import importlib.util
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, codebook, divergence, mixing, packing, pii, quality, secretscan, sharding, simhash, tokenfile, topk, webtext
from .common import table

BYTE_VOCABULARY, WORD_VOCABULARY = "byte_bpe_50k.json", "word_bpe_49k.json"


def vocabulary(name: str) -> str:
    """A vocabulary file of the public tokenizers installed beside Python."""
    spec = importlib.util.find_spec("public_tokenizers")
    if spec is None:
        raise FileNotFoundError("the package public_tokenizers is not installed")
    return os.path.join(os.path.dirname(spec.origin), name)


def op1_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.find_pii(table(spark, sf, "documents"))


def op2_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return ann.nearest(table(spark, sf, "embeddings"))


def op3_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.exact_topk(table(spark, sf, "embeddings"))


def op4_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return webtext.extract_text(table(spark, sf, "pages"))


def op5_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf, "documents"), columns=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op6_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op7_token_files(spark: SparkSession, sf: str) -> DataFrame:
    return tokenfile.read_digests(tokenfile.write_tokens(table(spark, sf, "documents"), vocabulary(BYTE_VOCABULARY)))


def op8_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), vocabulary(WORD_VOCABULARY))


def op9_byte_shards(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.byte_shards(table(spark, sf, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op11_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secretscan.find_secrets(table(spark, sf, "documents"))


def op12_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    return codebook.compress(table(spark, sf, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii, "op2_nearest": op2_nearest, "op3_exact_topk": op3_exact_topk, "op4_html_text": op4_html_text,
    "op5_mix_sources": op5_mix_sources, "op6_simhash": op6_simhash, "op7_token_files": op7_token_files,
    "op8_packing": op8_packing, "op9_byte_shards": op9_byte_shards, "op10_quality": op10_quality,
    "op11_secrets": op11_secrets, "op12_vector_codes": op12_vector_codes, "op13_source_divergence": op13_source_divergence,
}


def _vector_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """One pair of steps, nearest entries and their means, for every round."""
    def nearest(turn: int) -> str:
        return f"""a{turn} as (
    select row, m, v, least_of.d as d, least_of.j as j from (
        select row, m, any_value(v) as v, min({{'d': d, 'j': j}}) as least_of from (
            select p.row, p.m, p.v, b.j, list_sum(list_transform(list_zip(p.v, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
            from p join b{turn} b on b.m = p.m) group by row, m))"""

    def means(turn: int) -> str:
        width = "(select max(len(v)) from p)"
        return f"""s{turn} as (
    select m, j, i, count(*) as n, sum(v[i])::bigint as s from a{turn - 1}, range(1, {width} + 1) t(i) group by m, j, i),
b{turn} as (
    select b.m, b.j, coalesce(n.c, b.c) as c from b{turn - 1} b left join (
        select m, j, list((s - ((s % n) + n) % n) // n order by i) as c from s{turn} group by m, j) n on n.m = b.m and n.j = b.j)"""

    steps = [nearest(0)]
    for turn in range(1, rounds + 1):
        steps += [means(turn), nearest(turn)]
    return f"""
with e as materialized (
    select row_number() over () as row, vec_id, label, list_transform(embedding, lambda x: floor({codebook.SCALE} * x::double)::bigint) as v
    from embeddings where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (select row, m, v[m * (len(v) // {parts}) + 1:(m + 1) * (len(v) // {parts})] as v from e, range({parts}) t(m)),
f as (select row, (row_number() over (order by vec_id) - 1)::int as j from (
    select min(row) as row, vec_id from e where vec_id is not null group by vec_id) order by j limit {entries}),
b0 as (select p.m, f.j, p.v as c from p join f on p.row = f.row),
{", ".join(s.replace(" as (", " as materialized (", 1) for s in steps)},
x as (select e.row, vec_id, label, string_agg(lpad(lower(to_hex(j)), 2, '0'), '' order by m) as code, sum(d)::bigint as error
      from a{rounds} a join e on e.row = a.row group by e.row, vec_id, label)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
       (select sha256(string_agg(array_to_string(c, ','), ',' order by m, j)) from b{rounds}) as codebooks_sha256 from x"""


#: SQL for those that SQL can express: the exact search and the mix. The others rest on hashes, tokenizers or models that
#: it lacks and are tested against brute force, a round trip or held-out labels.
ORACLE = {
    "op3_exact_topk": """
with v as (
    select distinct vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
    from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(embedding) = (select max(len(embedding)) from embeddings)),
s as (
    select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::bigint as score
    from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 10""",
    "op5_mix_sources": r"""
with d as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
s1 as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as nth from d group by source),
s2 as (select *, ((nth - 1) % 3 + 1)::bigint as w, source_size * 3 as lim, sum(source_size) over ()::bigint as total from s1),
s3 as (select *, lim / w as ratio from s2),
s4 as (select *, (total - coalesce(sum(lim) over (order by ratio, nth rows between unbounded preceding and 1 preceding), 0))::bigint
              / sum(w) over (order by ratio, nth rows between current row and unbounded following)::bigint as rate from s3),
s5 as (select *, (select arg_min(rate, (ratio, nth)) from s4 where rate <= ratio) as level from s4),
goal as (select source, source_size, coalesce(least(lim::double, w * level), lim::double) as target from s5),
dc as (select *, case when size > 0 then length(bin(size)) else 0 end as cls from d),
c1 as (select dc.source, cls, sum(size)::bigint as cs, any_value(target) as target, any_value(source_size) as source_size
       from dc join goal on dc.source is not distinct from goal.source group by dc.source, cls),
c2 as (select *, cs * cls as cw, cs * 3 as cl, case when cs * cls > 0 then (cs * 3) / (cs * cls) else 0 end as ratio from c1),
c3 as (select *, (target - coalesce(sum(cl) over p, 0)) / nullif(sum(cw) over f, 0) as rate from c2
       window p as (partition by source order by ratio, cls rows between unbounded preceding and 1 preceding),
              f as (partition by source order by ratio, cls rows between current row and unbounded following)),
c4 as (select *, arg_min(rate, (ratio, cls)) filter (where rate <= ratio) over (partition by source) as level from c3),
c5 as (select *, case when cs > 0 then least(3.0::double, coalesce(cls * level, 3.0::double)) else 0 end as expected from c4),
c6 as (select *, floor(expected)::int as whole, expected - floor(expected) as p,
              greatest(0, target - sum(cs * floor(expected)) over (partition by source)) as rest from c5),
r1 as (select dc.doc_id, dc.source, size, dc.cls, source_size, target, whole, p, rest,
              (('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':7'), 1, 13))::bigint + 0.5::double) / 4503599627370496.0::double as u
       from dc join c6 on dc.source is not distinct from c6.source and dc.cls = c6.cls),
r2 as (select *, case when p > 0 and size > 0 then (u / (1 - u)) / (p / (1 - p)) end as rank from r1),
r3 as (select *, sum(size) over (partition by source order by rank nulls last, doc_id, size rows unbounded preceding) as upto
       from r2 where rank is not null),
r4 as (select *, upto <= rest as sampled, rest - coalesce(max(case when upto <= rest then upto end) over (partition by source), 0) as gap from r3),
r5 as (select *, not sampled and size < 2 * gap and row_number() over (
              partition by source, not sampled and size < 2 * gap order by abs(size - gap), rank, doc_id) = 1 as closes from r4)
select r2.doc_id, r2.size, r2.source_size, r2.target,
       (r2.size * (r2.whole + coalesce((r5.sampled or r5.closes)::int, 0)))::bigint as taken
from r2 left join r5 on r2.doc_id = r5.doc_id""",
    "op12_vector_codes": _vector_codes_sql(),
    "op13_source_divergence": r"""
with d as (select row_number() over () as row, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source from documents),
t as (select lang, source, row, unnest(list_transform(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'),
             lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) as term from d),
kept as (select lang, term, count(*)::hugeint as lang_n from t group by lang, term having count(distinct row) >= 30),
size as (select lang, count(*)::hugeint as v, sum(lang_n)::hugeint as lang_total from kept group by lang),
g as (select distinct lang, source from d),
c as (select t.lang, t.source, t.term, count(*)::hugeint as n from t join kept on t.lang = kept.lang and t.term = kept.term group by all),
total as (select lang, source, sum(n)::hugeint as total from c group by lang, source),
p as (select g.lang, g.source, kept.term, coalesce(c.n, 0) as n,
             1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (coalesce(total.total, 0) + 5 * size.v) as p,
             1 + (1000000000::hugeint * (lang_n + 5)) // (lang_total + 5 * size.v) as q
      from g join kept on g.lang = kept.lang join size on g.lang = size.lang
      left join c on c.lang = g.lang and c.source = g.source and c.term = kept.term
      left join total on total.lang = g.lang and total.source = g.source),
f as (select g.lang, g.source, 'pair' as part, o.source as item, coalesce((
             select sum(abs(a.p - b.p)) from p a join p b on a.lang = b.lang and a.term = b.term
             where a.lang = g.lang and a.source = g.source and b.source = o.source), 0)::bigint as value
      from g join g o on g.lang = o.lang and g.source <> o.source
      union all
      select lang, source, 'term', term, (p - q)::bigint from p where n > 0 and p > q),
r as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from f)
select lang, source, part, item, value, rank from r where part = 'pair' or rank <= 50""",
}
