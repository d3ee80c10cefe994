"""The registered queries of this subpackage, with SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelscope.llm.common import table
from reelscope.llm.contamination import contaminated
from reelscope.llm.exact_dedup import exact_dedup
from reelscope.llm.hard_negatives import hard_negatives, shifted_labels
from reelscope.llm.importance import resample
from reelscope.llm.language_id import identify
from reelscope.llm.mixing import mix
from reelscope.llm.nearest import nearest_neighbours
from reelscope.llm.packing import pack
from reelscope.llm.secret_scan import secret_scan
from reelscope.llm.sharding import histogram_shards
from reelscope.llm.simhash import simhash_groups
from reelscope.llm.substring_dedup import substring_dedup
from reelscope.llm.url_filter import url_verdicts


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op6_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_shards(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(shifted_labels(table(spark, sf_dir, "embeddings")))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_url_filters, op2_language_id, op3_exact_dedup, op4_mix_sources, op5_nearest_neighbours,
        op6_histogram_shards, op7_secret_scan, op8_best_fit_packing, op9_simhash_near_dedup,
        op10_substring_dedup, op11_decontamination,
        op12_hard_negatives, op13_importance_resampling, pipeline)
}

_SPACE = r"[\x20\x09-\x0D]"
_WORDS = r"[^\x20\x09-\x0D]+"

EXACT_DEDUP = rf"""
with d as (
  select doc_id, length(coalesce(text, '')) as points,
         sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g')) as sha
  from documents),
r as (
  select *, row_number() over (partition by sha order by points desc, doc_id nulls first) as place,
         count(*) over (partition by sha) as n,
         first_value(doc_id) over (partition by sha order by points desc, doc_id nulls first) as keep
  from d)
select doc_id, keep as keep_id, n as group_size, place = 1 as kept, sha as text_sha256 from r
"""

MIX = rf"""
with recursive q as (
  select doc_id, max(quality) as quality from labels where doc_id is not null group by doc_id),
d as (
  select x.doc_id, x.source, coalesce(len(regexp_extract_all(x.text, '{_WORDS}')), 0)::bigint as size,
         -ln((('0x' || substr(md5(coalesce(x.doc_id::varchar, '')), 1, 13))::bigint + 0.5::double) / 4503599627370496.0::double)
           / (case q.quality when 1 then 2.0::double when 0 then 0.5::double else 1.0::double end) as key
  from documents x left join q on q.doc_id = x.doc_id),
s as (
  select source, sum(size)::bigint as source_size from d group by source),
w as (
  select source, source_size, 2.0::double * source_size as bound,
         [3.0::double, 1.0::double, 2.0::double][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight
  from s),
o as (
  select *, row_number() over (order by bound / weight, source nulls last) as i,
         1.5::double * sum(source_size) over () as share,
         coalesce(sum(bound) over (order by bound / weight, source nulls last
                                   rows between unbounded preceding and 1 preceding), 0.0) as spent,
         sum(weight) over (order by bound / weight, source nulls last
                           rows between current row and unbounded following) as free
  from w),
f as (
  select *, bound / weight <= (share - spent) / free as is_full from o),
g as (
  select coalesce(sum(bound) filter (is_full), 0.0) as spent, sum(weight) filter (not is_full) as free from f),
t as (
  select f.source, f.source_size,
         case when f.is_full then f.bound else f.weight * (f.share - g.spent) / g.free end as target
  from f, g),
b as (
  select *, case when source_size > 0 then floor(floor(target + 0.5) / source_size) else 0 end::bigint as epochs from t),
p as (
  select d.*, b.source_size, b.target, b.epochs,
         floor(b.target + 0.5)::bigint - b.epochs * b.source_size as budget,
         coalesce(sum(d.size) over (partition by d.source order by d.key, d.doc_id nulls first, d.size
                                    rows between unbounded preceding and 1 preceding), 0) as before
  from d join b on d.source is not distinct from b.source)
select doc_id, size, source_size, target::double as target,
       (epochs * size + greatest(0, least(size, budget - before)))::bigint as taken
from p
"""

SUBSTRING_DEDUP = rf"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(regexp_extract_all(text, '{_WORDS}'), []::varchar[]) as words
  from documents),
w as (
  select rid, doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) as k
  from (select rid, doc_id, words, unnest(range(1, len(words) - 48)) as i from d where len(words) >= 50)),
m as (
  select k, min(coalesce(doc_id, 9223372036854775807)) as first from w group by k),
g as (
  select distinct w.rid, unnest(range(w.i, w.i + 50)) as at
  from w join m on m.k = w.k where coalesce(w.doc_id, 9223372036854775807) > m.first),
l as (
  select d.rid, d.doc_id, d.words[u.at] as word, u.at
  from d, (select rid, unnest(range(1, len(words) + 1)) as at from d) u where u.rid = d.rid),
k as (
  select l.rid, count(*) filter (g.at is not null) as n_removed,
         string_agg(l.word, ' ' order by l.at) filter (g.at is null) as kept
  from l left join g on g.rid = l.rid and g.at = l.at group by l.rid)
select d.doc_id, len(d.words)::bigint as n_words, coalesce(k.n_removed, 0)::bigint as n_removed,
       sha256(coalesce(k.kept, '')) as kept_sha256
from d left join k on k.rid = d.rid
"""

_ASCII = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
with b as (
  select coalesce(item_id::varchar, '') as item_id, coalesce(regexp_extract_all({_LOWER}, '{_ASCII}'), []::varchar[]) as words
  from benchmark),
v as (
  select distinct item_id, least(10, len(words)) as size, array_to_string(words[i:i + least(10, len(words)) - 1], ' ') as k
  from (select item_id, words, unnest(range(1, greatest(1, len(words) - 9) + 1)) as i from b where len(words) > 0)),
d as (
  select row_number() over () as rid, doc_id, coalesce(regexp_extract_all({_LOWER}, '{_ASCII}'), []::varchar[]) as words
  from documents),
w as (
  select rid, size, i, array_to_string(words[i:i + size - 1], ' ') as k
  from (select rid, words, size, unnest(range(1, len(words) - size + 2)) as i
        from d, (select distinct size from v) where len(words) >= size)),
m as (
  select w.rid, w.i, w.size, v.item_id from w join v on v.size = w.size and v.k = w.k),
h as (
  select rid, count(distinct place) as n_hit from (select rid, unnest(range(i, i + size)) as place from m) group by rid),
n as (
  select rid, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as ids from m group by rid)
select d.doc_id, len(d.words)::bigint as n_words, coalesce(h.n_hit, 0)::bigint as n_hit,
       coalesce(n.n_items, 0)::bigint as n_items, sha256(coalesce(n.ids, '')) as items_sha256,
       h.n_hit is not null as contaminated
from d left join h on h.rid = d.rid left join n on n.rid = d.rid
"""

HARD_NEGATIVES = """
with r as (
  select row_number() over () as row, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and coalesce(list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))), true)),
s as (
  select a.row as anchor, a.vec_id as anchor_id, r.vec_id, r.label = a.label as same,
         list_inner_product(a.v, r.v)::bigint as score
  from r a join r on r.row <> a.row and len(r.v) = len(a.v) where a.vec_id % 50 = 0),
p as (
  select *, row_number() over (partition by anchor order by score desc, vec_id) as positive_rank from s where same
  qualify positive_rank <= 5),
n as (
  select p.anchor_id, p.vec_id as positive_id, p.positive_rank, s.vec_id as negative_id, p.score as positive_score,
         s.score as negative_score,
         row_number() over (partition by p.anchor, p.positive_rank order by s.score desc, s.vec_id) as rank
  from p join s on s.anchor = p.anchor and not s.same
    and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score
  qualify rank <= 3)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score,
       positive_rank::int as positive_rank
from n
"""

# crc32 byte by byte, with its table of 256 remainders made from the polynomial
RESAMPLING = rf"""
with c as materialized (
  select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda r, x: case when r & 1 = 1 then xor(r >> 1, 3988292384) else r >> 1 end)
              order by i) as crc
  from (select unnest(range(256)) as i)),
d as (
  select row_number() over () as rid, doc_id, coalesce(regexp_extract_all({_LOWER}, '{_ASCII}'), []::varchar[]) as words
  from documents),
b as (
  select coalesce(regexp_extract_all({_LOWER}, '{_ASCII}'), []::varchar[]) as words from benchmark),
f as (
  select rid, true as ours, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) as f
  from d
  union all
  select 0, false, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])))
  from b),
n as (
  select rid, ours, f, count(*) as n from f group by rid, ours, f),
h as (
  select f, xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(f))),
                  lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::bigint)),
                lambda r, x: xor(r >> 8, crc[(xor(r, x) & 255) + 1])), 4294967295) % 10000 as bucket
  from (select distinct f from n), c),
k as (
  select bucket, coalesce(sum(n) filter (ours), 0) as s, coalesce(sum(n) filter (not ours), 0) as t
  from n join h using (f) group by bucket),
g as (
  select bucket, floor(1000 * ln((t + 1)::double * (sum(s) over () + 10000)::double
                                 / ((s + 1)::double * (sum(t) over () + 10000)::double)))::bigint as gain
  from k),
w as (
  select rid, sum(n)::bigint as n_features, floor(sum(n * gain)::double / sum(n)::double)::bigint as weight
  from n join h using (f) join g using (bucket) where ours group by rid),
e as (
  select d.rid, d.doc_id, coalesce(w.n_features, 0) as n_features, coalesce(w.weight, 0) as weight, len(d.words) >= 20 as enough,
         coalesce(w.weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(d.doc_id::varchar, '')), 1, 8))::bigint
                                                         + 0.5::double) / 4294967296::double)))::bigint as score
  from d left join w on w.rid = d.rid),
r as (
  select *, row_number() over (partition by enough order by score desc, doc_id nulls first) as place,
         25 * count(*) over (partition by enough) // 100 as drawn
  from e)
select doc_id, n_features, weight, score, case when enough and place <= drawn then place end as rank from r
"""

ORACLE: dict[str, str] = {
    "op3_exact_dedup": EXACT_DEDUP,
    "op4_mix_sources": MIX,
    "op10_substring_dedup": SUBSTRING_DEDUP,
    "op11_decontamination": DECONTAMINATION,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_importance_resampling": RESAMPLING,
}
