"""The registered queries ``opN_<name>`` and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .best_fit_packing import best_fit_packing
from .bpe_coding import bpe_encode
from .collocations import collocations
from .common import table
from .decontamination import contamination
from .language_id import language_id
from .line_dedup import line_dedup
from .lm_scoring import lm_scores
from .pii import digests as pii_digests
from .pii import pii_spans
from .secret_scan import digests as secret_digests
from .secret_scan import secret_scan
from .simhash_dedup import hex16, simhash_components
from .spelling_variants import spelling_variants
from .toxicity import toxicity_scores
from .topk_search import QUERY_EVERY, exact_top_k, quantised


def op1(spark, sf_dir):
    return best_fit_packing(table(spark, sf_dir, "documents"))


def op3(spark, sf_dir):
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return exact_top_k(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))


SQL_OP3 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as q
  from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as query_id, b.vec_id as vec_id,
         cast(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) as bigint) as score
  from v a join v b on a.vec_id % 20 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)
), ranked as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
         vec_id, score
  from scored
)
select * from ranked where rank <= 20
"""


def op2(spark, sf_dir):
    return lm_scores(table(spark, sf_dir, "documents"))


def op4(spark, sf_dir):
    return language_id(table(spark, sf_dir, "documents")).select("doc.doc_id", "held_out", "lang_pred", "score")


def op8(spark, sf_dir):
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5(spark, sf_dir):
    return pii_digests(pii_spans(table(spark, sf_dir, "documents")))


def op6(spark, sf_dir):
    return line_dedup(table(spark, sf_dir, "documents")).select(
        "doc.doc_id", "n_lines", "n_removed", F.length("left").cast("long").alias("n_chars_left"),
        F.sha2(F.col("left").cast("binary"), 256).alias("text_sha256"))


SQL_OP6 = """
with cut as (
  select doc_id, source, text, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) as at
  from documents
), spread as (
  select trim(line) as line, min(doc_id) as keeper from cut where trim(line) <> ''
  group by 1 having count(distinct source) >= 10
), left_over as (
  select doc_id, count(*) as n_removed from cut join spread on trim(cut.line) = spread.line
  where doc_id <> keeper group by doc_id
), kept as (
  select cut.doc_id, string_agg(cut.line, chr(10) order by cut.at) as text
  from cut left join spread on trim(cut.line) = spread.line
  where spread.line is null or cut.doc_id = keeper group by cut.doc_id
)
select d.doc_id, cast(len(string_split(d.text, chr(10))) as bigint) as n_lines,
       cast(coalesce(l.n_removed, 0) as bigint) as n_removed,
       cast(length(coalesce(k.text, '')) as bigint) as n_chars_left, sha256(coalesce(k.text, '')) as text_sha256
from documents d left join left_over l on d.doc_id = l.doc_id left join kept k on d.doc_id = k.doc_id
"""


def op7(spark, sf_dir):
    return simhash_components(table(spark, sf_dir, "documents")).select(
        "doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op9(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc.doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


SQL_OP9 = """
with d as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as w
  from documents
), b as (
  select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as w
  from benchmark
), starts as (
  select item_id, w, unnest(range(0, greatest(len(w) - 13, 0) + 1)) as s from b where len(w) > 0
), grams as (
  select distinct item_id, least(len(w), 13) as n, array_to_string(w[s + 1:s + 13], ' ') as gram from starts
), sizes as (
  select distinct n from grams
), places as (
  select doc_id, n, w, unnest(range(0, len(w) - n + 1)) as s from d cross join sizes where len(w) >= n
), found as (
  select p.doc_id, p.s, p.n, g.item_id
  from places p join grams g on g.n = p.n and g.gram = array_to_string(p.w[p.s + 1:p.s + p.n], ' ')
), hit as (
  select doc_id, count(distinct pos) as n_hit
  from (select doc_id, unnest(range(s, s + n)) as pos from found) group by doc_id
), held as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id
)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(d.w) as contaminated
from d left join hit on d.doc_id = hit.doc_id left join held on d.doc_id = held.doc_id
"""


def op10(spark, sf_dir):
    return secret_digests(secret_scan(table(spark, sf_dir, "documents")))


def op11(spark, sf_dir):
    coded = bpe_encode(table(spark, sf_dir, "documents"), decoded=True)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


SQL_OP12 = """
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents
), words as (
  select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') as w from pieces
), totals as (
  select lang, sum(len(w)) as n from words group by lang
), starts as (
  select lang, w, m, unnest(range(0, len(w) - m + 1)) as s
  from words cross join (values (1), (2), (3), (4), (5)) sizes(m) where len(w) >= m
), f as (
  select lang, m, w[s + 1:s + m] as p, count(*) as f from starts group by all having count(*) >= 100
), inside as (
  select distinct lang, p[i + 1:i + size] as p, f
  from (select lang, p, f, size, unnest(range(0, m - size + 1)) as i
        from f cross join (values (2), (3), (4)) sizes(size) where m > size)
), candidates as (
  select f.* from f where m >= 2
    and not exists (select 1 from inside i where i.lang = f.lang and i.p = f.p and 100 * i.f >= 100 * f.f)
), cut as (
  select c.lang, c.p, c.f as a, k, l.f as l, r.f as r, n,
         (1000::hugeint * c.f * n) // (l.f::hugeint * r.f) as score
  from (select *, unnest(range(1, m)) as k from candidates) c
  join f l on l.lang = c.lang and l.p = c.p[1:k]
  join f r on r.lang = c.lang and r.p = c.p[k + 1:c.m]
  join totals on totals.lang = c.lang
), lowest as (
  select *, row_number() over (partition by lang, p order by score, k) as place from cut
), ranked as (
  select lang, array_to_string(p, ' ') as phrase, a, l, r, n, score,
         row_number() over (partition by lang order by score desc, a desc, array_to_string(p, ' ')) as rank
  from lowest where place = 1
)
select lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l,
       cast(r as bigint) as r, cast(n as bigint) as n, cast(score as bigint) as score
from ranked where rank <= 2000
"""


def op13(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"))


def queries():
    return {
        "op1_best_fit_packing": op1,
        "op2_lm_scoring": op2,
        "op3_topk_search": op3,
        "op4_language_id": op4,
        "op5_pii": op5,
        "op6_line_dedup": op6,
        "op7_simhash_dedup": op7,
        "op8_toxicity": op8,
        "op9_decontamination": op9,
        "op10_secret_scan": op10,
        "op11_bpe_coding": op11,
        "op12_collocations": op12,
        "op13_spelling_variants": op13,
    }


def oracle_sql():
    return {
        "op3_topk_search": SQL_OP3,
        "op6_line_dedup": SQL_OP6,
        "op9_decontamination": SQL_OP9,
        "op12_collocations": SQL_OP12,
    }
