"""One query per operator, with its parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline

from tabkit.llm.covertree import floors, product_codes
from tabkit.llm.embedcells import near_vectors
from tabkit.llm.licences import scan_licences
from tabkit.llm.lines import dedup_lines
from tabkit.llm.mixing import mix_sources, n_words
from tabkit.llm.nearcopies import near_copies
from tabkit.llm.packing import best_fit, same_text
from tabkit.llm.quality import quality_scores
from tabkit.llm.registry import ORACLE, QUERIES, query, table
from tabkit.llm.repeats import cut_repeats
from tabkit.llm.tokenids import token_ids
from tabkit.llm.tokens import token_counts
from tabkit.llm.topk import top_k, whole_numbers
from tabkit.llm.trie import prefix_trie, rebuilt, turn_sequences
from tabkit.llm.vectors import whole

__all__ = ["ORACLE", "QUERIES"]

SQL_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

NEAR_COPIES_SQL = f"""
with recursive w as (select doc_id, {SQL_WORDS} as w from documents),
g as (select distinct doc_id, case when len(w) < 3 then w else w[i:i+2] end as g
      from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) as i from w where len(w) > 0)),
h as (select doc_id, array_to_string(g, ' ') as g, count(*) over (partition by doc_id) as n from g),
p as (select a.doc_id as a, b.doc_id as b from h a join h b on a.g = b.g and a.doc_id < b.doc_id and a.n * 100 >= b.n * 85 and b.n * 100 >= a.n * 85
      group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
e as (select a, b from p union all select b, a from p),
r as (select a as v, a as c from e union select e.b, r.c from r join e on e.a = r.v),
l as (select v, min(c) as c from r group by v),
s as (select doc_id, count(*) as n from h group by doc_id)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, coalesce(l.c, d.doc_id) as component_id, coalesce(l.c, d.doc_id) = d.doc_id as kept
from documents d left join s using (doc_id) left join l on l.v = d.doc_id
"""


@query("op4_minhash_near_dedup", NEAR_COPIES_SQL)
def op4(spark, sf):
    return near_copies(table(spark, sf, "documents"), k=3, per_cent=85)


TOP_K_SQL = """
with v as (select vec_id, [floor(64 * x::double)::bigint for x in embedding] as v from embeddings
           where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v::double[], c.v::double[])::bigint as score
      from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id)
select query_id, rank::integer as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 20
"""


@query("op1_exact_top_k", TOP_K_SQL)
def op1(spark, sf):
    return top_k(whole_numbers(table(spark, sf, "embeddings")), F.col("vec_id") % 20 == 0, k=20)


NEAR_VECTORS_SQL = """
with recursive v as (select vec_id, embedding::double[] as v from embeddings
           where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
           and len([x for x in embedding if x <> 0]) > 0),
e as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id
      and list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v)) / sqrt(list_dot_product(b.v, b.v)) >= 0.95),
r as (select a as v, a as c from e union select e.b, r.c from r join e on e.a = r.v),
l as (select v, min(c) as c from r group by v), n as (select a, count(*) as n from e group by a)
select m.vec_id, coalesce(n.n, 0)::bigint as n_links, coalesce(l.c, m.vec_id) as component_id, coalesce(l.c, m.vec_id) = m.vec_id as kept
from embeddings m left join l on l.v = m.vec_id left join n on n.a = m.vec_id
"""


@query("op10_embedding_near_dedup", NEAR_VECTORS_SQL)
def op10(spark, sf):
    return near_vectors(table(spark, sf, "embeddings"), least=0.95, exact=True)


@query("op3_best_fit_packing")
def op3(spark, sf):
    return best_fit(table(spark, sf, "documents"), n_words("text"), same_text("text"), capacity=2048)


@query("op9_cube_mixing")
def op9(spark, sf):
    return mix_sources(table(spark, sf, "documents"))



@query("op7_license_scan")
def op7(spark, sf):
    return scan_licences(table(spark, sf, "documents"))


@query("op8_token_counts")
def op8(spark, sf):
    return token_counts(table(spark, sf, "documents"))


@query("op2_line_crf_quality")
def op2(spark, sf):
    return quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


REPEATS_SQL = r"""
with w as (select doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from documents),
g as (select doc_id, i, w[i:i+12] as g from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from w where len(w) >= 13)),
m as (select g, min(doc_id) as m from g group by g),
c as (select distinct doc_id, unnest(range(i, i + 13)) as p from g join m using (g) where doc_id > m),
d as (select doc_id, list(p) as gone from c group by doc_id)
select doc_id, coalesce(len(w), 0)::bigint as n_words, coalesce(len(gone), 0)::bigint as n_removed,
       sha256(coalesce(array_to_string(case when gone is null then w else [w[k] for k in range(1, len(w) + 1) if not list_contains(gone, k)] end, ' '), '')) as kept_sha256
from w left join d using (doc_id)
"""


@query("op6_substring_dedup", REPEATS_SQL)
def op6(spark, sf):
    return cut_repeats(table(spark, sf, "documents"))


@query("op5_fuzzy_line_dedup")
def op5(spark, sf):
    out = dedup_lines(table(spark, sf, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text"), 256).alias("text_sha256"))

def product_codes_sql(rounds: int = 6) -> str:
    near = """a{k} as materialized (select vec_id, part, any_value(x) as x, min({{'d': d, 'e': entry}}) as m from
      (select vec_id, p.part, p.x, entry, list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - c.x[i]) * (p.x[i] - c.x[i]))) as d from p join c{k} c on p.part = c.part) group by vec_id, part)"""
    move = """n{k} as (select part, entry, list(y order by i) as x from (select part, m.e as entry, i, floor(sum(x[i])::double / count(*))::bigint as y from a{k}, range(1, 1 + (select max(len(x)) from p)) r(i) group by part, m.e, i) group by part, entry),
    c{n} as materialized (select part, entry, coalesce(n{k}.x, c{k}.x) as x from c{k} left join n{k} using (part, entry))"""
    steps = ",\n".join(near.format(k=k) + ",\n" + move.format(k=k, n=k + 1) for k in range(rounds))
    return f"""
with v as (select vec_id, label, [floor(4096 * x::double)::bigint for x in embedding] as v from embeddings
           where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
p as materialized (select vec_id, part, v[part * (len(v) // 8) + 1 : (part + 1) * (len(v) // 8)] as x from v, range(8) r(part)),
c0 as materialized (select part, entry, x from (select part, x, row_number() over (partition by part order by vec_id) - 1 as entry from p) where entry < 16),
{steps},
{near.format(k=rounds)},
s as (select sha256(coalesce(string_agg(array_to_string(x, ','), ',' order by part, entry), '')) as books from c{rounds}),
f as (select vec_id, string_agg(printf('%02x', m.e), '' order by part) as code, sum(m.d)::bigint as error from a{rounds} group by vec_id)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, books as codebooks_sha256 from f join v using (vec_id), s
"""


@query("op11_cover_tree_codes", product_codes_sql())
def op11(spark, sf):
    return product_codes(table(spark, sf, "embeddings").where(whole("embedding")), floors("embedding", 4096))


PREFIX_TRIE_SQL = r"""
with t as (select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t from range(256) r(i)),
o as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
      row_number() over (partition by conv_id order by turn nulls first, role nulls first, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as k
      from conversations where conv_id is not null),
c as (select conv_id, xor(list_reduce(list_concat([4294967295], [ord(x) for x in string_split(conv_id::varchar, '')]::bigint[]), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 4 as h
      from (select distinct conv_id from o), t),
r as (select c.conv_id, o.k, o.role, o.text from c join o on o.conv_id = c.conv_id - c.conv_id % 20 and o.k <= c.h
      union all select c.conv_id, o.k + 1000000000, o.role, o.text from c join o on o.conv_id = c.conv_id and o.k > c.h),
q as (select conv_id, md5(length(role) || ':' || role || text) as g, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as w,
      row_number() over (partition by conv_id order by k) as d from r),
s as materialized (select c.conv_id, coalesce(list(q.g order by q.d) filter (q.d is not null), []) as g, coalesce(list(q.w order by q.d) filter (q.d is not null), []) as w from c left join q using (conv_id) group by c.conv_id),
e as (select conv_id, unnest(range(0, len(g) + 1)) as depth, g, w from s),
n as materialized (select depth, array_to_string(g[1:depth], '') as p, min(conv_id) as conv_id, count(*) as n, any_value(case when depth > 0 then w[depth] else 0 end) as w,
      coalesce(string_agg(case when len(g) = depth then conv_id::varchar end, ',' order by conv_id), '') as ends from e group by 1, 2),
k as (select b.depth, b.p, a.conv_id as up from n b join n a on a.depth = b.depth - 1 and a.p = left(b.p, 32 * (b.depth - 1)::int)),
m as (select a.depth, a.p, count(*) filter (b.depth = a.depth + 1) as kids, sum((b.n - 1) * b.w) as saved,
      count(*) filter (not exists (select 1 from n x where x.depth = b.depth + 1 and left(x.p, 32 * b.depth::int) = b.p)) as leaves
      from n a join n b on b.depth >= a.depth and left(b.p, 32 * a.depth::int) = a.p group by a.depth, a.p)
select n.conv_id, n.depth::bigint as depth, k.up as parent_conv_id, n.n::bigint as n_convs, m.kids::bigint as n_children, m.leaves::bigint as n_leaves,
       m.saved::bigint as saved_tokens, sha256(n.ends) as ends_sha256
from n join m using (depth, p) left join k using (depth, p)
"""


@query("op12_prefix_trie", PREFIX_TRIE_SQL)
def op12(spark, sf):
    turns = table(spark, sf, "conversations")
    own = turn_sequences(turns, n_words("text"))
    base, head = F.col("conv") - F.col("conv") % 20, F.crc32(F.col("conv").cast("string")) % 4
    return prefix_trie(rebuilt(own, base, head, most=3))


@query("op13_directly_addressable_ids")
def op13(spark, sf):
    import public_tokenizers

    return token_ids(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
