"""The operators' queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm import bpe
from starload.llm.centroids import CLUSTERS, ROUNDS, cluster_vectors
from starload.llm.chat import canonical_turns, format_chats, read_chats
from starload.llm.divergence import audit_sources
from starload.llm.exact_dedup import exact_dedup
from starload.llm.minhash import minhash_dedup
from starload.llm.mixing import mix
from starload.llm.secret_scan import scan_secrets
from starload.llm.simhash import simhash_dedup
from starload.llm.substring_dedup import substring_dedup
from starload.llm.topk import search_embeddings
from starload.llm.toxicity import score_toxicity
from starload.llm.url_filter import filter_urls

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
PROBE = "\\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("copies")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_embeddings(table(spark, sf_dir, "embeddings"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], rows.schema)
    chats = format_chats(canonical_turns(rows.unionByName(probe), "conv_id", order="turn"))
    read = read_chats(chats)
    turns = F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def token_digests(docs: DataFrame, rank_path: str | None = None) -> DataFrame:
    """Ids of every text, decoded again; both as digests."""
    ranks = bpe.read_ranks(rank_path or public_tokenizers.path(RANK_FILE))
    both = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)
    return both.select("doc_id", F.floor(F.length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans",
                        "n_cut")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup(table(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash_dedup, op2_source_mix, op3_url_filter, op4_exact_dedup, op5_exact_top_k,
                            op6_chat_format, op7_substring_dedup, op8_byte_bpe, op9_secret_scan, op10_toxicity,
                            op11_minhash_dedup, op12_centroid_clustering, op13_source_divergence)}

# ---------------------------------------------------------------- SQL

SPACE_SQL = r"[\x20\x09-\x0D]"

MIX_SQL = r"""with d as (
  select doc_id, source, coalesce(text, '') as t from documents
), k as (
  select doc_id, source, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) as size,
    -ln((cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), 'null')), 1, 13)) as bigint) + 0.5::double)
        / 4503599627370496.0::double)
    / (0.5::double + 0.5::double * (length(regexp_replace(t, '[!-@\[-`{-~]', '', 'g')) + 1) / (length(t) + 1)) as key
  from d
), s as (
  select source, cast(sum(size) as bigint) as source_size,
    [5.0::double, 2.0::double, 1.0::double][((row_number() over (order by source nulls last) - 1) % 3) + 1] as w
  from k group by source
), c as (
  select *, source_size * 2.0::double as cap from s
), l as (
  select *, (sum(source_size) over () * 1.5::double
             - coalesce(sum(cap) over (order by cap / w, source nulls last
                                       rows between unbounded preceding and 1 preceding), 0))
          / (sum(w) over () - coalesce(sum(w) over (order by cap / w, source nulls last
                                       rows between unbounded preceding and 1 preceding), 0)) as level
  from c
), t as (
  select source, source_size, case when cap / w <= level then cap
    else w * max(case when cap / w > level then level end) over () end as target
  from l
), e as (
  select *, case when source_size > 0 then floor(target / source_size) else 1 end as epochs from t
), b as (
  select *, target - epochs * source_size as budget from e
), p as (
  select k.*, b.source_size, b.target, b.epochs, b.budget,
    case when k.size * 200.0::double > b.budget then length(bin(k.size)) else 0 end as stratum
  from k join b on k.source is not distinct from b.source
), r as (
  select *, coalesce(sum(size) over (partition by source, stratum order by key, doc_id, size
                                     rows between unbounded preceding and 1 preceding), 0) + size / 2.0::double as middle,
    sum(size) over (partition by source, stratum) as stratum_words
  from p
), x as (
  select *, stratum > 0 and size > 0 and middle <= budget * stratum_words::bigint / source_size as long_extra from r
), y as (
  select *, coalesce(sum(size) filter (where long_extra) over (partition by source), 0) as spent from x
)
select doc_id, cast(size as bigint) as size, source, source_size, target,
  cast(size * (epochs + case when long_extra or (stratum = 0 and size > 0 and middle <= budget - spent)
                             then 1 else 0 end) as bigint) as taken
from y"""

URL_SQL = r"""with u as (
  select page_id, case when strpos(coalesce(url, ''), '://') > 0
                       then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), h as (
  select page_id, regexp_extract(rest, '^[^?#]*') as head from u
), p as (
  select page_id, regexp_extract(head, '^[^/]*') as raw, substr(head, length(regexp_extract(head, '^[^/]*')) + 1) as path
  from h
), n as (
  select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from p
), v as (
  select *, case
    when ('.' || host) like '%.example.net' and starts_with(path, '/en/') then 'example.net/en/'
    when ('.' || host) like '%.example.com' and starts_with(path, '/de/') then 'example.com/de/'
    when ('.' || host) like '%.org' and starts_with(path, '/fr/') then 'org/fr/'
    when ('.' || host) like '%.net' and starts_with(path, '/') then 'net/' end as rule from n
)
select page_id, host, path, rule,
  case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict from v"""

EXACT_SQL = r"""with n as (
  select doc_id, length(coalesce(text, '')) as chars,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from documents
), g as (
  select *, count(*) over (partition by text_sha256) as group_size,
    first_value(doc_id) over (partition by text_sha256 order by chars desc, doc_id) as keep_id from n
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from g"""

TOP_SQL = """with v as materialized (
  select row_number() over () as row, vec_id,
    list_transform(embedding, lambda e: cast(floor(64 * cast(e as double)) as bigint)) as x
  from embeddings
  where vec_id is not null and embedding is not null
    and list_count(list_filter(embedding, lambda e: e is not null and isfinite(e))) = len(embedding)
), s as (
  select q.row as query, q.vec_id as query_id, c.vec_id as vec_id,
    cast(list_dot_product(cast(q.x as double[]), cast(c.x as double[])) as bigint) as score
  from v q join v c on q.vec_id % 20 = 0 and c.row <> q.row
), r as (
  select query_id, cast(row_number() over (partition by query order by score desc, vec_id) as integer) as rank,
    vec_id, score from s
)
select * from r where rank <= 20"""

CHAT_SQL = r"""with c as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), f as (
  select *, regexp_replace(text, '(\\*</?turn)', '\\\1', 'g') as body from c
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length('<turn ') + length(role) + length('>') + 1 + length(body) + 1 + length('</turn>') + 1) as bigint)
    as formatted_chars
from f group by conv_id"""

MINHASH_SQL = r"""with recursive d as (
  select row_number() over () as row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), s as (
  select row, doc_id, list_sort(list_distinct(case when len(w) > 1
    then list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) else w end)) as shingles from d
), m as materialized (
  select row_number() over () as node, shingles, len(shingles) as n, min(doc_id) as least
  from s where len(shingles) > 0 group by shingles
), i as materialized (
  select node, n, unnest(shingles) as shingle from m
), e as materialized (
  select a.node as x, b.node as y from i a join i b
    on a.shingle = b.shingle and a.node < b.node and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  group by a.node, a.n, b.node, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
), both_ways as (
  select x, y from e union all select y, x from e
), reach as (
  select node, node as other from m
  union
  select r.node, b.y from reach r join both_ways b on r.other = b.x
), c as (
  select r.node, min(m.least) as component_id from reach r join m on r.other = m.node group by r.node
)
select s.doc_id, cast(len(s.shingles) as bigint) as n_shingles,
  case when m.node is null then s.doc_id else c.component_id end as component_id,
  s.doc_id is not distinct from (case when m.node is null then s.doc_id else c.component_id end) as kept
from s left join m on s.shingles = m.shingles left join c on c.node = m.node"""


def _cluster_sql() -> str:
    """Rounds of nearest centroid and componentwise floor of the mean. Products
    of whole components are exact as doubles."""
    parts = [f"""with v as materialized (
  select row_number() over () as row, vec_id,
    list_transform(embedding, lambda e: cast(floor(256 * cast(e as double)) as bigint)) as x
  from embeddings where len(embedding) = 64
    and list_count(list_filter(embedding, lambda e: e is not null and isfinite(cast(e as double)))) = 64
), c0 as materialized (
  select cast(row_number() over (order by sha256('2:' || vec_id) nulls last, x) - 1 as integer) as cluster, x
  from v qualify cluster < {CLUSTERS}
)"""]
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} as materialized (
  select v.row, v.vec_id, v.x, c.cluster, cast(list_inner_product(
    list_transform(list_zip(v.x, c.x), lambda p: cast(p[1] - p[2] as double)),
    list_transform(list_zip(v.x, c.x), lambda p: cast(p[1] - p[2] as double))) as bigint) as distance
  from v, c{r} c
  qualify row_number() over (partition by v.row order by distance, c.cluster) = 1
)""")
        if r < ROUNDS:
            parts.append(f"""c{r + 1} as materialized (
  select c.cluster, coalesce(m.x, c.x) as x from c{r} c left join (
    select cluster, list(mean order by dim) as x from (
      select cluster, dim, cast(floor(sum(part) / count(*)::double) as bigint) as mean
      from (select cluster, unnest(x) as part, generate_subscripts(x, 1) as dim from a{r})
      group by cluster, dim) group by cluster) m on m.cluster = c.cluster
)""")
    return ",\n".join(parts) + f"""
select a.vec_id, a.cluster, a.distance, cast(sum(a.distance) over (partition by a.cluster) as bigint) as cluster_inertia,
  cast(sum(a.distance) over () as bigint) as inertia, sha256(array_to_string(c.x, ',')) as centroid_sha256
from a{ROUNDS} a join c{ROUNDS} c on a.cluster = c.cluster"""


DIVERGENCE_SQL = r"""with d as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as t
  from documents
), w as (
  select row, lang, source, unnest(regexp_extract_all(
    translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d
), k as materialized (
  select lang, term, count(*) as n from w group by lang, term having count(distinct row) >= 30
), g as materialized (
  select distinct lang, source from d
), n as materialized (
  select lang, source, term, count(*) as n from w join k using (lang, term) group by lang, source, term
), v as (
  select g.lang, g.source, (select count(*) from k where k.lang = g.lang) as v,
    coalesce((select sum(n) from n where n.lang = g.lang and n.source = g.source), 0) as total,
    coalesce((select sum(n) from k where k.lang = g.lang), 0) as lang_total from g
), p as materialized (
  select v.lang, v.source, k.term, coalesce(n.n, 0) as n,
    cast(1 + (1000000000::hugeint * (coalesce(n.n, 0) + 5)) // (v.total + 5 * v.v)::hugeint as bigint) as p,
    cast(1 + (1000000000::hugeint * (k.n + 5)) // (v.lang_total + 5 * v.v)::hugeint as bigint) as q
  from v join k on k.lang = v.lang left join n on n.lang = v.lang and n.source = v.source and n.term = k.term
), f as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce((
    select sum(abs(x.p - y.p)) from p x join p y on x.lang = y.lang and x.term = y.term
    where x.lang = a.lang and x.source = a.source and y.source = b.source), 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  union all
  select lang, source, 'term', term, p - q from p where n > 0 and p > q
), r as (
  select lang, source, part, item, cast(value as bigint) as value,
    cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank from f
)
select * from r where part = 'pair' or rank <= 50"""

ORACLES: dict[str, str] = {
    "op2_source_mix": MIX_SQL, "op3_url_filter": URL_SQL, "op4_exact_dedup": EXACT_SQL,
    "op5_exact_top_k": TOP_SQL, "op6_chat_format": CHAT_SQL,
    "op11_minhash_dedup": MINHASH_SQL, "op12_centroid_clustering": _cluster_sql(), "op13_source_divergence": DIVERGENCE_SQL,
}
