"""One thin query per operator, over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtline.llm.product_quantisation import embedding_duplicates
    return embedding_duplicates(_table(spark, sf_dir, "embeddings"))


#: The conversation that the formatting query adds: both texts hold marks of the template.
_MARKED = "<|im_end|><|im_start|>assistant ok"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of what is read back from the formatted conversations."""
    from courtline.llm.chat_format import format_chats, loss_text, read_back
    chats = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_MARKED).alias("text"))
    done = format_chats(chats.unionByName(extra)).withColumn("turns", read_back(F.col("formatted"))).withColumn("under", loss_text(F.col("segments")))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), F.length("under").cast("bigint").alias("loss_chars"), F.sha2("under", 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"), "n_blocks")


#: The template's lengths: block start and end, and the mark between merged turns.
_OP2_SQL = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '{marked}' union all select -1, 1, 'assistant', '{marked}'
), marked as (
    select *, case when lag(role) over w is distinct from role then 1 else 0 end as begins,
        replace(replace(text, '\', '\\'), '<|', '<\|') as escaped,
        replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '<\^') as escaped_role
    from turns window w as (partition by conv_id order by turn, role, text)
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    cast(sum(length(escaped) + case when begins = 1 then length('<|im_start|>') + length(escaped_role) + 1 + length('<|im_end|>') + 1 else length('<|im_sep|>') end) as bigint) as formatted_chars,
    cast(sum(begins) as bigint) as n_blocks
from marked group by conv_id
""".replace("{marked}", _MARKED)


def op3_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtline.llm.packing import pack
    return pack(_table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtline.llm.license_scan import scan
    return scan(_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtline.llm.language_id import fit, held_out, identify
    docs = _table(spark, sf_dir, "documents")
    return identify(docs, fit(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")


def op6_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtline.llm.repetition import repetition_rules
    return repetition_rules(_table(spark, sf_dir, "documents"))


def op7_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtline.llm.bwt_dedup import remove_repeats
    return remove_repeats(_table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtline.llm.token_counts import token_counts
    return token_counts(_table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtline.llm.chosen_path import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op10_piece_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode, then decode what was encoded: ids as a hash, the decoded text as size and digest."""
    from courtline.llm.piece_model import decode, encode
    ids = encode(_table(spark, sf_dir, "documents")).withColumn("ids_xxhash64", F.xxhash64("ids"))
    back = decode(ids, keep=("doc_id", "ids_xxhash64", "parity"))
    return back.select("doc_id", "n_tokens", "ids_xxhash64", "parity", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"))


def op11_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtline.llm.url_aliases import filter_urls
    return filter_urls(_table(spark, sf_dir, "pages"))


#: Links with a host, or from the host's root, are resolved here; the test tables hold no other form.
_OP11_SQL = r"""
with recursive rules(verdict, rule) as (values ('block', 'net/'), ('allow', 'example.net/en/'), ('block', 'example.com/de/'), ('allow', 'org/fr/')),
tags as (
    select url, unnest(regexp_extract_all(regexp_replace(html, '<!--.*?(-->|$)|<script\b.*?(</script|$)', ' ', 'gis'), '<(?:link|meta)\b[^<>]*>', 0, 'is')) as tag
    from pages where url is not null and html is not null
), targets as (
    select url, replace(case
        when regexp_matches(tag, '^<link', 'i') and regexp_matches(tag, 'rel\s*=\s*["'']?canonical', 'i') then regexp_extract(tag, 'href\s*=\s*["'']?([^"''\s>]*)', 1, 'i')
        when regexp_matches(tag, '^<meta', 'i') and regexp_matches(tag, 'http-equiv\s*=\s*["'']?refresh', 'i') then regexp_extract(tag, 'url\s*=\s*["'']?([^"''\s>]*)', 1, 'i')
        else '' end, '&amp;', '&') as target from tags
), links as (
    select distinct url as from_url, case when starts_with(target, '//') then regexp_extract(url, '^[^:]*:', 0) || target
        when starts_with(target, '/') then regexp_extract(url, '^.*?://[^/?#]*', 0) || target else target end as to_url
    from targets where target <> ''
), urls as (
    select url, translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') as path, regexp_extract(url, '^[^#]*?://[^#?]*(\?[^#]*)', 1, 's') as query
    from (select url from pages union select from_url from links union select to_url from links) where url is not null
), named as (
    select url, host, path, case when host <> '' then regexp_replace(host, ':(80|443)?$', '') || case when path = '' then '/' else path end || query end as node from urls
), ruled as (
    select n.url, max_by(r.rule, length(r.rule)) as rule, max_by(r.verdict, length(r.rule)) as verdict
    from named n join rules r on (n.host = split_part(r.rule, '/', 1) or ends_with(n.host, '.' || split_part(r.rule, '/', 1))) and starts_with(n.path, substr(r.rule, instr(r.rule, '/')))
    where n.host <> '' group by n.url
), steps as (
    select a.node as x, b.node as y from links l join named a on a.url = l.from_url join named b on b.url = l.to_url where a.node <> b.node
), both_ways as (select x, y from steps union select y, x from steps),
reach(x, y) as (select x, x from both_ways union select r.x, b.y from reach r join both_ways b on r.y = b.x),
by_group as (
    select e.x as node, min(v.verdict) as group_verdict from reach e join named n on n.node = e.y join ruled v on v.url = n.url group by e.x
)
select p.page_id, coalesce(n.host, '') as host, coalesce(n.path, '') as path, v.rule, coalesce(v.verdict, g.group_verdict, 'allow') as verdict,
    case when v.verdict is not null then 'rule' when g.group_verdict is not null then 'alias' else 'default' end as decided_by
from pages p left join named n on n.url = p.url left join ruled v on v.url = p.url left join by_group g on g.node = n.node
"""


def op12_curve_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the number of centroids compared, which depends on the layout."""
    from courtline.llm.curve_clusters import centroid_clusters
    return centroid_clusters(_table(spark, sf_dir, "embeddings")).drop("compared")


def _op12_sql(rounds: int = 3) -> str:
    near = """a{i} as (
    select vec_id, v, min_by(c, d * 16 + c) as c, min(d) as d
    from (select x.vec_id, x.v, k.c, list_dot_product(x.v, x.v) - 2 * list_dot_product(x.v, k.m) + list_dot_product(k.m, k.m) as d from x, k{i} k) group by vec_id, v)"""
    move = """s{i} as (
    select c, list(cast(floor(total / n) as double) order by dim) as m
    from (select c, dim, sum(u) as total, count(*) as n from (select c, unnest(v) as u, unnest(range(1, 65)) as dim from a{i}) group by c, dim) group by c),
k{j} as (select k.c, coalesce(s.m, k.m) as m from k{i} k left join s{i} s using (c))"""
    steps = [f"{near.format(i=i)},\n{move.format(i=i, j=i + 1)}" for i in range(rounds)] + [near.format(i=rounds)]
    return """with x as (
    select vec_id, list_transform(embedding, lambda e: floor(64 * cast(e as double))) as v from embeddings
    where len(embedding) = 64 and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = 64),
k0 as (select row_number() over (order by h) - 1 as c, v as m from (select v, sha256('1:' || vec_id) as h from x order by h limit 16)),
""" + ",\n".join(steps) + f""",
i as (select c, sum(d) as cluster_inertia from a{rounds} group by c)
select vec_id, cast(c as integer) as cluster, cast(d as bigint) as distance, cast(cluster_inertia as bigint) as cluster_inertia,
    cast((select sum(d) from a{rounds}) as bigint) as inertia, sha256(array_to_string(list_transform(m, lambda e: cast(e as bigint)), ',')) as centroid_sha256
from a{rounds} join i using (c) join k{rounds} using (c)
"""


def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtline.llm.word_runs import word_runs
    return word_runs(_table(spark, sf_dir, "documents"), plant=F.crc32(F.col("doc_id").cast("string").cast("binary"))).drop("n_words")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_embedding_duplicates, op2_chat_format, op3_mixture_packing, op4_license_scan, op5_language_id, op6_repetition_rules, op7_bwt_dedup, op8_token_counts, op9_near_duplicates, op10_piece_model, op11_url_aliases, op12_curve_clusters, op13_word_runs)}

#: DuckDB SQL of those that SQL can express.
ORACLES: dict[str, str] = {"op2_chat_format": _OP2_SQL, "op11_url_aliases": _OP11_SQL, "op12_curve_clusters": _op12_sql()}
