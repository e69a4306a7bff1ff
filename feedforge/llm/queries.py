"""The registered queries of this subpackage, with SQL where it can express them.

Each query applies one operator, with production parameters, to its whole table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontamination, language_id, language_model, merkle_manifest, piece_codec, prefix_trie,
               quality_classifier, simhash_dedup, substring_dedup, token_counts, topk_search, toxicity, url_filter)
from .tree_sql import MERKLE_SQL, PREFIX_TRIE_SQL

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_RANKS = "byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality_classifier.score_quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return scored.drop("text_key")


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    outcomes = url_filter.outcomes_by_number(pages, _table(spark, folder, "labels"))
    return url_filter.judge_urls(pages, outcomes).select("page_id", "host", "path", "rule", "verdict")


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.predict_languages(_table(spark, folder, "documents")).drop("languages")


def op5_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_dedup.near_duplicates(_table(spark, folder, "documents"))


def op6_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.top_k(_table(spark, folder, "embeddings"))


def op7_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score_texts(_table(spark, folder, "documents"))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.without_repeats(_table(spark, folder, "documents")).select(
        "doc_id", "text", "n_sentences", "n_removed")


def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    encoded = piece_codec.encode_and_decode(_table(spark, folder, "documents"), public_tokenizers.path(PIECE_MODEL))
    return piece_codec.digests(encoded)


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(
        _table(spark, folder, "documents"), public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, folder, "conversations"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_manifest.manifest(_table(spark, folder, "documents"))


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score_toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.col("offending.position").alias("offending"))


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_decontamination, op3_url_filter, op4_language_id, op5_simhash_dedup,
    op6_topk_search, op7_language_model, op8_substring_dedup, op9_sentencepiece, op10_token_counts,
    op11_prefix_trie, op12_merkle_manifest, op13_toxicity)}

_SUFFIX = r"""case when length(split_part(host, '.', -1)) = 2
    and split_part(host, '.', -2) in ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org')
    then 2 else 1 end"""

URL_FILTER_SQL = rf"""
with parsed as (
  select page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') as path
  from pages),
labelled as (
  select p.page_id, min((l.quality = 1 and l.toxic = 0)::int) as good, max((l.quality = 1 and l.toxic = 0)::int) as most
  from parsed p join labels l
    on l.doc_id = try_cast(nullif(regexp_extract(p.path, '/([0-9]{{1,18}})(?:\.html)?/?$', 1), '') as bigint)
  group by p.page_id),
outcomes as (
  select p.*, case when good = most then good end as good from parsed p left join labelled using (page_id)),
host_counts as (
  select host, count(good)::double as n, coalesce(sum(good), 0)::double as k,
    array_to_string(list_slice(string_split(host, '.'), -(({_SUFFIX})), -1), '.') as suffix,
    array_to_string(list_slice(string_split(host, '.'), -(({_SUFFIX}) + 1), -1), '.') as domain
  from outcomes group by host),
domain_counts as (select domain, suffix, sum(n) as n, sum(k) as k from host_counts group by domain, suffix),
suffix_counts as (
  select suffix, sum(n) as n, sum(k) as k,
    (select (sum(k) + 1) / (sum(n) + 2) from host_counts) as prior
  from domain_counts group by suffix),
suffix_strength as (
  select 1 / least(0.5, greatest(1 / 1001, coalesce(
    sum(pow(k - n * prior, 2) - n * prior * (1 - prior)) / nullif(sum(n * prior * (1 - prior) * (n - 1)), 0), 0.5))) - 1 as s
  from suffix_counts),
suffix_means as (select suffix, (k + s * prior) / (n + s) as prior from suffix_counts, suffix_strength),
domain_priors as (select d.*, m.prior from domain_counts d join suffix_means m using (suffix)),
domain_strength as (
  select 1 / least(0.5, greatest(1 / 1001, coalesce(
    sum(pow(k - n * prior, 2) - n * prior * (1 - prior)) / nullif(sum(n * prior * (1 - prior) * (n - 1)), 0), 0.5))) - 1 as s
  from domain_priors),
domain_means as (select domain, (k + s * prior) / (n + s) as prior from domain_priors, domain_strength),
host_priors as (select h.*, m.prior from host_counts h join domain_means m using (domain)),
host_strength as (
  select 1 / least(0.5, greatest(1 / 1001, coalesce(
    sum(pow(k - n * prior, 2) - n * prior * (1 - prior)) / nullif(sum(n * prior * (1 - prior) * (n - 1)), 0), 0.5))) - 1 as s
  from host_priors),
reputation as (select host, (k + s * prior) / (n + s) as mean, n + s as evidence from host_priors, host_strength),
ruled as (
  select p.page_id, p.host, p.path,
    case
      when host = 'www.example.com' or host like '%.www.example.com' then
        case when starts_with(path, '/en/') then 'www.example.com/en/' when starts_with(path, '/') then 'com/' end
      when host = 'example.com' or host like '%.example.com' then
        case when starts_with(path, '/en/') then 'example.com/en/' when starts_with(path, '/') then 'com/' end
      when host = 'com' or host like '%.com' then case when starts_with(path, '/') then 'com/' end
      when host = 'net' or host like '%.net' then
        case when starts_with(path, '/es/') then 'net/es/' when starts_with(path, '/fr/') then 'net/fr/' end
    end as rule
  from parsed p)
select page_id, host, path, rule,
  case when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block'
    when mean + 1.645 * sqrt(mean * (1 - mean) / (evidence + 1)) < 0.5 then 'block' else 'allow' end as verdict
from ruled join reputation using (host)
"""

TOP_K_SQL = """
with valid as materialized (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.row, a.vec_id as query_id, b.vec_id, list_dot_product(a.q::double[], b.q::double[])::bigint as score
  from valid a join valid b on a.row <> b.row
  where a.vec_id % 50 = 0),
ranked as (
  select *, row_number() over (partition by row order by score desc, vec_id)::int as rank from scores)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

ORACLES = {"op3_url_filter": URL_FILTER_SQL, "op6_topk_search": TOP_K_SQL,
           "op11_prefix_trie": PREFIX_TRIE_SQL, "op12_merkle_manifest": MERKLE_SQL}
