"""Registered queries of the pipeline operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataward.llm import check_sql
from strataward.llm.common import prepare, table
from strataward.plans.registry import Registry

REGISTRY = Registry()


@REGISTRY.query("op1_decontaminate")
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataward.llm.contamination import decontaminate

    prepare(spark)
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@REGISTRY.query("op2_minhash_dedup")
def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataward.llm.minhash import minhash_dedup

    return minhash_dedup(table(prepare(spark), sf_dir, "documents"))


@REGISTRY.query(
    "op3_chat_format",
    r"""
    WITH turns AS (
      SELECT conv_id::BIGINT conv_id, turn::BIGINT turn, coalesce(role, '') role, coalesce("text", '') t FROM conversations
      UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), parts AS (
      SELECT *, length(role) + 4 + length(regexp_replace(t, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g')) + 4 AS chars FROM turns
    )
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
      coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
      sum(chars)::BIGINT AS formatted_chars
    FROM parts GROUP BY conv_id
    """,
)
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataward.llm.chat import digests, segments, with_control_turns

    prepare(spark)
    return digests(segments(with_control_turns(spark, table(spark, sf_dir, "conversations"))))


@REGISTRY.query("op4_pack")
def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataward.llm.packing import pack_documents

    return pack_documents(table(prepare(spark), sf_dir, "documents"))


@REGISTRY.query("op5_shard")
def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataward.llm.shard import shard_documents

    return shard_documents(table(prepare(spark), sf_dir, "documents"), shards=24)


@REGISTRY.query(
    "op6_exact_dedup",
    r"""
    WITH d AS (SELECT doc_id, regexp_replace(coalesce("text", ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
    SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
      doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
    FROM d
    """,
)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataward.llm.exact_dedup import exact_dedup

    return exact_dedup(table(prepare(spark), sf_dir, "documents"))


@REGISTRY.query("op7_language")
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataward.llm.language import identify

    return identify(table(prepare(spark), sf_dir, "documents"))


@REGISTRY.query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataward.llm.toxicity import document_labels, score_documents

    return score_documents(table(prepare(spark), sf_dir, "documents"), document_labels(spark, sf_dir))


@REGISTRY.query(
    "op9_url_filter",
    r"""
    WITH p AS (
      SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
      FROM pages
    ), rules(h, q, v) AS (
      VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
    )
    SELECT page_id, host, path, h || q AS "rule",
      coalesce(v, CASE WHEN regexp_matches(host || path, '(^|[^\p{L}\p{N}])(adserver|casino|porn|xxx)([^\p{L}\p{N}]|$)') THEN 'block' ELSE 'allow' END) AS verdict
    FROM p LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q)
    QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(h || q) DESC NULLS LAST) = 1
    """,
)
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataward.llm.urls import HOST_RULES, WORD_RULES, judge_urls, rule_table

    prepare(spark)
    return judge_urls(table(spark, sf_dir, "pages"), rule_table(spark, [*HOST_RULES, *WORD_RULES]))


@REGISTRY.query("op10_substring_dedup")
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataward.llm.repeats import substring_dedup

    return substring_dedup(table(prepare(spark), sf_dir, "documents")).drop("kept_text")


@REGISTRY.query("op11_prefix_trie", check_sql.prefix_trie())
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataward.llm.prefix_trie import prefix_trie

    return prefix_trie(table(prepare(spark), sf_dir, "conversations"))


@REGISTRY.query("op12_token_counts")
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataward.llm.token_counts import count_tokens, tokenizer_path

    return count_tokens(table(prepare(spark), sf_dir, "documents"), tokenizer_path())


@REGISTRY.query("op13_turn_repair", check_sql.turn_repair())
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataward.llm.turn_repair import repair_turns

    return repair_turns(table(prepare(spark), sf_dir, "conversations"))


def all_queries() -> dict:
    return REGISTRY.queries


def all_oracles() -> dict[str, str]:
    return REGISTRY.oracles
