"""Registered queries of the corpus operators, with their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorewell.llm.common import table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from scorewell.llm.mixing import PLAN, mix_table

    return mix_table(table(spark, sf_dir, "documents"), PLAN)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from scorewell.llm.warc import archive_table

    return archive_table(table(spark, sf_dir, "pages"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from scorewell.llm.token_file import token_table

    return token_table(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from scorewell.llm.licenses import scan

    return scan(table(spark, sf_dir, "documents")).drop("detections")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from scorewell.llm.langid import language_table

    return language_table(table(spark, sf_dir, "documents"))


def op8_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from scorewell.llm.hmm_lm import score_table

    return score_table(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from scorewell.llm.secrets_crf import scan

    return scan(table(spark, sf_dir, "documents")).drop("secrets")


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from scorewell.llm.lsh_forest import nearest_table

    return nearest_table(table(spark, sf_dir, "embeddings"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from scorewell.llm.decontam import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from scorewell.llm.jaccard_join import component_table

    return component_table(table(spark, sf_dir, "documents"))


def op11_importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    from scorewell.llm.importance import resampled

    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from scorewell.llm.centroids import cluster_table

    return cluster_table(table(spark, sf_dir, "embeddings"))


def op13_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from scorewell.llm.packing import packed

    return packed(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {
    "op3_jaccard_join": op3_jaccard_join,
    "op4_decontaminate": op4_decontaminate,
    "op6_nearest": op6_nearest,
    "op10_secret_scan": op10_secret_scan,
    "op8_hmm_scores": op8_hmm_scores,
    "op2_language_id": op2_language_id,
    "op7_license_scan": op7_license_scan,
    "op1_mix_sources": op1_mix_sources,
    "op5_warc": op5_warc,
    "op9_token_files": op9_token_files,
    "op11_importance_draw": op11_importance_draw,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_pack": op13_pack,
}


def oracles() -> dict[str, str]:
    from scorewell.llm.centroids import cluster_sql
    from scorewell.llm.importance import resampled_sql
    from scorewell.llm.mixing import PLAN, mix_sql

    return {
        "op11_importance_draw": resampled_sql(),
        "op12_centroid_clusters": cluster_sql(),
        "op1_mix_sources": f"""WITH {mix_sql(PLAN)}
SELECT doc_id, domain, language AS lang, origin AS source, CAST(n_tokens AS BIGINT) AS n_tokens,
    CAST(quota AS BIGINT) AS quota, copies FROM mixed WHERE copies > 0""",
        "op5_warc": """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS keeper FROM p)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to FROM k""",
    }
