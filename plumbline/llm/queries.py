"""The registered queries of this subpackage: one per operator, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import html_text, hyperminhash, infill, langid, neighbours, packing, pieces, quality_fm, quality_rules, simhash, toxicity, turns, warc
from plumbline.llm.common import held_out, labelled_sample, table, tokenizer
from plumbline.session import scratch_path


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.detect(spark, table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = quality_rules.fit(labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", quality_rules.SAMPLE_DOCS))
    return quality_rules.judge(docs, field)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = quality_fm.fit(labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", quality_fm.SAMPLE_DOCS))
    return quality_fm.score(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality_fm.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    back = warc.read(spark, path)
    # what was written is measured again where the archive holds it
    own = F.col("record_type") == "response"
    return back.select(
        warc.page_number("record_id").alias("page_id"),
        F.when(own, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(own, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        warc.page_number("refers_to").alias("refers_to"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json")).drop("ids")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", toxicity.SAMPLE_DOCS))
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_hyperminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=5, percent=85)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair(turns.damaged(table(spark, sf_dir, "conversations")))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.transform(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_quality_rules": op2_quality_rules,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_html_extraction": op4_html_extraction,
    "op5_packing": op5_packing,
    "op6_warc": op6_warc,
    "op7_toxicity": op7_toxicity,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_language_id": op9_language_id,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_hyperminhash_near_dedup": op11_hyperminhash_near_dedup,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_fill_in_middle": op13_fill_in_middle,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op6_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ), g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM p)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN largest END AS refers_to
        FROM g
    """,
    "op10_nearest_neighbours": """
        WITH v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
        ), r AS (
            SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s
        )
        SELECT * FROM r WHERE rank <= 20
    """,
    "op13_fill_in_middle": """
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                sha256('1:' || doc_id::VARCHAR) AS h
            FROM documents
        ), g AS (
            SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS x, ('0x' || h[9:16])::BIGINT % (n + 1) AS y,
                CASE WHEN n = 0 OR regexp_matches(t, '<[PSM]>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
                    WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM d
        ), c AS (
            SELECT *, left(t, least(x, y)) AS p, substring(t, least(x, y) + 1, abs(x - y)) AS m, substring(t, greatest(x, y) + 1) AS s
            FROM g
        )
        SELECT doc_id, n, form,
            CASE WHEN form <> 'plain' THEN least(x, y) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN abs(x - y) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
            sha256(t) AS restored_sha256
        FROM c
    """,
}
