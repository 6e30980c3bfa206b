"""The registered queries of these operators, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (bpe, divergence, exact_dedup, fill_middle, fingerprints, line_dedup,
                           ngram_join, packing, pii, quality, sentence_pieces, suffix_dedup,
                           url_filter)
from tallyloom.llm.shared import table

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return bpe.decode(encoded, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, RULES, url_filter.labelled_by_rules(pages, RULES))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"), largest=True)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = fingerprints.with_next(table(spark, sf_dir, "documents"))
    return fingerprints.compared(ordered)


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.groups(table(spark, sf_dir, "documents"), words=4, percent=85)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("n_chars").alias("n_kept_chars"), F.sha2("text", 256).alias("text_sha256"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"),
                       quality.score(model, docs).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= 0.7, 1).otherwise(0))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "loss_tokens")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_middle.transform(table(spark, sf_dir, "documents"))
    return fill_middle.restore(done).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"))


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = sentence_pieces.encode(table(spark, sf_dir, "documents"), path)
    return sentence_pieces.decode(encoded, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_url_filter": op3_url_filter,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_fingerprints": op6_fingerprints,
    "op7_ngram_join": op7_ngram_join,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality": op9_quality,
    "op10_packing": op10_packing,
    "op11_divergence": op11_divergence,
    "op12_fill_middle": op12_fill_middle,
    "op13_sentence_pieces": op13_sentence_pieces,
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    # dense where the operator is sparse: every kept term of a language for each of its sources
    "op11_divergence": """
        WITH d AS (
            SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang,
                   coalesce(source, '') AS source, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
            FROM documents),
        w AS (SELECT i, lang, source, unnest(words) AS term FROM d),
        kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term
                 HAVING count(DISTINCT i) >= 3),
        size AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
        q AS (SELECT lang, term, CAST(1 + (1000000000::HUGEINT * (n + 1)) // (total + v) AS BIGINT)
                     AS q FROM kept JOIN size USING (lang)),
        s AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT s.lang, s.source, k.term, count(w.term) AS n
              FROM s JOIN kept k USING (lang)
              LEFT JOIN w ON w.lang = s.lang AND w.source = s.source AND w.term = k.term
              GROUP BY s.lang, s.source, k.term),
        t AS (SELECT lang, source, sum(n) AS total, count(*) AS v FROM c GROUP BY lang, source),
        p AS (SELECT lang, source, term, n,
                     CAST(1 + (1000000000::HUGEINT * (n + 1)) // (total + v) AS BIGINT) AS p
              FROM c JOIN t USING (lang, source)),
        pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
                  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
                  GROUP BY a.lang, a.source, b.source),
        terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value
                  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
        ranked AS (
            SELECT lang, source, 'pair' AS part, item, CAST(coalesce(value, 0) AS BIGINT) AS value
            FROM (SELECT a.lang, a.source, b.source AS item
                  FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source)
            LEFT JOIN pairs USING (lang, source, item)
            UNION ALL SELECT lang, source, 'term', item, CAST(value AS BIGINT) FROM terms)
        SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part
                                         ORDER BY value DESC, item) AS rank FROM ranked)
        WHERE part = 'pair' OR rank <= 200""",
    "op12_fill_middle": """
        WITH h AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                          sha256('1:' || doc_id) AS x FROM documents),
        g AS (SELECT *, ('0x' || x[1:8])::BIGINT % (n + 1) AS a,
                     ('0x' || x[9:16])::BIGINT % (n + 1) AS b,
                     n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                         OR ('0x' || x[17:24])::BIGINT % 100 >= 90 AS plain,
                     ('0x' || x[25:32])::BIGINT % 100 < 20 AS spm FROM h),
        k AS (SELECT *, least(a, b) AS lo, greatest(a, b) AS hi FROM g),
        m AS (SELECT *, '<P>' || t[1:lo] AS p, '<M>' || t[lo + 1:hi] AS m,
                     '<S>' || t[hi + 1:n] AS s FROM k)
        SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
               CASE WHEN NOT plain THEN lo END AS prefix_chars,
               CASE WHEN NOT plain THEN hi - lo END AS middle_chars,
               sha256(CASE WHEN plain THEN t WHEN spm THEN s || p || m ELSE p || s || m END)
                   AS output_sha256,
               sha256(t) AS restored_sha256 FROM m""",
}
