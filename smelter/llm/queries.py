"""Registered queries of the training-data operators, one per operator, each
over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from smelter.llm import chat_format, exact_dedup, fuzzy_lines, hard_negatives, jaccard_join, language_id, mixing, quality_gam, quality_rules, sentencepiece_bpe, spelling, substring_dedup, warc
from smelter.llm.common import documents
from smelter.session import scratch_dir

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_exact_dedup(spark, sf_dir):
    """Copies of each document up to ASCII case; the largest doc_id stays."""
    return exact_dedup.decisions(documents(spark, sf_dir))


#: ASCII-only lower-casing in DuckDB, whose lower() folds other letters too.
_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES["op1_exact_dedup"] = f"""
WITH d AS (SELECT doc_id, {_NORM} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size,
             sha256(norm) AS text_sha256, md5(norm) AS content_hash FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256, content_hash
FROM d JOIN g USING (norm)
"""


@query
def op7_jaccard_join(spark, sf_dir):
    """Near-duplicate class of every document by 5-word shingles."""
    return jaccard_join.classes_of(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


@query
def op8_fuzzy_lines(spark, sf_dir):
    """Lines of every document that repeat an earlier line up to small edits."""
    return fuzzy_lines.decisions(documents(spark, sf_dir), short=True).select("doc_id", "n_lines", "n_removed", "removed_lines")


@query
def op9_mix_sources(spark, sf_dir):
    """How many words of each document a weighted mix of all sources takes."""
    docs = documents(spark, sf_dir)
    mixed = mixing.mix(docs, mixing.word_count(F.col("text")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "epochs")


@query
def op2_substring_dedup(spark, sf_dir):
    """Bytes of every document in 200-byte strings that occur elsewhere."""
    return substring_dedup.remove_repeats(documents(spark, sf_dir))


def _fold(df, parts: int):
    """The remainder that splits learnt from held-out documents."""
    return F.crc32(df["doc_id"].cast("string").cast("binary")) % parts


@query
def op3_language_id(spark, sf_dir):
    """Language of every document; learnt from three quarters of them."""
    docs = documents(spark, sf_dir)
    model = language_id.fit(docs.where(_fold(docs, 4) != 2))
    found = language_id.predict(docs, model)
    return found.withColumn("held_out", F.coalesce(_fold(found, 4) == 2, F.lit(False)))


@query
def op4_sentencepiece(spark, sf_dir):
    """Piece ids of every text, with the end id, and the text decoded again."""
    return sentencepiece_bpe.encode_documents(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op5_quality_rules(spark, sf_dir):
    """Text statistics of every document and the verdict of learned rules."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rules = quality_rules.learn_list(quality_rules.labelled_rates(docs, labels))
    return quality_rules.decide(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


@query
def op6_quality_classifier(spark, sf_dir):
    """Quality score of every document; a fifth of them is held out."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_gam.fit(docs, labels.where(_fold(labels, 5) != 0))
    found = quality_gam.predict(docs, model)
    return (found.withColumn("held_out", F.coalesce(_fold(found, 5) == 0, F.lit(False)))
            .withColumn("predicted", (F.col("score") >= 0.3).cast("int")))


@query
def op10_chat_format(spark, sf_dir):
    """Rendered pieces of all conversations, roles repaired at least cost."""
    return chat_format.repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query
def op11_warc(spark, sf_dir):
    """All pages written as WARC archives and read back."""
    path = scratch_dir(spark, "warc")
    warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return warc.read_records(spark, path)


ORACLES["op11_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest,
             min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to,
       true AS intact
FROM s
"""


@query
def op12_spelling_variants(spark, sf_dir):
    """Words of all documents, their neighbours, forms and roots."""
    return spelling.variant_groups(documents(spark, sf_dir))


@query
def op13_hard_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector against all."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(rows["vec_id"] % 7 == 0, (rows["label"] + 1) % 10).otherwise(rows["label"])
    return hard_negatives.mine(rows, rows["vec_id"] % 100 == 0, label=label)


ORACLES["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id,
       positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
           AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 5
"""
