"""Registered queries of the training-data operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (alignment, bpe, chat, embeddings, fingerprints, htmltext, language, lines, packing, repair, shingle_join,
               substring, toxicity)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_embedding_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                         public_tokenizers.PATTERN)
    return bpe.digests(encoded)


@query
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


ORACLES["op3_chat_format"] = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text, role IS NULL AS no_role, text IS NULL AS no_text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS pos FROM t),
c AS (SELECT conv_id, count(*) AS n, list(concat(no_role, '|', no_text, '|', role, '|', text) ORDER BY pos) AS turns FROM o GROUP BY conv_id),
gone AS (SELECT DISTINCT a.conv_id FROM c a JOIN c b ON a.turns[1] = b.turns[1] AND a.conv_id <> b.conv_id AND a.n <= b.n
         AND a.turns = b.turns[1:a.n] AND (a.n < b.n OR b.conv_id < a.conv_id))
SELECT o.conv_id, pos // 256 AS part, max(c.n) AS n_turns,
       string_agg('<|im_start|>' || o.role || chr(10) || o.text || '<|im_end|>' || chr(10), '' ORDER BY pos) AS rendered
FROM o JOIN c USING (conv_id) WHERE o.conv_id NOT IN (SELECT conv_id FROM gone) GROUP BY o.conv_id, pos // 256
"""


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents"))


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out())
    model = language.fit(docs.where("not held_out"))
    return language.identify(docs, model, carry=("doc_id", "held_out"))


@query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(substring.remove_repeats(table(spark, sf_dir, "documents")))


@query
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.near_groups(table(spark, sf_dir, "documents"))


@query
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digests(alignment.alignments(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                                  public_tokenizers.path("piece_bpe_32k.model")))


@query
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", toxicity.held_out())
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    model = toxicity.fit(docs.where("not held_out"), labels)
    return toxicity.score(docs, model, carry=("doc_id", "held_out"))


@query
def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digests(*repair.repair(table(spark, sf_dir, "conversations")))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
