"""Registered plans: keyword retrieval, TF-IDF keywords, character profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import label_width, upper_ascii_count, utf16_length, wide_count, first_line, py_strip
from ..operators.retrieve import keyword_retrieve, keyword_topk
from ..sources.terms import index_retrieve, index_topk, write_postings
from .registry import register, table
from .sources import benchmark_queries, document_blocks
from .sqltext import TOK, doc_filename, rest, strip

KEYWORD_THRESHOLD = 0.3

_BLOCKS_SQL = f"""
  blocks AS (
    SELECT {doc_filename()} AS filename, {strip('text')} AS content, 0 AS order_index
    FROM documents WHERE {strip('text')} <> ''
  )"""

KEYWORD_RETRIEVE_SQL = f"""
WITH {_BLOCKS_SQL},
  files AS (
    SELECT filename, max(CASE WHEN order_index = 0 THEN split_part(content, chr(10), 1) END) AS title
    FROM blocks GROUP BY filename
  ),
  name_t AS (SELECT DISTINCT filename, term FROM (
    SELECT filename, unnest(regexp_extract_all(filename, '{TOK}')) AS term FROM files)),
  title_t AS (SELECT DISTINCT filename, term FROM (
    SELECT filename, unnest(regexp_extract_all(coalesce(title, ''), '{TOK}')) AS term FROM files)),
  body_tok AS (
    SELECT filename, unnest(regexp_extract_all(
      CASE WHEN order_index = 0 THEN {rest('content')} ELSE content END, '{TOK}')) AS term
    FROM blocks
  ),
  tf AS (SELECT filename, term, count(*) AS tf FROM body_tok GROUP BY filename, term),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
  nd AS (SELECT CAST(count(DISTINCT filename) AS DOUBLE) AS n FROM tf),
  body_t AS (
    SELECT filename, term FROM (
      SELECT tf.filename, tf.term,
             row_number() OVER (PARTITION BY tf.filename ORDER BY round(tf.tf * ln(nd.n / df.df), 9) DESC, tf.term) AS rk
      FROM tf JOIN df ON tf.term = df.term CROSS JOIN nd
    ) WHERE rk <= 20
  ),
  parts AS (
    SELECT filename, 'name' AS part, term FROM name_t
    UNION ALL SELECT filename, 'title' AS part, term FROM title_t
    UNION ALL SELECT filename, 'body' AS part, term FROM body_t
  ),
  q AS (SELECT DISTINCT query_id, term FROM (
    SELECT item_id AS query_id, unnest(regexp_extract_all(text, '{TOK}')) AS term FROM benchmark)),
  qs AS (SELECT item_id AS query_id, CAST(len(list_distinct(regexp_extract_all(text, '{TOK}'))) AS DOUBLE) AS q_size
         FROM benchmark),
  hits AS (
    SELECT q.query_id, parts.filename,
           count(*) FILTER (WHERE part = 'name') AS n_name,
           count(*) FILTER (WHERE part = 'title') AS n_title,
           count(*) FILTER (WHERE part = 'body') AS n_body
    FROM parts JOIN q ON parts.term = q.term GROUP BY q.query_id, parts.filename
  )
SELECT query_id, filename,
       round(n_name / q_size, 6) AS score_name, round(n_title / q_size, 6) AS score_title,
       round(n_body / q_size, 6) AS score_body,
       round(greatest(n_name / q_size, n_title / q_size, n_body / q_size), 6) AS score
FROM hits JOIN qs USING (query_id)
WHERE greatest(n_name / q_size, n_title / q_size, n_body / q_size) > {KEYWORD_THRESHOLD}
"""


@register("keyword_retrieve", KEYWORD_RETRIEVE_SQL)
def q_keyword_retrieve(spark, sf_dir):
    """Every benchmark text as a query against every document file; files scoring above 0.3."""
    return keyword_retrieve(document_blocks(spark, sf_dir), benchmark_queries(spark, sf_dir),
                            threshold=KEYWORD_THRESHOLD)


KEYWORD_TOPK_SQL = f"""
WITH tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{TOK}')) AS term FROM documents),
  tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY doc_id, term),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
  nd AS (SELECT CAST(count(DISTINCT doc_id) AS DOUBLE) AS n FROM tf),
  w AS (SELECT tf.doc_id, tf.term, tf.tf * ln(nd.n / df.df) AS weight
        FROM tf JOIN df ON tf.term = df.term CROSS JOIN nd)
SELECT doc_id, CAST(rank AS INTEGER) AS rank, term, round(weight, 6) AS weight FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(weight, 9) DESC, term) AS rank FROM w
) WHERE rank <= 20
"""


@register("keyword_topk", KEYWORD_TOPK_SQL)
def q_keyword_topk(spark, sf_dir):
    """Top-20 TF-IDF keywords of every document (lower-cased tokens, corpus IDF)."""
    return keyword_topk(table(spark, sf_dir, "documents"), "doc_id", "text", k=20, lower=True)


def _sql_counts(x: str) -> str:
    wide = f"(length(regexp_replace({x}, '[\\x{{0}}-\\x{{FF}}]', '', 'g')) + " \
           f"length(regexp_replace({x}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"
    upper = f"length(regexp_replace({x}, '[^A-Z]', '', 'g'))"
    u16 = f"(length({x}) + length(regexp_replace({x}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"
    return wide, upper, u16


def _char_profile_sql() -> str:
    x = f"split_part({strip('text')}, chr(10), 1)"
    wide, upper, u16 = _sql_counts("title")
    rest_n = f"({u16} - {wide} - {upper})"
    return f"""
SELECT doc_id, title, CAST({wide} AS INTEGER) AS n_wide, CAST({upper} AS INTEGER) AS n_upper,
       CAST({u16} AS INTEGER) AS n_units,
       CAST({wide} * 16 + {upper} * 8 + {rest_n} * 10 + 40 AS INTEGER) AS width_head,
       CAST({wide} * 13 + {upper} * 8 + {rest_n} * 5 + 50 AS INTEGER) AS width_level2,
       CAST({wide} * 12 + {upper} * 8 + {rest_n} * 5 + 30 AS INTEGER) AS width_level3
FROM (SELECT doc_id, {x} AS title FROM documents)
"""


@register("char_profile", _char_profile_sql())
def q_char_profile(spark, sf_dir):
    """Character classes and drawn label widths (per tree level) of each document's first line."""
    docs = table(spark, sf_dir, "documents").select("doc_id", first_line(py_strip("text")).alias("title"))
    t = F.col("title")
    return docs.select(
        "doc_id", "title", wide_count(t).alias("n_wide"), upper_ascii_count(t).alias("n_upper"),
        utf16_length(t).alias("n_units"), label_width(t, 1).alias("width_head"),
        label_width(t, 2).alias("width_level2"), label_width(t, 3).alias("width_level3"))


@register("index_retrieve", KEYWORD_RETRIEVE_SQL)
def q_index_retrieve(spark, sf_dir):
    """Keyword retrieval of every benchmark text from a persisted term index of the documents."""
    name = write_postings(document_blocks(spark, sf_dir))
    return index_retrieve(spark, name, benchmark_queries(spark, sf_dir), KEYWORD_THRESHOLD)


@register("index_topk", f"""
WITH t AS (SELECT {doc_filename()} AS filename, unnest(regexp_extract_all({rest(strip('text'))}, '{TOK}')) AS term FROM documents),
  tf AS (SELECT filename, term, count(*) AS tf FROM t GROUP BY filename, term),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
  w AS (SELECT filename, term, tf * ln((SELECT count(DISTINCT filename) FROM tf)::DOUBLE / df) AS weight FROM tf JOIN df USING (term))
SELECT filename, CAST(row_number() OVER (PARTITION BY filename ORDER BY round(weight, 9) DESC, term) AS INTEGER) AS rank, term, round(weight, 6) AS weight
FROM w QUALIFY rank <= 20""")
def q_index_topk(spark, sf_dir):
    """The 20 heaviest body terms of every document from a persisted term index."""
    return index_topk(spark, write_postings(document_blocks(spark, sf_dir)))
