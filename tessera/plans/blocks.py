"""Registered plans: block table and its text views (conversations as files, turns as blocks)."""

from __future__ import annotations


from ..functions.text import SENTENCE_CLOSERS
from ..operators.blocks import (export_clean, file_text, merged_pages, paragraphs, preview, prompt_corpus,
                                retrieval_record)
from .registry import register, table
from .sources import conversation_blocks
from .sqltext import LINES, conv_filename, strip

BLOCKS_SQL = f"""
  blocks AS (
    SELECT {conv_filename()} AS filename, '.txt' AS filetype, {strip('text')} AS content, role AS content_type,
           CAST(turn AS INTEGER) AS order_index, CAST(0 AS BIGINT) AS ingest_seq
    FROM conversations WHERE {strip('text')} <> ''
  )"""


@register("block_table", f"WITH {BLOCKS_SQL} SELECT * FROM blocks")
def q_block_table(spark, sf_dir):
    """Conversation turns as blocks: blank turns dropped, the rest stripped, order kept with gaps."""
    return conversation_blocks(spark, sf_dir)


@register("prompt_corpus", f"""WITH {BLOCKS_SQL}
SELECT filename,
       '====文件名：' || filename || '====\n\n' ||
       string_agg('信息类型: ' || {strip('content_type')} || '\n内容：' || {strip('content')} || '\n\n', ''
                  ORDER BY ingest_seq, order_index) AS corpus
FROM blocks GROUP BY filename""")
def q_prompt_corpus(spark, sf_dir):
    """Per file: the header and the typed rows in append order."""
    return prompt_corpus(conversation_blocks(spark, sf_dir))


@register("file_text", f"""WITH {BLOCKS_SQL}
SELECT filename,
       '\n=== 📄 文件: ' || filename || '===\n\n' ||
       string_agg('信息类型: ' || filetype || '\n\n内容: ' || content || '\n', '' ORDER BY ingest_seq, order_index) AS text
FROM blocks GROUP BY filename""")
def q_file_text(spark, sf_dir):
    """Whole-store text per file (rows labelled with the file type)."""
    return file_text(conversation_blocks(spark, sf_dir))


@register("retrieval_record", f"""WITH {BLOCKS_SQL}
SELECT filename, ingest_seq,
       '====文件名：' || filename || '====\n\n' ||
       string_agg('信息类型：' || content_type || '\n\n内容：' || content || '\n', '' ORDER BY order_index) AS record
FROM blocks GROUP BY filename, ingest_seq""")
def q_retrieval_record(spark, sf_dir):
    """One retrieval record per ingest of a file."""
    return retrieval_record(conversation_blocks(spark, sf_dir))


PREVIEW_LINES = 2


@register("preview", f"""WITH {BLOCKS_SQL},
  ft AS (SELECT filename, arg_min(filetype, order_index) AS file_filetype FROM blocks GROUP BY filename)
SELECT filename, file_filetype, content_type, order_index, ingest_seq,
       array_to_string(string_split_regex({strip('content')}, '{LINES}')[1:{PREVIEW_LINES}], '\n    ') AS preview
FROM blocks JOIN ft USING (filename)""")
def q_preview(spark, sf_dir):
    """First two lines of every block with the file's first file type."""
    return preview(conversation_blocks(spark, sf_dir), max_lines=PREVIEW_LINES)


@register("export_clean", f"""WITH {BLOCKS_SQL}
SELECT filename, filetype,
       replace(replace(replace(content, '\r\n', '\n'), '\r', '\n'), '_x000D_', '\n') AS content,
       content_type, order_index, ingest_seq
FROM blocks""")
def q_export_clean(spark, sf_dir):
    """Export view of the block table with carriage returns normalised."""
    return export_clean(conversation_blocks(spark, sf_dir))


NUMBERED_RULE_SQL = r"^(\(?\d+[.、)）]|[一二三四五六七八九十]+、|[•·\-*]\s)"


@register("numbered_tag", f"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
  p AS (SELECT doc_id, unnest(ls) AS raw, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS para_no FROM l),
  s AS (SELECT doc_id, para_no, {strip('raw')} AS t FROM p)
SELECT doc_id, para_no, regexp_matches(t, '{NUMBERED_RULE_SQL}') AS is_numbered,
       CASE WHEN regexp_matches(t, '{NUMBERED_RULE_SQL}') THEN '[编号段] ' || t ELSE t END AS text
FROM s WHERE t <> ''""")
def q_numbered_tag(spark, sf_dir):
    """Document lines as paragraphs; numbered ones tagged."""
    return paragraphs(table(spark, sf_dir, "documents"), "doc_id", "text")


_CLOSERS_SQL = SENTENCE_CLOSERS.replace("'", "''")


@register("page_merge", f"""
WITH m AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS merged
           FROM conversations WHERE text IS NOT NULL AND text <> '' GROUP BY conv_id),
  sp AS (SELECT conv_id, string_split(merged, chr(10)) AS ls FROM m),
  l AS (SELECT conv_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i, len(ls) AS n FROM sp),
  f AS (SELECT conv_id, i, line,
          CASE WHEN i = n THEN ''
               WHEN length(line) > 0 AND contains('{_CLOSERS_SQL}', right(line, 1)) THEN chr(10)
               WHEN lead(line) OVER (PARTITION BY conv_id ORDER BY i) = '' AND i + 1 < n THEN chr(10)
               ELSE '' END AS sep
        FROM l)
SELECT conv_id, string_agg(line || sep, '' ORDER BY i) AS text FROM f GROUP BY conv_id""")
def q_page_merge(spark, sf_dir):
    """Conversation turns as the pages of one file: joined by a line break, then line-break repair."""
    return merged_pages(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")
