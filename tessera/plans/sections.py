"""Registered plans: sections of structured reports.

The events table provides the sections: a report is a user, each event one section (``sec_no`` = event id,
``section`` = event type, ``body`` = the JSON props).  Each event also yields an analysis body (problem summary,
causes by category) so the problem/cause operators run on data that grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import formats as fmt
from ..operators.blocks import prompt_corpus
from ..operators.common import ordered_concat, spread
from ..operators.sections import (FORMAT_RULES, block_parse, cause_rows, field_format_check, json_repair,
                                  main_problem, section_fields, section_outline, section_rows, suggestion_steps,
                                  template_fill)
from .blocks import BLOCKS_SQL
from .registry import register, table
from .sources import conversation_blocks
from .sqltext import WS, strip
from .tables import _WIDE_SQL, _long


def event_sections(spark, sf_dir) -> DataFrame:
    ev = spread(table(spark, sf_dir, "events"))   # JSON work per row: use every core on a small file
    return ev.select(F.col("user_id").alias("report"), F.col("event_id").alias("sec_no"),
                     F.col("event_type").alias("section"), F.col("props").alias("body"))


# --------------------------------------------------------------------------------------------------- section list
@register("section_rows", """
SELECT CAST(user_id AS VARCHAR) || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS report,
       CAST(row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) - 1 AS INTEGER) AS sec_no,
       event_type AS section, CAST(json(props) AS VARCHAR) AS body
FROM events""")
def q_section_rows(spark, sf_dir):
    """Raw section-list documents (one JSON array per user and day, built from the events) parsed back into
    section rows."""
    ev = table(spark, sf_dir, "events")
    item = F.concat(F.lit('{"'), F.col("event_type"), F.lit('": '), F.col("props"), F.lit("}"))
    docs = ordered_concat(ev.select(F.concat(F.col("user_id").cast("string"), F.lit("/"),
                                             F.to_date("ts").cast("string")).alias("report"), "event_id",
                                    item.alias("item")),
                          ["report"], ["event_id"], F.col("item"), "items", sep=",")
    docs = docs.select("report", F.concat(F.lit("["), F.col("items"), F.lit("]")).alias("text"))
    return section_rows(docs, "report", "text")


@register("section_fields", """
WITH k AS (SELECT user_id, event_id, event_type, props, json_keys(props) AS ks FROM events)
SELECT user_id AS report, event_id AS sec_no, event_type AS section,
       CAST(generate_subscripts(ks, 1) AS INTEGER) AS field_no, unnest(ks) AS label,
       json_extract_string(props, '$."' || unnest(ks) || '"') AS value
FROM k""")
def q_section_fields(spark, sf_dir):
    """Every section's fields as an ordered label/value list."""
    return section_fields(event_sections(spark, sf_dir))


@register("section_outline", f"""
SELECT user_id AS report, event_id AS sec_no, 0 AS pos, 0 AS level, '{fmt.OUTLINE_HEADING}' AS text FROM events
UNION ALL
SELECT report, sec_no, pos, 1 AS level, '• ' || json_extract_string(props, '$."' || key || '"') || '；' AS text FROM (
  SELECT user_id AS report, event_id AS sec_no, props, unnest(json_keys(props)) AS key,
         CAST(generate_subscripts(json_keys(props), 1) AS INTEGER) AS pos FROM events)""")
def q_section_outline(spark, sf_dir):
    """Every section as a two-level outline (heading, then one bullet per value)."""
    return section_outline(event_sections(spark, sf_dir))


# ---------------------------------------------------------------------------------------------- problems and causes
def analysis_sections(spark, sf_dir) -> DataFrame:
    """Per event an analysis body: a problem summary for error events (blank otherwise, so it is skipped) and one
    cause category named after the event type; purchase causes are a single text, the others a list with a blank
    item (dropped by the operator)."""
    ev = spread(table(spark, sf_dir, "events"))
    k = F.get_json_object("props", "$.k")
    summary = F.when(F.col("event_type") == "error", F.concat(F.lit("error k="), k)).otherwise(F.lit(""))
    cause = F.when(F.col("event_type") == "purchase", F.concat(F.lit('"k='), k, F.lit('"'))) \
        .otherwise(F.concat(F.lit('["k='), k, F.lit('", " "]')))
    body = F.concat(F.lit('{"存在问题": {"总结": "'), summary, F.lit('", "具体问题": []}, "原因分析": {"'),
                    F.col("event_type"), F.lit('": '), cause, F.lit("}}"))
    return ev.select(F.col("user_id").alias("report"), F.col("event_id").alias("sec_no"),
                     F.col("event_type").alias("section"), body.alias("body"))


_ANALYSIS_SQL = """
  s AS (
    SELECT user_id AS report, event_id AS sec_no,
           '{"存在问题": {"总结": "' || (CASE WHEN event_type = 'error' THEN 'error k=' || json_extract_string(props, '$.k') ELSE '' END)
           || '", "具体问题": []}, "原因分析": {"' || event_type || '": '
           || (CASE WHEN event_type = 'purchase' THEN '"k=' || json_extract_string(props, '$.k') || '"'
                    ELSE '["k=' || json_extract_string(props, '$.k') || '", " "]' END) || '}}' AS body
    FROM events
  ),
  mp AS (
    SELECT r.report, coalesce(string_agg(x.sm, '；' ORDER BY x.sec_no), '') AS main_problem
    FROM (SELECT DISTINCT report FROM s) r
    LEFT JOIN (SELECT report, sec_no, trim(json_extract_string(body, '$."存在问题"."总结"'), '%(ws)s') AS sm FROM s) x
      ON r.report = x.report AND x.sm <> ''
    GROUP BY r.report
  ),
  c AS (
    SELECT report, sec_no, unnest(json_keys(json_extract(body, '$."原因分析"'))) AS category,
           generate_subscripts(json_keys(json_extract(body, '$."原因分析"')), 1) AS cat_pos, body
    FROM s
  ),
  cd AS (
    SELECT report, sec_no, cat_pos, category,
           json_extract(body, '$."原因分析"."' || category || '"') AS v
    FROM c
  ),
  cl AS (
    SELECT report, sec_no, cat_pos, category,
           list_filter(list_transform(
               CASE WHEN json_type(v) = 'ARRAY' THEN json_extract_string(v, '$[*]') ELSE [json_extract_string(v, '$')] END,
               lambda d: trim(d, '%(ws)s')), lambda d: d IS NOT NULL AND d <> '') AS details
    FROM cd
  ),
  causes AS (
    SELECT report, CAST(row_number() OVER (PARTITION BY report ORDER BY sec_no, cat_pos) AS INTEGER) AS cat_no,
           category, details FROM cl
  )""" % {"ws": WS}


def analysis(spark, sf_dir) -> DataFrame:
    secs = analysis_sections(spark, sf_dir)
    causes = cause_rows(secs)
    return causes.join(main_problem(secs), "report")


@register("cause_rows", f"""WITH {_ANALYSIS_SQL}
SELECT causes.report, mp.main_problem, cat_no, category, CAST(len(details) AS INTEGER) AS n_details,
       array_to_string(details, chr(10)) AS details_text
FROM causes JOIN mp ON causes.report = mp.report""")
def q_cause_rows(spark, sf_dir):
    """Per user report: the main problem (non-blank summaries joined) and the cause categories with their items."""
    a = analysis(spark, sf_dir)
    return a.select("report", "main_problem", "cat_no", "category", F.size("details").alias("n_details"),
                    F.array_join("details", "\n").alias("details_text"))


# ------------------------------------------------------------------------------------------------------- suggestions
_NUM = fmt.NUMBERED_ITEM_PATTERN


@register("suggestion_steps", f"""
WITH RECURSIVE it AS (
    SELECT conv_id AS report, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS i,
           {strip('text')} AS x
    FROM conversations),
  f(report, i, m) AS (
    SELECT DISTINCT report, 0, MAP(CAST([] AS INTEGER[]), CAST([] AS VARCHAR[])) FROM it
    UNION ALL
    SELECT f.report, f.i + 1,
           map_concat(f.m, MAP(
             [CASE WHEN regexp_matches(it.x, '{_NUM}') THEN CAST(regexp_extract(it.x, '{_NUM}', 1) AS INTEGER)
                   ELSE CAST(cardinality(f.m) + 1 AS INTEGER) END],
             [CASE WHEN regexp_matches(it.x, '{_NUM}') THEN {strip(f"regexp_extract(it.x, '{_NUM}', 2)")}
                   ELSE it.x END]))
    FROM f JOIN it ON it.report = f.report AND it.i = f.i + 1),
  last AS (SELECT report, arg_max(m, i) AS m FROM f GROUP BY report),
  e AS (SELECT report, unnest(map_keys(m)) AS step_no, unnest(map_values(m)) AS value FROM last)
SELECT report, step_no, CAST(row_number() OVER (PARTITION BY report ORDER BY step_no) AS INTEGER) AS step_pos,
       'rec_' || CAST(step_no AS VARCHAR) AS id, '{fmt.SUGGESTION_LABEL}' AS label, value FROM e""")
def q_suggestion_steps(spark, sf_dir):
    """Each conversation's turns read as a suggestion list and folded into numbered steps."""
    conv = table(spark, sf_dir, "conversations")
    return suggestion_steps(conv, "conv_id", "turn", "text")


# ------------------------------------------------------------------------------------------------------ JSON repair
def _replies(spark, sf_dir) -> DataFrame:
    """Model-reply stand-ins from the events: click props arrive fenced, error props behind a prefix (invalid)."""
    ev = spread(table(spark, sf_dir, "events"))
    reply = (F.when(F.col("event_type") == "click", F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```")))
             .when(F.col("event_type") == "error", F.concat(F.lit("error: "), F.col("props")))
             .otherwise(F.col("props")))
    return ev.select("event_id", reply.alias("reply"))


@register("json_repair", """
WITH r AS (
  SELECT event_id,
         CASE WHEN event_type = 'click' THEN '```json' || chr(10) || props || chr(10) || '```'
              WHEN event_type = 'error' THEN 'error: ' || props ELSE props END AS reply
  FROM events),
  x AS (SELECT event_id, reply, regexp_extract(reply, '```json\\n([\\s\\S]*?)\\n```', 1) AS fenced FROM r),
  y AS (SELECT event_id,
               CASE WHEN json_valid(reply) THEN 'raw' WHEN fenced <> '' AND json_valid(fenced) THEN 'fenced' END AS source,
               CASE WHEN json_valid(reply) THEN reply WHEN fenced <> '' AND json_valid(fenced) THEN fenced END AS json_text
        FROM x)
SELECT event_id, source, json_text, CAST(json_extract_string(json_text, '$.k') AS BIGINT) AS k FROM y""")
def q_json_repair(spark, sf_dir):
    """Replies parsed as JSON directly or from a fenced block; unparsable ones keep a null source."""
    rep = json_repair(_replies(spark, sf_dir), "reply")
    return rep.select("event_id", "source", "json_text",
                      F.get_json_object("json_text", "$.k").cast("long").alias("k"))


# ---------------------------------------------------------------------------------------------- concatenated blocks
_PAT_SQL = fmt.FILE_BLOCK_PATTERN


@register("block_parse", f"""WITH {BLOCKS_SQL},
  pc AS (
    SELECT filename AS f,
           '====文件名：' || filename || '====\n\n' ||
           string_agg('信息类型: ' || {strip('content_type')} || '\n内容：' || {strip('content')} || '\n\n', ''
                      ORDER BY ingest_seq, order_index) AS corpus
    FROM blocks GROUP BY filename),
  pieces AS (SELECT unnest(string_split(corpus, '====文件名：')) AS b FROM pc),
  m AS (SELECT {strip(f"regexp_extract(b, '{_PAT_SQL}', 1)")} AS filename,
               {strip(f"regexp_extract(b, '{_PAT_SQL}', 2)")} AS info_type,
               {strip(f"regexp_extract(b, '{_PAT_SQL}', 3)")} AS content
        FROM pieces WHERE {strip('b')} <> '' AND regexp_matches(b, '{_PAT_SQL}'))
SELECT filename, info_type, content,
       CASE WHEN lower(info_type) = 'table' THEN 'table' ELSE 'text' END AS route,
       CASE WHEN lower(info_type) = 'table' THEN NULL
            ELSE '====文件名：' || filename || '====\n\n信息类型: ' || info_type || '\n内容：' || content END AS text_block
FROM m""")
def q_block_parse(spark, sf_dir):
    """The per-file prompt corpus parsed back into (file, first type, body) and routed to table or text output."""
    corpus = prompt_corpus(conversation_blocks(spark, sf_dir))
    return block_parse(corpus, "corpus")


# ---------------------------------------------------------------------------------------------------- format checks
@register("field_format_check", f"""
WITH {_WIDE_SQL}
SELECT col_no, pos, value_raw,
       {", ".join(f"regexp_matches(value_raw, '{rx}') AS {name}" for name, rx in FORMAT_RULES.items())}
FROM long""")
def q_field_format_check(spark, sf_dir):
    """Format flags (date, one-decimal percent, number, duration) of every cell of the nation report table."""
    return field_format_check(_long(spark, sf_dir).select("col_no", "pos", "value_raw"), "value_raw")


# ----------------------------------------------------------------------------------------------- template completion
EVENT_TEMPLATE = [("click", "k"), ("view", "k"), ("signup", "k"), ("error", "k"), ("purchase", "k"),
                  ("purchase", "amount")]


@register("template_fill", f"""
WITH t(field_no, section, label) AS (VALUES {", ".join(f"({i + 1}, '{s}', '{lab}')" for i, (s, lab) in enumerate(EVENT_TEMPLATE))}),
  f AS (SELECT user_id AS report, event_type AS section, unnest(json_keys(props)) AS label, event_id, props FROM events),
  l AS (SELECT report, section, label, arg_max(json_extract_string(props, '$."' || label || '"'), event_id) AS value
        FROM f GROUP BY report, section, label),
  r AS (SELECT DISTINCT user_id AS report FROM events)
SELECT r.report, t.section, CAST(t.field_no AS INTEGER) AS field_no, t.label, coalesce(l.value, '') AS value
FROM r CROSS JOIN t LEFT JOIN l ON l.report = r.report AND l.section = t.section AND l.label = t.label""")
def q_template_fill(spark, sf_dir):
    """Every user report completed to the fixed field template (latest value per field, '' when absent)."""
    secs = event_sections(spark, sf_dir)
    return template_fill(secs, section_fields(secs), EVENT_TEMPLATE)
