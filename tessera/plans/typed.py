"""Registered plans: typed values, series per report and the whole report document.

A report is a user, each event one section; the body holds a number (twice, the last counts), texts, an object, a list,
a boolean and a null.  The wide rows of a report are its events, with a total row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import formats as fmt
from ..operators.sections import cause_rows, main_problem
from ..operators.typed import paired_series, report_series, typed_fields, typed_report
from .graph import _STEPS_SQL, event_steps
from .registry import register, table
from .sections import _ANALYSIS_SQL, analysis_sections

PARTS = {"orgOverview": "signup", "trainingParticipation": "view", "assessmentDetail": "click"}
OUTLINE = ("trainingContent", "error")
METRICS = {"assessmentChart": "purchase"}
COLUMNS = ["数值", "合格率", "代码"]


def typed_sections(spark, sf_dir) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    body = F.concat(F.lit('{"k": '), k, F.lit(', "类别": "'), F.col("event_type"), F.lit('", "value": '), F.col("value").cast("string"),
                    F.lit(', "detail": {"z": '), k, F.lit(', "a": "'), F.col("event_type"), F.lit('"}, "list": ['), k,
                    F.lit(', "x"], "on": true, "none": null, "raw": "'), k, F.lit('", "k": '), k, F.lit(".5}"))
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("report"), F.col("event_id").alias("sec_no"),
                                                 F.col("event_type").alias("section"), body.alias("body"))


# The same bodies with the repeated label's last value at its first place, as it counts.
_TYPED_SQL = """
  b AS (SELECT user_id AS report, event_id AS sec_no, event_type AS section,
               '{"k": ' || (props->>'$.k') || '.5, "类别": "' || event_type || '", "value": ' || CAST(value AS VARCHAR) || ', "detail": {"z": '
               || (props->>'$.k') || ', "a": "' || event_type || '"}, "list": [' || (props->>'$.k') || ', "x"], "on": true, "none": null, "raw": "'
               || (props->>'$.k') || '"}' AS body FROM events),
  ks AS (SELECT *, unnest(json_keys(body)) AS label, CAST(generate_subscripts(json_keys(body), 1) AS INTEGER) AS field_no FROM b),
  tf AS (SELECT report, sec_no, section, field_no, label, json_extract(body, '$."' || label || '"') AS j FROM ks)"""


@register("typed_fields", f"""WITH {_TYPED_SQL}
SELECT report, sec_no, section, field_no, label,
       CASE json_type(j) WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN 'OBJECT' THEN 'object'
                         WHEN 'ARRAY' THEN 'array' ELSE 'number' END AS kind, json_extract_string(j, '$') AS value, CAST(j AS VARCHAR) AS json
FROM tf""")
def q_typed_fields(spark, sf_dir):
    """Every section's fields with their JSON types, the text's key order, and the last of repeated labels."""
    return typed_fields(typed_sections(spark, sf_dir))


def event_table(spark, sf_dir) -> DataFrame:
    """The wide rows of every report: its events in order and a total row that carries a percent sign."""
    k = F.get_json_object("props", "$.k")
    code = F.when(F.col("event_type") == "error", "n/a").when(F.col("event_type") == "view", F.concat(F.lit("0"), k)).otherwise(k)
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("report"), F.col("event_id").alias("pos"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("name"),
        F.col("value").cast("string").alias("数值"), F.concat(k, F.lit("%")).alias("合格率"), code.alias("代码"))
    last = rows.groupBy("report").agg((F.max("pos") + 1).alias("pos"))
    totals = last.select("report", "pos", F.lit(fmt.TOTAL_ROW).alias("name"), F.lit("1%").alias("数值"), F.lit("").alias("合格率"),
                         F.lit("7").alias("代码"))
    return rows.unionByName(totals)


_SERIES_SQL = """
  se AS (SELECT user_id AS report, c.col_no, c.field, CASE WHEN c.col_no < 3 THEN '%' ELSE '人' END AS unit, event_id AS pos, 'e' || event_id AS name,
                CASE c.col_no WHEN 1 THEN CAST(value AS VARCHAR) WHEN 2 THEN (props->>'$.k') || '%'
                     ELSE CASE event_type WHEN 'error' THEN 'n/a' WHEN 'view' THEN '0' || (props->>'$.k') ELSE props->>'$.k' END END AS raw,
                CASE c.col_no WHEN 1 THEN CAST(value AS VARCHAR) WHEN 2 THEN CAST(CAST(props->>'$.k' AS DOUBLE) AS VARCHAR)
                     ELSE CASE event_type WHEN 'error' THEN '"n/a"' ELSE CAST(CAST(props->>'$.k' AS BIGINT) AS VARCHAR) END END AS json
         FROM events CROSS JOIN (VALUES (1, '数值'), (2, '合格率'), (3, '代码')) c(col_no, field))"""


@register("report_series", f"WITH {_SERIES_SQL} SELECT * FROM se")
def q_report_series(spark, sf_dir):
    """One series per report and column, with unit, typed values and without the total row."""
    return report_series(event_table(spark, sf_dir), "report", "name", "pos", COLUMNS)


@register("report_pairs", f"""WITH {_SERIES_SQL}
SELECT report, a.pos, a.name, a.json AS x, b.json AS y FROM se a JOIN se b USING (report, pos) WHERE a.col_no = 2 AND b.col_no = 3""")
def q_report_pairs(spark, sf_dir):
    """Two series of every report aligned by position."""
    return paired_series(q_report_series(spark, sf_dir), 2, 3)


def _report_sql() -> str:
    lists = ", ".join(f"coalesce(list(json_object('label', label, 'value', j) ORDER BY sec_no, field_no) FILTER (section = '{s}'), []) AS {k}"
                      for k, s in {**PARTS, **METRICS}.items())
    outline = ("list(json_object('item', json_object('contents', json_array(json_object('text', '• ' || coalesce(json_extract_string(j, '$'), '') || '；'))), "
               f"'level', 1) ORDER BY sec_no, field_no) FILTER (section = '{OUTLINE[1]}')")
    part = lambda k, s, name: f"'{k}', json_object('section', '{s}', '{name}', to_json({k}))"
    names = list(PARTS)
    return f"""WITH {_ANALYSIS_SQL}, {_STEPS_SQL}, {_TYPED_SQL}, {_SERIES_SQL},
  f AS (SELECT report, {lists}, coalesce({outline}, []) AS ol FROM tf GROUP BY report),
  an AS (SELECT report, list(json_object('category', category, 'details', details) ORDER BY cat_no) AS cs FROM causes GROUP BY report),
  st AS (SELECT report, list(json_object('id', 'rec_' || step_no, 'label', '{fmt.SUGGESTION_LABEL}', 'value', value) ORDER BY step_no) AS ss
         FROM steps GROUP BY report),
  cd2 AS (SELECT report, col_no, '"col_' || col_no || '":' || CAST(json_object('unit', any_value(unit), 'name', any_value(field), 'data',
                 list(json_object('name', name, 'value', CAST(json AS JSON)) ORDER BY pos)) AS VARCHAR) || ',' AS t FROM se GROUP BY report, col_no),
  sr AS (SELECT report, string_agg(t, '' ORDER BY col_no) AS t FROM cd2 GROUP BY report),
  head AS (SELECT f.report, CAST(json_object({part(names[0], PARTS[names[0]], 'fields')},
      '{OUTLINE[0]}', to_json(list_prepend(json_object('item', json_object('contents', json_array(json_object('text', '{fmt.OUTLINE_HEADING}'))), 'level', 0), ol)),
      {part(names[1], PARTS[names[1]], 'fields')}, {part(names[2], PARTS[names[2]], 'fields')}, {part('assessmentChart', METRICS['assessmentChart'], 'metrics')},
      'assessmentAnalysis', json_object('section', '{fmt.ANALYSIS_TITLE}', 'mainProblem', mp.main_problem, 'causes', to_json(coalesce(an.cs, [])))) AS VARCHAR) AS h,
      CAST(json_object('conclusionSummary', json_object('title', '{fmt.CONCLUSION_TITLE}', 'summary', json_object('section', '{fmt.SUMMARY_KEY}', 'content', mp.main_problem),
      'rectificationFlow', json_object('section', '{fmt.SUGGESTIONS_KEY}', 'steps', to_json(coalesce(st.ss, []))))) AS VARCHAR) AS e
    FROM f JOIN mp USING (report) LEFT JOIN an USING (report) LEFT JOIN st USING (report))
SELECT report, substr(h, 1, length(h) - 1) || ',' || sr.t || substr(e, 2) AS document FROM head JOIN sr USING (report)"""


@register("typed_report", _report_sql())
def q_typed_report(spark, sf_dir):
    """Per user report: the whole recorded document -- fields, outline, metrics, analysis, series, conclusion -- with typed
    values."""
    sections = analysis_sections(spark, sf_dir)
    problems = main_problem(sections)
    steps = event_steps(spark, sf_dir)
    return typed_report(typed_fields(typed_sections(spark, sf_dir)), cause_rows(sections).join(problems, "report"),
                        q_report_series(spark, sf_dir), steps, problems.withColumnRenamed("main_problem", "content"), PARTS, OUTLINE, METRICS)
