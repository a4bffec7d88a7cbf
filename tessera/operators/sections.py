"""Sections of a structured report: parsing section lists, field lists, outlines, problem/cause extraction,
numbered suggestions, JSON repair, concatenated-block parsing, format checks and template completion.

Section table schema: ``(report, sec_no, section, body)`` where ``body`` is the section's JSON object text.  JSON
values stay text (``map<string,string>`` keeps key order; nested values come back as compact JSON text) and are
parsed again only where their inner shape is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import formats as fmt
from ..functions.text import json_fence_body, py_strip
from .common import fill_template, row_number_within

MAP_SS = "map<string,string>"


def _obj(c: Column) -> Column:
    """Parse JSON object text to an ordered map; null when the text is not an object."""
    return F.when(py_strip(c).startswith("{"), F.from_json(c, MAP_SS))


# ----------------------------------------------------------------------------------------------------- section list
def section_rows(docs: DataFrame, report_col: str, text_col: str, sec_offset: int = 0) -> DataFrame:
    """Raw section list (a JSON array of one-key objects) -> ``(report, sec_no, section, body)``.

    ``sec_no`` is the position in the list (+ ``sec_offset``, used when appending table sections after the fixed
    ones); a non-object element or an unparsable document yields no rows."""
    arr = F.from_json(F.col(text_col), f"array<{MAP_SS}>")
    items = docs.select(F.col(report_col).alias("report"), F.posexplode(arr).alias("sec_no", "_m"))
    return (items.select("report", (F.col("sec_no") + sec_offset).alias("sec_no"),
                         F.explode(F.map_entries("_m")).alias("_e"))
            .select("report", "sec_no", F.col("_e.key").alias("section"), F.col("_e.value").alias("body")))


def append_sections(fixed: DataFrame, extra: DataFrame) -> DataFrame:
    """Table sections follow the fixed ones: their ``sec_no`` is shifted past each report's last fixed section."""
    last = fixed.groupBy("report").agg(F.max("sec_no").alias("_last"))
    shifted = (extra.join(last, "report", "left")
               .select("report", (F.coalesce("_last", F.lit(-1)) + 1 + F.col("sec_no")).alias("sec_no"),
                       "section", "body"))
    return fixed.unionByName(shifted)


def section_fields(sections: DataFrame) -> DataFrame:
    """Object section -> ordered field list ``(report, sec_no, section, field_no, label, value)``."""
    return (sections.select("report", "sec_no", "section", F.posexplode(F.map_entries(_obj(F.col("body"))))
                            .alias("field_no", "_e"))
            .select("report", "sec_no", "section", (F.col("field_no") + 1).alias("field_no"),
                    F.col("_e.key").alias("label"), F.col("_e.value").alias("value")))


def section_outline(sections: DataFrame, heading: str = fmt.OUTLINE_HEADING,
                    item: str = fmt.OUTLINE_ITEM) -> DataFrame:
    """Object section -> outline rows ``(report, sec_no, pos, level, text)``: a level-0 heading, then one level-1
    row ``item`` per value in key order (blank values kept)."""
    before, after = fmt.split_template(item, "value")
    lines = F.concat(F.array(F.struct(F.lit(0).alias("level"), F.lit(heading).alias("text"))),
                     F.transform(F.map_values(_obj(F.col("body"))),
                                 lambda v: F.struct(F.lit(1).alias("level"),
                                                    F.concat(F.lit(before), v, F.lit(after)).alias("text"))))
    # A non-object body gives a null outline, which posexplode turns into no rows (no separate filter, which would
    # parse the body a second time).
    return (sections.select("report", "sec_no", F.posexplode(lines).alias("pos", "_l"))
            .select("report", "sec_no", "pos", F.col("_l.level").alias("level"), F.col("_l.text").alias("text")))


# --------------------------------------------------------------------------------------------- problems and causes
def main_problem(sections: DataFrame, problem_key: str = fmt.PROBLEM_KEY, summary_key: str = fmt.SUMMARY_KEY,
                 sep: str = fmt.MAIN_PROBLEM_JOIN) -> DataFrame:
    """Per report: the non-blank problem summaries of its object sections, stripped, joined by ``sep`` in section
    order -> ``(report, main_problem)`` ('' when there is none).

    One aggregation per report with map-side partial aggregation; only non-blank summaries are collected, so the
    buffer of a report is the size of its output text."""
    body = _obj(F.col("body"))
    problem = _obj(F.element_at(body, F.lit(problem_key)))
    summary = py_strip(F.coalesce(F.element_at(problem, F.lit(summary_key)), F.lit("")))
    parts = sections.select("report", F.when(summary != "", F.struct(F.col("sec_no").alias("o"),
                                                                      summary.alias("s"))).alias("_p"))
    return parts.groupBy("report").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("_p")), lambda x: x["s"]), sep).alias("main_problem"))


def cause_rows(sections: DataFrame, causes_key: str = fmt.CAUSES_KEY) -> DataFrame:
    """Per report, the causes of its object sections in section order: ``(report, cat_no, category, details)``.

    The texts of a cause are its string value or the strings of its list, stripped, blank ones dropped; numbers,
    nulls and objects give none.  ``cat_no`` numbers the categories of a report from 1 (section order, then key
    order)."""
    found = F.element_at(F.from_json(F.col("body"), "map<string,variant>"), F.lit(causes_key))
    # A variant sorts an object's keys, so the entries are parsed from the object's own text.
    text = F.element_at(_obj(F.col("body")), F.lit(causes_key))
    causes = F.when(F.schema_of_variant(found).startswith("OBJECT"), F.from_json(text, "map<string,variant>"))
    cats = sections.select("report", "sec_no", F.posexplode(F.map_entries(causes)).alias("cat_pos", "_e"))
    value = F.col("_e.value")
    items = F.when(F.schema_of_variant(value).startswith("ARRAY"), F.variant_get(value, "$", "array<variant>")).otherwise(F.array(value))
    strings = F.filter(items, lambda x: F.schema_of_variant(x) == "STRING")
    details = F.filter(F.transform(strings, lambda x: py_strip(F.variant_get(x, "$", "string"))), lambda d: d != "")
    staged = cats.select("report", "sec_no", "cat_pos", F.col("_e.key").alias("category"), details.alias("details"))
    # Dense category numbers per report; a report holding a large share of rows is numbered across many tasks.
    numbered = row_number_within(staged, ["report"], ["sec_no", "cat_pos"], out="cat_no")
    return numbered.select("report", F.col("cat_no").cast("int").alias("cat_no"), "category", "details")


# ------------------------------------------------------------------------------------------------------ suggestions
def suggestion_steps(items: DataFrame, report_col: str, pos_col: str, text_col: str,
                     pattern: str = fmt.NUMBERED_ITEM_PATTERN, label: str = fmt.SUGGESTION_LABEL) -> DataFrame:
    """Numbered suggestions -> ordered steps ``(report, step_no, step_pos, id, label, value)`` (``step_pos`` = 1-based
    position in key order).

    Order-dependent fold over a report's items: an item matching ``pattern`` sets key ``n`` to its text (first line,
    stripped); any other item sets key ``(number of keys so far) + 1`` -- which can overwrite an earlier key -- to
    the whole stripped item.  Later writes win; steps come out sorted by key."""
    per = items.groupBy(F.col(report_col).alias("report")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(pos_col).alias("p"), F.col(text_col).alias("t")))).alias("_i"))
    texts = F.transform("_i", lambda s: py_strip(s["t"]))
    empty = F.create_map().cast("map<int,string>")

    def step(m, x):
        numbered = x.rlike(pattern)
        key = F.when(numbered, F.regexp_extract(x, pattern, 1).cast("int")).otherwise(F.size(m) + 1)
        val = F.when(numbered, py_strip(F.regexp_extract(x, pattern, 2))).otherwise(x)
        return F.map_concat(m, F.create_map(key, val))

    folded = per.select("report", F.aggregate(texts, empty, step).alias("_m"))
    return (folded.select("report", F.posexplode(F.array_sort(F.map_entries("_m"))).alias("_pos", "_e"))
            .select("report", F.col("_e.key").alias("step_no"), (F.col("_pos") + 1).alias("step_pos"),
                    F.concat(F.lit("rec_"), F.col("_e.key").cast("string")).alias("id"),
                    F.lit(label).alias("label"), F.col("_e.value").alias("value")))


# ------------------------------------------------------------------------------------------------------ JSON repair
def json_repair(replies: DataFrame, text_col: str) -> DataFrame:
    """Model replies -> ``(…, json_text, source)``: the reply itself when it is valid JSON, else the body of its first
    fenced ```json block when that is valid, else null (``source`` = 'raw' | 'fenced' | null: route nulls to a
    rejects table, or fail with ``raise_error`` in strict use).  The original text is passed on, so key order is
    kept for later ordered parsing."""
    x = F.col(text_col)
    fenced = json_fence_body(x)
    raw_ok = F.try_parse_json(x).isNotNull()
    fenced_ok = (fenced != "") & F.try_parse_json(fenced).isNotNull()
    src = F.when(raw_ok, F.lit("raw")).when(fenced_ok, F.lit("fenced"))
    text = F.when(raw_ok, x).when(fenced_ok, fenced)
    return replies.select(*[c for c in replies.columns], text.alias("json_text"), src.alias("source"))


# ---------------------------------------------------------------------------------------------- concatenated blocks
def block_parse(texts: DataFrame, text_col: str, split_marker: str = fmt.FILE_SPLIT,
                pattern: str = fmt.FILE_BLOCK_PATTERN) -> DataFrame:
    """Concatenated file blocks -> ``(filename, info_type, content, route, text_block)``.

    Split on the file marker, skip blank pieces, match ``<name>====\\n\\n信息类型: <type>\\n内容：<body>`` (only the
    first type is taken; later blocks stay in the body), strip the three parts.  ``route`` is 'table' when the type
    is ``table`` in any case, else 'text'; text blocks get their normalised string in ``text_block``."""
    import re

    pieces = texts.select(F.explode(F.split(F.col(text_col), re.escape(split_marker))).alias("_b"))
    pieces = pieces.where(py_strip(F.col("_b")) != "").where(F.col("_b").rlike(pattern))
    name = py_strip(F.regexp_extract("_b", pattern, 1))
    typ = py_strip(F.regexp_extract("_b", pattern, 2))
    body = py_strip(F.regexp_extract("_b", pattern, 3))
    out = pieces.select(name.alias("filename"), typ.alias("info_type"), body.alias("content"))
    route = F.when(F.lower("info_type") == "table", F.lit("table")).otherwise(F.lit("text"))
    block = fill_template(fmt.FILE_HEADER + "信息类型: {t}\n内容：{c}", filename=F.col("filename"),
                          t=F.col("info_type"), c=F.col("content"))
    return out.select("*", route.alias("route"), F.when(route == "text", block).alias("text_block"))


# ---------------------------------------------------------------------------------------------------- format checks
# Value formats a report field is expected to follow.
FORMAT_RULES = {
    "is_date": r"^\d{4}年\d{1,2}月(\d{1,2}日)?(至(\d{4}年)?\d{1,2}月(\d{1,2}日)?)?$",
    "is_percent": r"^\d+(\.\d)?%$",
    "is_number": r"^\d+(\.\d)?$",
    "is_duration": r"^\d+(\.\d+)?(分钟|小时|天)$",
}


def field_format_check(fields: DataFrame, value_col: str = "value",
                       rules: dict[str, str] | None = None) -> DataFrame:
    """One boolean column per format rule (full-string regular expressions; null values give false)."""
    rules = rules or FORMAT_RULES
    v = F.coalesce(F.col(value_col), F.lit(""))
    return fields.select("*", *[v.rlike(rx).alias(name) for name, rx in rules.items()])


# ----------------------------------------------------------------------------------------------- template completion
def template_fill(reports: DataFrame, fields: DataFrame, template: Sequence[tuple[str, str]]) -> DataFrame:
    """Every template field for every report: ``(report, section, field_no, label, value)`` with '' where the report
    has no such field (the last value wins when it has several).

    The template is a fixed, small list; each report row is expanded by it (an ``explode`` of a literal array, not
    a join), then left-joined to the report's fields on (report, section, label)."""
    tpl = F.array(*[F.struct(F.lit(i + 1).alias("field_no"), F.lit(s).alias("section"), F.lit(lab).alias("label"))
                    for i, (s, lab) in enumerate(template)])
    slots = (reports.select("report").distinct()
             .select("report", F.explode(tpl).alias("_t"))
             .select("report", "_t.field_no", "_t.section", "_t.label"))
    last = (fields.groupBy("report", "section", "label")
            .agg(F.max_by("value", F.struct("sec_no", "field_no")).alias("value")))
    return (slots.join(last, ["report", "section", "label"], "left")
            .select("report", "section", "field_no", "label", F.coalesce("value", F.lit("")).alias("value")))
