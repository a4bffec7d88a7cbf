"""Reports with typed values: JSON numbers, booleans, nulls, objects and lists stay what they are, in the text's order.

A section's entries are read twice from one text: as text (``map<string,string>``, which keeps the order of keys at every
depth) and as VARIANT (which knows every value's type).  Documents are put together from JSON literals, one aggregation
per report for each source.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import formats as fmt
from ..functions.text import json_string, py_strip, value_json


def kind_of(value: Column) -> Column:
    """string, number, boolean, null, object or array: the JSON type of a VARIANT."""
    schema = F.schema_of_variant(value)
    return (F.when(schema == "STRING", "string").when(schema == "BOOLEAN", "boolean").when(schema == "VOID", "null")
            .when(schema.startswith("OBJECT"), "object").when(schema.startswith("ARRAY"), "array").otherwise("number"))


def typed_fields(sections: DataFrame) -> DataFrame:
    """Object sections -> (report, sec_no, section, field_no, label, kind, value, json), ``field_no`` from 1.

    ``value`` is the text of a string or the compact JSON text of any other value (null for null), ``json`` the value as
    a JSON literal with its type.  Labels stand in the order of the text; of a label that stands twice the last value
    counts, at the first place.  Bodies that are null or no objects have no fields.  Row-wise: no shuffle."""
    body = F.when(py_strip(F.col("body")).startswith("{"), F.col("body"))
    read = sections.select("report", "sec_no", "section", F.map_entries(F.from_json(body, "map<string,string>")).alias("_t"),
                           F.map_entries(F.from_json(body, "map<string,variant>")).alias("_v"))
    keys = F.transform("_t", lambda e: e["key"])
    read = read.select("*", keys.alias("_k"), F.reverse(keys).alias("_r"), F.size("_t").alias("_n"))
    first = F.filter(F.transform("_t", lambda e, i: F.struct(e["key"].alias("key"), i.alias("at"))),
                     lambda e: F.array_position("_k", e["key"]) == e["at"] + 1)
    last = F.transform(first, lambda e: F.struct(e["key"].alias("key"), (F.col("_n") + 1 - F.array_position("_r", e["key"])).cast("int").alias("at")))
    rows = read.select("report", "sec_no", "section", "_t", "_v", F.posexplode(last).alias("_p", "_e"))
    rows = rows.select("report", "sec_no", "section", (F.col("_p") + 1).alias("field_no"), F.col("_e.key").alias("label"),
                       F.element_at("_t", F.col("_e.at"))["value"].alias("value"), kind_of(F.element_at("_v", F.col("_e.at"))["value"]).alias("kind"))
    literal = F.when(F.col("kind") == "null", "null").when(F.col("kind") == "string", json_string("value")).otherwise(F.col("value"))
    return rows.select("report", "sec_no", "section", "field_no", "label", "kind", "value", literal.alias("json"))


def report_series(rows: DataFrame, report: str, key: str, pos: str, columns: Sequence[str], total: str = fmt.TOTAL_ROW,
                  rate_word: str = fmt.RATE_WORD) -> DataFrame:
    """Wide rows of many reports -> (report, col_no, field, unit, pos, name, raw, json), a series per report and column.

    The unit is % where the column's name holds the rate word or any of the report's values, the total row's too, holds a
    percent sign; the total row itself is left out.  ``json`` is the value ladder as a literal; null cells are empty
    texts.  Units are one partial aggregation per report and column, joined back."""
    long = rows.select(F.col(report).alias("report"), F.col(pos).alias("pos"), F.col(key).cast("string").alias("name"),
                       F.explode(F.array(*[F.struct(F.lit(n + 1).alias("col_no"), F.lit(c).alias("field"),
                                                    F.coalesce(F.col(c).cast("string"), F.lit("")).alias("raw")) for n, c in enumerate(columns)])).alias("_c"))
    long = long.select("report", "pos", "name", "_c.*")
    percent = F.col("field").contains(rate_word) | F.col("_any")
    units = (long.groupBy(F.col("report").alias("_report"), F.col("col_no").alias("_no")).agg(F.bool_or(F.col("raw").contains(fmt.UNIT_PERCENT)).alias("_any")))
    joined = long.join(units, F.col("report").eqNullSafe(F.col("_report")) & (F.col("col_no") == F.col("_no")))
    return (joined.where(~F.col("name").eqNullSafe(total))
            .select("report", "col_no", "field", F.when(percent, fmt.UNIT_PERCENT).otherwise(fmt.UNIT_COUNT).alias("unit"), "pos", "name", "raw",
                    value_json("raw").alias("json")))


def paired_series(series: DataFrame, first: int, second: int) -> DataFrame:
    """(report, pos, name, x, y): two series of every report aligned by position, as JSON literals (one aggregation)."""
    pick = lambda n: F.max(F.when(F.col("col_no") == n, F.col("json")))
    return (series.where(F.col("col_no").isin(first, second)).groupBy("report", "pos")
            .agg(F.max(F.when(F.col("col_no") == first, F.col("name"))).alias("name"), pick(first).alias("x"), pick(second).alias("y"))
            .where("x is not null and y is not null"))


def _listed(items: Column) -> Column:
    """JSON list of the texts of sorted (order, text) structs."""
    return F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(items), lambda x: x["text"]), ","), F.lit("]"))


def _pair(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), value)


def _object(*pairs: Column) -> Column:
    return F.concat(F.lit("{"), *[x for n, p in enumerate(pairs) for x in ([F.lit(","), p] if n else [p])], F.lit("}"))


def typed_report(fields: DataFrame, analysis: DataFrame, series: DataFrame, steps: DataFrame, summary: DataFrame, parts: Mapping[str, str],
                 outline: tuple[str, str], metrics: Mapping[str, str], heading: str = fmt.OUTLINE_HEADING, item: str = fmt.OUTLINE_ITEM) -> DataFrame:
    """(report, document): the whole recorded report as JSON text, every value with its type.

    ``parts`` and ``metrics`` map a key to the section whose fields or metrics it lists; ``outline`` is (key, section).
    Keys stand in the recorded order: the first of ``parts``, the outline, the other parts, metrics, analysis, col_1 to
    col_n, conclusion.  A part that a report lacks is an empty list, a report without series has no col keys, one without
    analysis an empty problem.  ``fields`` come from ``typed_fields``, ``series`` from ``report_series``; ``analysis`` has
    (report, main_problem, cat_no, category, details), ``steps`` (report, step_no, id, label, value) and ``summary``
    (report, content).  Each source is read once and aggregated once per report."""
    before, after = fmt.split_template(item, "value")
    field = _object(_pair("label", json_string("label")), _pair("value", F.col("json")))
    point = lambda text, level: _object(_pair("item", _object(_pair("contents", F.concat(
        F.lit("["), _object(_pair("text", json_string(text))), F.lit("]"))))), _pair("level", F.lit(str(level))))
    line = point(F.concat(F.lit(before), F.coalesce("value", F.lit("")), F.lit(after)), 1)
    wanted = {**parts, **metrics, outline[0]: outline[1]}
    picked = [F.collect_list(F.when(F.col("section") == s, F.struct("sec_no", "field_no", (line if k == outline[0] else field).alias("text")))).alias(k)
              for k, s in wanted.items()]
    of_fields = fields.groupBy("report").agg(*picked)
    cause = _object(_pair("category", json_string("category")), _pair("details", F.to_json("details")))
    of_analysis = analysis.groupBy("report").agg(F.max("main_problem").alias("_problem"),
                                                 F.collect_list(F.struct("cat_no", cause.alias("text"))).alias("_causes"))
    value = _object(_pair("name", json_string("name")), _pair("value", F.col("json")))
    column = F.concat(F.lit('"col_'), F.col("col_no").cast("string"), F.lit('":'),
                      _object(_pair("unit", json_string("unit")), _pair("name", json_string("field")), _pair("data", _listed(F.col("_data")))), F.lit(","))
    of_series = (series.groupBy("report", "col_no", "field", "unit").agg(F.collect_list(F.struct("pos", "name", value.alias("text"))).alias("_data"))
                 .select("report", "col_no", column.alias("_text")).groupBy("report")
                 .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col_no", "_text"))), lambda x: x["_text"]), "").alias("_series")))
    step = _object(*[_pair(c, json_string(c)) for c in ("id", "label", "value")])
    of_steps = steps.groupBy("report").agg(F.collect_list(F.struct("step_no", step.alias("text"))).alias("_steps"))
    # Every source has one row for each of its reports by now: reports are the keys of one more grouping, and no source is
    # computed again for its names alone.  A null report matches nothing.
    sides = of_fields
    for side in (of_analysis, of_series, of_steps):
        sides = sides.unionByName(side, allowMissingColumns=True)
    doc = sides.groupBy("report").agg(*[F.first(F.when(F.col("report").isNotNull(), F.col(c)), ignorenulls=True).alias(c) for c in sides.columns if c != "report"])
    doc = doc.join(summary.select("report", F.col("content").alias("_content")), "report", "left")
    nothing = F.array().cast("array<struct<no:int,text:string>>")
    titled = lambda title, name, rows: _object(_pair("section", json_string(F.lit(title))), _pair(name, rows))
    listed = lambda c: F.coalesce(_listed(F.col(c)), _listed(nothing))
    section = [_pair(k, titled(s, "fields", listed(k))) for k, s in parts.items()]
    top = F.concat(F.lit("["), point(F.lit(heading), 0), F.when(F.size(outline[0]) > 0, F.concat(F.lit(","), F.substring(_listed(F.col(outline[0])), F.lit(2), F.lit(1 << 30))))
                   .otherwise("]"))
    problem = _object(_pair("section", json_string(F.lit(fmt.ANALYSIS_TITLE))), _pair("mainProblem", json_string(F.coalesce("_problem", F.lit("")))),
                      _pair("causes", listed("_causes")))
    closing = _object(_pair("title", json_string(F.lit(fmt.CONCLUSION_TITLE))),
                      _pair("summary", _object(_pair("section", json_string(F.lit(fmt.SUMMARY_KEY))), _pair("content", json_string(F.coalesce("_content", F.lit("")))))),
                      _pair("rectificationFlow", titled(fmt.SUGGESTIONS_KEY, "steps", listed("_steps"))))
    keys = [section[0], _pair(outline[0], top), *section[1:], *[_pair(k, titled(s, "metrics", listed(k))) for k, s in metrics.items()], _pair("assessmentAnalysis", problem)]
    text = F.concat(F.lit("{"), *[x for k in keys for x in (k, F.lit(","))], F.coalesce("_series", F.lit("")), _pair("conclusionSummary", closing), F.lit("}"))
    return doc.select("report", text.alias("document"))
