"""Report assembly: display lines of field values, per-report render context, and the nested report document."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import formats as fmt
from ..functions.text import py_strip


# ------------------------------------------------------------------------------------------------------- display
def display_fields(fields: DataFrame, body_col: str = "body", rule: str = "strip",
                   empty: str = fmt.EMPTY_SHOWN) -> DataFrame:
    """Field values -> display lines ``(report, sec_no, field_no, label, line_no, kind, text)``.

    Values are read from each section body (``report, sec_no, body``) so that the JSON type of a value is known:
      * a string: one 'value' line -- stripped, ``empty`` when blank (``rule='strip'``), or shown as is with
        ``empty`` only when it is '' (``rule='falsy'``);
      * an object: for each key in order a 'heading' line ``<key>：``, then one 'item' line per list item, or one
        'item' line for a string value (other values add nothing);
      * anything else (number, list, boolean, null): one 'value' line ``empty``.
    """
    ordered = F.from_json(F.col(body_col), "map<string,string>")
    typed = F.from_json(F.col(body_col), "map<string,variant>")
    rows = fields.select("report", "sec_no", F.posexplode(F.map_entries(ordered)).alias("_f", "_e"), typed.alias("_t"))
    kind = F.schema_of_variant(F.element_at(F.col("_t"), F.col("_e.key")))
    v = F.col("_e.value")
    is_str = kind == "STRING"
    is_obj = kind.startswith("OBJECT")
    if rule == "strip":
        shown = F.when(py_strip(v) == "", F.lit(empty)).otherwise(py_strip(v))
    elif rule == "falsy":
        shown = F.when(v == "", F.lit(empty)).otherwise(v)
    else:
        raise ValueError(f"unknown display rule: {rule}")
    inner = F.from_json(v, "map<string,string>")
    inner_t = F.from_json(v, "map<string,variant>")

    def obj_lines():
        # Both parses list the keys in document order; zipping them hands each key its text and JSON kind without
        # referring to the parsed map from inside the lambda (that would parse it again for every key).
        kinds = F.transform(F.map_values(inner_t), lambda x: F.schema_of_variant(x))
        pairs = F.arrays_zip(F.map_keys(inner).alias("k"), F.map_values(inner).alias("v"), kinds.alias("t"))

        def per_key(e):
            items = F.when(e["t"].startswith("ARRAY"),
                           F.transform(F.from_json(e["v"], "array<string>"),
                                       lambda x: F.struct(F.lit("item").alias("kind"), x.alias("text")))) \
                .when(e["t"] == "STRING", F.array(F.struct(F.lit("item").alias("kind"), e["v"].alias("text")))) \
                .otherwise(F.array().cast("array<struct<kind:string,text:string>>"))
            head = F.array(F.struct(F.lit("heading").alias("kind"), F.concat(e["k"], F.lit("：")).alias("text")))
            return F.concat(head, items)

        return F.flatten(F.transform(pairs, per_key))

    one = lambda t: F.array(F.struct(F.lit("value").alias("kind"), t.alias("text")))
    lines = F.when(is_str, one(shown)).when(is_obj, obj_lines()).otherwise(one(F.lit(empty)))
    return (rows.select("report", "sec_no", (F.col("_f") + 1).alias("field_no"), F.col("_e.key").alias("label"),
                        F.posexplode(lines).alias("_l", "_x"))
            .select("report", "sec_no", "field_no", "label", (F.col("_l") + 1).alias("line_no"),
                    F.col("_x.kind").alias("kind"), F.col("_x.text").alias("text")))


# ------------------------------------------------------------------------------------------------------- context
# The report text skeleton filled per report (placeholders in double braces).
REPORT_TEMPLATE = ("{{ idx1 }}、总结与评价\n{{ evaluation }}\n{{ idx2 }}、改进流程\n"
                   "{{ idx3 }}、改进建议\n1. {{ advice1 }}\n2. {{ advice2 }}\n3. {{ advice3 }}")


def report_context(reports: DataFrame, steps: DataFrame, template: str = REPORT_TEMPLATE,
                   numerals: Sequence[str] = tuple(fmt.CHINESE_NUMERALS), base_with_chart: int = 4,
                   base_without_chart: int = 3) -> DataFrame:
    """Per report (``report, has_chart, evaluation``) + steps -> ``(report, idx1..3, advice1..3, rendered)``.

    Section numbers continue after the fixed sections: numerals from ``base_with_chart`` when the report has charts,
    else from ``base_without_chart``; the first three steps become advice 1-3 (missing ones are ''), and the
    template's ``{{ name }}`` placeholders are replaced."""
    nums = F.array(*[F.lit(n) for n in numerals])
    base = F.when(F.col("has_chart"), F.lit(base_with_chart)).otherwise(F.lit(base_without_chart))
    first3 = (steps.where(F.col("step_no").isNotNull())
              .groupBy("report").agg(F.slice(F.array_sort(F.collect_list(F.struct("step_no", "value"))), 1, 3)
                                     .alias("_s")))
    ctx = reports.join(first3, "report", "left").select(
        "report", "evaluation",
        *[F.element_at(nums, base + (i + 1)).alias(f"idx{i + 1}") for i in range(3)],
        *[F.coalesce(F.try_element_at("_s", F.lit(i + 1))["value"], F.lit("")).alias(f"advice{i + 1}") for i in range(3)])
    text: Column = F.lit(template)
    for name in ["idx1", "idx2", "idx3", "evaluation", "advice1", "advice2", "advice3"]:
        text = F.replace(text, F.lit("{{ " + name + " }}"), F.coalesce(F.col(name), F.lit("")))
    return ctx.select("report", "idx1", "idx2", "idx3", "advice1", "advice2", "advice3", text.alias("rendered"))


# ------------------------------------------------------------------------------------------------------ document
def report_document(fields: DataFrame, analysis: DataFrame, steps: DataFrame, parts: Mapping[str, str],
                    analysis_section: str = "培训及考核情况分析（鱼骨图）", steps_section: str = fmt.SUGGESTIONS_KEY,
                    summary: DataFrame | None = None, metrics: Mapping[str, str] | None = None,
                    outline: DataFrame | None = None, outline_key: str = "trainingContent",
                    series: DataFrame | None = None) -> DataFrame:
    """Assemble one nested report per report id and serialise it: ``(report, document)``.

    ``fields`` = ``(report, sec_no, section, field_no, label, value)``; ``parts`` maps an output key to the section
    whose fields it lists as ``{section, fields: [{label, value}]}`` (in section, then field order) and ``metrics``
    likewise as ``{section, metrics: [...]}``.  ``outline`` = ``(report, pos, level, text)`` becomes
    ``[{item: {contents: [{text}]}, level}]`` under ``outline_key``.  ``analysis`` = ``(report, main_problem, cat_no,
    category, details)``; ``steps`` = ``(report, step_no, id, label, value)``.  With ``summary`` =
    ``(report, content)`` the steps are wrapped as ``conclusionSummary {title, summary, rectificationFlow}``, else
    ``rectificationFlow`` is a top-level key.  ``series`` = ``(report, col_no, unit, field, pos, name, value)`` adds
    one top-level ``col_<n>`` key per column, ``{unit, name, data: [{name, value}]}``, after the analysis.
    Each part is one aggregation per report, the parts are joined on the report id, and ``to_json`` writes the
    document (null fields kept)."""
    reports = fields.select("report").unionByName(analysis.select("report")).unionByName(
        steps.select("report")).distinct()
    doc = reports
    keys: list[str] = []

    def field_part(key: str, section: str, list_name: str):
        return (fields.where(F.col("section") == section)
                .groupBy("report").agg(F.array_sort(F.collect_list(F.struct(
                    "sec_no", "field_no", F.col("label"), F.col("value")))).alias("_f"))
                .select("report", F.struct(F.lit(section).alias("section"), F.transform(
                    "_f", lambda x: F.struct(x["label"].alias("label"), x["value"].alias("value"))).alias(list_name))
                        .alias(key)))

    for key, section in parts.items():
        doc = doc.join(field_part(key, section, "fields"), "report", "left")
        keys.append(key)
    if outline is not None:
        out = (outline.groupBy("report").agg(F.array_sort(F.collect_list(F.struct("pos", "level", "text"))).alias("_o"))
               .select("report", F.transform("_o", lambda x: F.struct(
                   F.struct(F.array(F.struct(x["text"].alias("text"))).alias("contents")).alias("item"),
                   x["level"].alias("level"))).alias(outline_key)))
        doc = doc.join(out, "report", "left")
        keys.append(outline_key)
    for key, section in (metrics or {}).items():
        doc = doc.join(field_part(key, section, "metrics"), "report", "left")
        keys.append(key)
    causes = (analysis.groupBy("report").agg(
        F.first("main_problem").alias("_mp"),
        F.array_sort(F.collect_list(F.struct("cat_no", "category", "details"))).alias("_c"))
        .select("report", F.struct(F.lit(analysis_section).alias("section"), F.col("_mp").alias("mainProblem"),
                                   F.transform("_c", lambda x: F.struct(x["category"].alias("category"),
                                                                        x["details"].alias("details")))
                                   .alias("causes")).alias("assessmentAnalysis")))
    flow_struct = lambda s: F.struct(F.lit(steps_section).alias("section"), F.transform(
        s, lambda x: F.struct(x["id"].alias("id"), x["label"].alias("label"), x["value"].alias("value")))
        .alias("steps"))
    flow = (steps.groupBy("report").agg(F.array_sort(F.collect_list(F.struct("step_no", "id", "label", "value")))
                                        .alias("_s"))
            .select("report", flow_struct(F.col("_s")).alias("rectificationFlow")))
    doc = doc.join(causes, "report", "left").join(flow, "report", "left")
    keys.append("assessmentAnalysis")
    if summary is not None:
        doc = doc.join(summary.select("report", F.col("content").alias("_sum")), "report", "left")
        tail = [F.struct(F.lit("总结与改进建议").alias("title"),
                         F.struct(F.lit("总结").alias("section"), F.col("_sum").alias("content")).alias("summary"),
                         F.col("rectificationFlow")).alias("conclusionSummary")]
    else:
        tail = [F.col("rectificationFlow")]
    head = F.to_json(F.struct(*[F.col(k) for k in keys]), {"ignoreNullFields": "false"})
    end = F.to_json(F.struct(*tail), {"ignoreNullFields": "false"})
    if series is None:
        text = F.to_json(F.struct(*[F.col(k) for k in keys], *tail), {"ignoreNullFields": "false"})
        return doc.select("report", text.alias("document"))
    # Series keys (col_1 .. col_n) differ per report, so they are serialised as a map and spliced between the
    # analysis and the closing part of the document text.
    per_col = (series.groupBy("report", "col_no", "unit", "field")
               .agg(F.array_sort(F.collect_list(F.struct("pos", "name", "value"))).alias("_d"))
               .select("report", F.struct(F.col("col_no"), F.concat(F.lit("col_"), F.col("col_no").cast("string"))
                                          .alias("k"),
                                          F.struct("unit", F.col("field").alias("name"), F.transform(
                                              "_d", lambda x: F.struct(x["name"].alias("name"),
                                                                       x["value"].alias("value"))).alias("data"))
                                          .alias("v")).alias("_e")))
    cols = (per_col.groupBy("report").agg(F.array_sort(F.collect_list("_e")).alias("_es"))
            .select("report", F.to_json(F.map_from_entries(F.transform("_es", lambda e: F.struct(e["k"], e["v"]))))
                    .alias("_series")))
    doc = doc.join(cols, "report", "left")
    inner = lambda j: F.expr(f"substr({j}, 2, length({j}) - 2)")
    with_series = F.concat(F.lit("{"), inner("_head"), F.lit(","), inner("_series"), F.lit(","), inner("_end"),
                           F.lit("}"))
    plain = F.concat(F.lit("{"), inner("_head"), F.lit(","), inner("_end"), F.lit("}"))
    return (doc.select("report", head.alias("_head"), end.alias("_end"), "_series")
            .select("report", F.when(F.col("_series").isNull() | (F.col("_series") == "{}"), plain)
                    .otherwise(with_series).alias("document")))
