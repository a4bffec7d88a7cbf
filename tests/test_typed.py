"""Typed values of reports: kinds, order, repeated labels, the value ladder and the whole document."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import json_string, number_text, value_json
from tessera.operators.typed import paired_series, report_series, typed_fields, typed_report

BODY = '{"z": 1.5, "a": "12", "n": null, "t": true, "o": {"y": 1, "b": [1, {"q": "x", "c": 2}]}, "z": "say \\"hi\\"\\n", "l": [1, "2"], "e": ""}'


def sections(spark, *bodies):
    return spark.createDataFrame([(1, i, "s", b) for i, b in enumerate(bodies)], "report int, sec_no int, section string, body string")


def test_fields_keep_types_order_and_the_last_of_a_repeated_label(spark):
    got = typed_fields(sections(spark, BODY)).orderBy("field_no").collect()
    want = json.loads(BODY)
    assert [r.label for r in got] == list(want) and [r.field_no for r in got] == list(range(1, 8))
    assert [r.kind for r in got] == ["string", "string", "null", "boolean", "object", "array", "string"]
    assert {r.label: json.loads(r.json) for r in got} == want
    assert json.dumps(json.loads(got[4].json)) == json.dumps(want["o"])       # nested keys in the text's order
    assert got[1].value == "12" and got[2].value is None


def test_bodies_without_fields(spark):
    assert typed_fields(sections(spark, None, "", "[1]", '"x"', "{}", "{broken", "null")).count() == 0
    assert typed_fields(sections(spark, " \n{\"a\": 1} ")).count() == 1


@pytest.mark.parametrize("raw, want", [("95%", 95.0), ("12.5%", 12.5), ("007", 7), ("0", 0), ("91", 91), ("91.50", 91.5), ("-3", -3.0), ("1e20", 1e20),
                                       ("n/a", "n/a"), ("", ""), ("1_000", "1_000"), ("a%", "a%"), ('q"', 'q"')])
def test_value_ladder_as_literals(spark, raw, want):
    got = spark.createDataFrame([(raw,)], "raw string").select(value_json("raw")).first()[0]
    assert json.loads(got) == want and type(json.loads(got)) is type(want)


def test_string_literals_and_plain_numbers(spark):
    texts = ["", "a\"b\\c\n\t", "é漢😀", None]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(json_string("t")).collect()]
    assert [json.loads(x) for x in got] == texts
    numbers = [0.0, 1.5, 1e7, 12345678.0, 1e-3, 1e-4, 1e-5, 1e16, -2.5e-7, 123456789012.25]
    rows = spark.createDataFrame([(float(x),) for x in numbers], "x double").select("x", number_text("x")).collect()
    assert [r[1] for r in rows] == [str(x) for x in numbers]


def wide(spark):
    rows = [(1, 0, "a", "10", "50%"), (1, 1, "b", "n/a", "7"), (1, 2, "合计", "1%", "9"), (2, 0, "a", "10", None), (2, 1, "c", "11", "3"), (None, 0, "d", "1", "2")]
    return spark.createDataFrame(rows, "report int, pos int, name string, x string, y string")


def test_series_of_many_reports(spark):
    got = {(r.report, r.field, r.name): (r.unit, r.json) for r in report_series(wide(spark), "report", "name", "pos", ["x", "y"]).collect()}
    assert got == {(1, "x", "a"): ("%", "10"), (1, "x", "b"): ("%", '"n/a"'), (1, "y", "a"): ("%", "50.0"), (1, "y", "b"): ("%", "7"),
                   (2, "x", "a"): ("人", "10"), (2, "x", "c"): ("人", "11"), (2, "y", "a"): ("人", '""'), (2, "y", "c"): ("人", "3"),
                   (None, "x", "d"): ("人", "1"), (None, "y", "d"): ("人", "2")}
    pairs = {(r.report, r.pos): (r.name, r.x, r.y) for r in paired_series(report_series(wide(spark), "report", "name", "pos", ["x", "y"]), 1, 2).collect()}
    assert pairs[1, 1] == ("b", '"n/a"', "7") and len(pairs) == 5


def test_whole_document(spark):
    fields = typed_fields(sections(spark, '{"k": 1, "o": {"b": 1, "a": null}}').withColumn("section", F.lit("概述")).unionAll(
        sections(spark, '{"m": "一", "n": 2}').withColumn("section", F.lit("内容"))))
    analysis = spark.createDataFrame([(1, "少", 1, "人", ["x", "y"]), (1, "少", 2, "法", [])], "report int, main_problem string, cat_no int, category string, details array<string>")
    steps = spark.createDataFrame([(1, 2, "rec_2", "建议内容", "b"), (1, 1, "rec_1", "建议内容", "a"), (9, 1, "rec_1", "建议内容", "only")], "report int, step_no int, id string, label string, value string")
    series = report_series(wide(spark).where("report = 1"), "report", "name", "pos", ["x", "y"])
    summary = spark.createDataFrame([(1, "结")], "report int, content string")
    got = {r.report: json.loads(r.document) for r in typed_report(
        fields, analysis, series, steps, summary, {"orgOverview": "概述"}, ("trainingContent", "内容"), {"assessmentChart": "无"}).collect()}
    doc = got[1]
    assert list(doc) == ["orgOverview", "trainingContent", "assessmentChart", "assessmentAnalysis", "col_1", "col_2", "conclusionSummary"]
    assert doc["orgOverview"] == {"section": "概述", "fields": [{"label": "k", "value": 1}, {"label": "o", "value": {"b": 1, "a": None}}]}
    assert [(x["item"]["contents"][0]["text"], x["level"]) for x in doc["trainingContent"][1:]] == [("• 一；", 1), ("• 2；", 1)]
    assert doc["assessmentAnalysis"]["causes"] == [{"category": "人", "details": ["x", "y"]}, {"category": "法", "details": []}]
    assert doc["col_2"] == {"unit": "%", "name": "y", "data": [{"name": "a", "value": 50.0}, {"name": "b", "value": 7}]}
    assert [s["value"] for s in doc["conclusionSummary"]["rectificationFlow"]["steps"]] == ["a", "b"]
    assert doc["assessmentChart"]["metrics"] == [] and got[9]["orgOverview"]["fields"] == [] and "col_1" not in got[9]


def test_every_source_of_a_report_is_computed_once(spark, tmp_path, capsys):
    from tessera.operators.typed import typed_report

    def stored(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    fields = stored("fields_", [(1, 1, "s", 1, "a", "1", "1"), (None, 1, "s", 1, "a", "9", "9")],
                    "report long, sec_no long, section string, field_no int, label string, value string, json string")
    analysis = stored("analysis_", [(2, "p", 1, "c", ["d"])], "report long, main_problem string, cat_no int, category string, details array<string>")
    series = stored("series_", [(3, 1, "f", "%", 1, "e", "5")], "report long, col_no int, field string, unit string, pos long, name string, json string")
    steps = stored("steps_", [(None, 1, "i", "l", "v")], "report long, step_no int, id string, label string, value string")
    summary = stored("summary_", [(1, "sum")], "report long, content string")
    doc = typed_report(fields, analysis, series, steps, summary, {"x": "s"}, ("o", "t"), {"m": "u"})
    doc.explain("formatted")
    plan = capsys.readouterr().out
    assert all(plan.count(f"/{n}_]") == 1 for n in ("fields", "analysis", "series", "steps"))
    got = {r.report: json.loads(r.document) for r in doc.collect()}
    assert set(got) == {1, 2, 3, None} and got[None]["x"]["fields"] == []
    assert got[1]["x"]["fields"] == [{"label": "a", "value": 1}] and got[3]["col_1"]["data"] == [{"name": "e", "value": 5}]
