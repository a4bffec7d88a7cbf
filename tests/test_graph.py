"""Tree, flow and report operators."""

import hashlib
import json

from pyspark.sql import functions as F

from tessera.operators.graph import cause_tree, flow_edges, nest_tree, tree_levels, tree_rollup
from tessera.operators.report import display_fields, report_context, report_document


def test_cause_tree_ids(spark):
    problems = spark.createDataFrame([("r", "部分科室参训不足；操作考核问题较多")], "report string, main_problem string")
    causes = spark.createDataFrame([("r", 1, "排班与调度问题", ["a1", "a2"]), ("r", 2, "培训时间安排", ["b1"])],
                                   "report string, cat_no int, category string, details array<string>")
    nodes = {(r.id, r.fid, r.level, r.name) for r in cause_tree(problems, causes).collect()}
    sfx = lambda s: str(int(hashlib.md5(s.encode()).hexdigest()[:8], 16) % 10000)
    assert ("1", "0", 1, "部分科室参训不足；操作考核问题较多") in nodes
    assert ("1001", "1", 2, "排班与调度问题") in nodes and ("1002", "1", 2, "培训时间安排") in nodes
    assert ("10011" + sfx("a1"), "1001", 3, "a1") in nodes and ("10021" + sfx("b1"), "1002", 3, "b1") in nodes
    tree = nest_tree(cause_tree(problems, causes)).first().tree
    assert [c.name for c in tree.children] == ["排班与调度问题", "培训时间安排"]
    assert [d.name for d in tree.children[0].children] == ["a1", "a2"]


def forest(spark):
    rows = [("t", "1", "0", "root", 1), ("t", "a", "1", "Alpha", 1), ("t", "b", "1", "b", 2), ("t", "c", "1", "中文", 3),
            ("t", "a1", "a", "x", 1), ("t", "a11", "a1", "deep", 1), ("t", "z", "missing", "orphan", 1),
            ("u", "r", "0", "solo", 1)]
    return spark.createDataFrame(rows, "tree string, id string, fid string, name string, ordinal int")


def test_tree_levels_depth_and_orphans(spark):
    got = {(r.tree, r.id): (r.level, r.depth, r.too_deep) for r in tree_levels(forest(spark)).collect()}
    assert got[("t", "1")] == (1, 4, True) and got[("t", "a11")] == (4, 4, True)
    assert got[("t", "z")][0] is None
    assert got[("u", "r")] == (1, 1, False)


def test_tree_levels_of_deep_chains_and_cycles(spark):
    chain = [("d", str(i), str(i - 1), f"n{i}", i) for i in range(1, 24)]       # 1 hangs off the root parent "0"
    cycle = [("d", "x", "y", "x", 1), ("d", "y", "x", "y", 1), ("d", "w", "x", "w", 1), ("d", "o", "none", "o", 1),
             ("d", "p", "o", "p", 1), ("e", "s", "s", "self", 1), ("f", "r", None, "root", 1), ("f", "r", None, "root", 1)]
    nodes = spark.createDataFrame(chain + cycle, "tree string, id string, fid string, name string, ordinal int")
    levelled = tree_levels(nodes)
    got = {(r.tree, r.id): (r.level, r.depth, r.too_deep) for r in levelled.collect()}
    assert all(got[("d", str(i))] == (i, 23, True) for i in range(1, 24))
    assert all(got[("d", i)] == (None, 23, True) for i in "xywop") and got[("e", "s")] == (None, None, None)
    assert got[("f", "r")] == (1, 1, False) and levelled.count() == nodes.count()
    kids = {(r.tree, r.id): r.child_count for r in tree_rollup(levelled).collect()}
    assert [kids[("d", i)] for i in ("1", "7", "22", "23", "x", "y", "o", "w")] == [1, 1, 1, 0, 2, 1, 1, 0]
    assert kids[("e", "s")] == 1
    assert tree_levels(nodes.limit(0)).count() == 0


def test_tree_rollup_counts_widths_and_pairs(spark):
    out = {r.id: r for r in tree_rollup(tree_levels(forest(spark))).collect()}
    assert out["1"].child_count == 3 and out["a"].child_count == 1 and out["b"].child_count == 0
    # widest level-2 child of the root: "中文" = 2*13 + 50 = 76; "Alpha" = 8 + 4*5 + 50 = 78
    assert out["1"].max_child_width == 78
    assert [(out[i].team, out[i].side) for i in ("a", "b", "c")] == [(1, "up"), (1, "down"), (2, "up")]


def test_flow_edges_problem_text_and_steps(spark):
    fields = spark.createDataFrame([
        ("r", "overview", 0, 1, "培训主题", "手卫生"), ("r", "overview", 0, 2, "组织部门", ""),
        ("r", "participation", 2, 1, "存在问题", json.dumps({"总结": "参训不足", "具体问题": ["1、a", "2、b"]}, ensure_ascii=False)),
        ("w", "overview", 0, 1, "培训主题", "x"), ("n", "participation", 2, 1, "存在问题", None)],
        "report string, part string, sec_no int, field_no int, label string, value string")
    steps = spark.createDataFrame([("r", 1, "优化排班"), ("r", 2, "")], "report string, step_no int, value string")
    e = {(r.report, r.src, r.dst): r for r in flow_edges(fields, steps).collect()}
    assert e[("r", "A", "B")].src_label == "启动专项培训\\n手卫生"
    assert e[("r", "A", "B")].dst_label == "组织部门: N/A"
    assert e[("r", "H", "J")].dst_label == "问题分析: 参训不足\\n1、a\\n2、b" and e[("r", "H", "J")].edge_label == "否"
    assert e[("r", "J", "R1")].dst_label == "优化排班" and e[("r", "R1", "R2")].dst_label == "N/A"
    assert e[("w", "H", "J")].dst_label == "问题分析: 无" and e[("n", "H", "J")].dst_label == "问题分析: N/A"
    assert len([k for k in e if k[0] == "w"]) == 10


def test_display_fields_rules(spark):
    body = json.dumps({"a": "  ", "b": " x ", "n": 5, "p": {"总结": "s", "具体问题": ["i1", "i2"], "k": 1}},
                      ensure_ascii=False)
    secs = spark.createDataFrame([("r", 0, body)], "report string, sec_no int, body string")
    got = [(r.label, r.line_no, r.kind, r.text) for r in display_fields(secs).orderBy("field_no", "line_no").collect()]
    assert got == [("a", 1, "value", "/"), ("b", 1, "value", "x"), ("n", 1, "value", "/"),
                   ("p", 1, "heading", "总结："), ("p", 2, "item", "s"), ("p", 3, "heading", "具体问题："),
                   ("p", 4, "item", "i1"), ("p", 5, "item", "i2"), ("p", 6, "heading", "k：")]


def test_report_context_numerals_and_short_steps(spark):
    reports = spark.createDataFrame([("c", True, "ev"), ("n", False, "")], "report string, has_chart boolean, evaluation string")
    steps = spark.createDataFrame([("c", 1, "s1"), ("c", 2, "s2"), ("c", 3, "s3"), ("c", 4, "s4"), ("n", 1, "only")],
                                  "report string, step_no int, value string")
    got = {r.report: r for r in report_context(reports, steps).collect()}
    assert (got["c"].idx1, got["c"].idx3, got["c"].advice3) == ("四", "六", "s3")
    assert (got["n"].idx1, got["n"].advice1, got["n"].advice2) == ("三", "only", "")
    assert "1. s1" in got["c"].rendered and "{{" not in got["n"].rendered


def test_report_document_shape(spark):
    fields = spark.createDataFrame([("r", 0, "概况", 1, "培训时间", "5月"), ("r", 0, "概况", 2, "授课专家", "")],
                                   "report string, sec_no int, section string, field_no int, label string, value string")
    analysis = spark.createDataFrame([("r", "问题", 1, "类", ["d"])],
                                     "report string, main_problem string, cat_no int, category string, details array<string>")
    steps = spark.createDataFrame([("r", 1, "rec_1", "建议内容", "v")], "report string, step_no int, id string, label string, value string")
    doc = json.loads(report_document(fields, analysis, steps, {"orgOverview": "概况"}).first().document)
    assert doc["orgOverview"] == {"section": "概况", "fields": [{"label": "培训时间", "value": "5月"},
                                                               {"label": "授课专家", "value": ""}]}
    assert doc["assessmentAnalysis"]["mainProblem"] == "问题"
    assert doc["rectificationFlow"]["steps"] == [{"id": "rec_1", "label": "建议内容", "value": "v"}]


def test_pretty_json_keeps_order_and_text(spark):
    from tessera.sources.files import pretty_json

    df = spark.createDataFrame([('{"b":1,"a":{"总结":"é"}}',)], "d string")
    out = df.select(pretty_json("d").alias("p")).first().p
    assert out == '{\n  "b": 1,\n  "a": {\n    "总结": "é"\n  }\n}'


def test_block_table_iso_timestamp(spark):
    from tessera.operators.blocks import block_table

    b = block_table(spark.createDataFrame([("/a.txt", "x")], "f string, c string"), filename=F.col("f"),
                    content=F.col("c"), content_type=F.lit("text"), order_index=F.lit(0), with_time=True).first()
    import re
    assert re.match(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}$", b.timestamp)


def test_report_document_full_shape(spark):
    fields = spark.createDataFrame([("r", 0, "培训组织概况", 1, "培训时间", "5月"), ("r", 4, "考核结果", 1, "最终通过率", "89.7%")],
                                   "report string, sec_no int, section string, field_no int, label string, value string")
    analysis = spark.createDataFrame([("r", "问题", 1, "类", ["d"])],
                                     "report string, main_problem string, cat_no int, category string, details array<string>")
    steps = spark.createDataFrame([("r", 1, "rec_1", "建议内容", "v")], "report string, step_no int, id string, label string, value string")
    outline = spark.createDataFrame([("r", 0, 0, "培训内容包含以下四大核心模块："), ("r", 1, 1, "• A；")],
                                    "report string, pos int, level int, text string")
    series = spark.createDataFrame([("r", 2, "人", "实参训人数", 1, "ICU", 45.0), ("r", 1, "人", "应参训人数", 1, "ICU", 45.0),
                                    ("r", 2, "人", "实参训人数", 2, "儿科", 46.0)],
                                   "report string, col_no int, unit string, field string, pos int, name string, value double")
    summary = spark.createDataFrame([("r", "总结文字")], "report string, content string")
    doc = report_document(fields, analysis, steps, {"orgOverview": "培训组织概况"}, summary=summary,
                          metrics={"assessmentChart": "考核结果"}, outline=outline, series=series).first().document
    d = json.loads(doc)
    assert list(d) == ["orgOverview", "trainingContent", "assessmentChart", "assessmentAnalysis", "col_1", "col_2",
                       "conclusionSummary"]
    assert d["trainingContent"][1] == {"item": {"contents": [{"text": "• A；"}]}, "level": 1}
    assert d["assessmentChart"] == {"section": "考核结果", "metrics": [{"label": "最终通过率", "value": "89.7%"}]}
    assert d["col_2"] == {"unit": "人", "name": "实参训人数", "data": [{"name": "ICU", "value": 45.0},
                                                                {"name": "儿科", "value": 46.0}]}
    assert d["conclusionSummary"]["summary"] == {"section": "总结", "content": "总结文字"}
    assert d["conclusionSummary"]["rectificationFlow"]["steps"][0]["id"] == "rec_1"


def test_display_fields_falsy_rule(spark):
    body = json.dumps({"a": "  ", "b": "", "c": " x "}, ensure_ascii=False)
    secs = spark.createDataFrame([("r", 0, body)], "report string, sec_no int, body string")
    got = [(r.label, r.text) for r in display_fields(secs, rule="falsy").orderBy("field_no").collect()]
    assert got == [("a", "  "), ("b", "/"), ("c", " x ")]
