"""Section operators on re-typed golden sections and the fold cases."""

import json

from pyspark.sql import functions as F

from tessera.operators.sections import (append_sections, block_parse, cause_rows, field_format_check, json_repair,
                                        main_problem, section_fields, section_outline, section_rows,
                                        suggestion_steps, template_fill)

# Re-typed from a recorded report (sections 2 and 5 shortened to their analysis fields).
SEC2 = {"整体参训率": "92.2%", "存在问题": {"总结": "部分科室参训不足", "具体问题": ["1、外科未完成学习任务"]},
        "原因分析": {"排班与调度问题": ["1、轮班制度导致无法参加", "2、调度不灵活"], "培训形式适应性": ["1、线上不熟悉"],
                 "培训时间安排": ["1、未考虑高峰期"]}}
SEC5 = {"存在问题": {"总结": "操作考核问题较多", "具体问题": []},
        "原因分析": {"操作规范掌握不足": ["1、掌握不够熟练", "2、习惯性错误"], "培训效果转化不足": ["1、转化不理想", "2、理解不足"],
                 "考核标准执行严格": ["1、标准严格"]}}
SEC_EMPTY = {"存在问题": {"总结": "", "具体问题": []}, "原因分析": {}, "整改措施": ""}


def sections(spark, *bodies):
    rows = [("r1", i, f"s{i}", json.dumps(b, ensure_ascii=False)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "report string, sec_no int, section string, body string")


def test_main_problem_and_causes(spark):
    s = sections(spark, {"培训时间": "2025年5月"}, SEC2, "not an object", SEC5)
    assert main_problem(s).first().main_problem == "部分科室参训不足；操作考核问题较多"
    causes = [(r.cat_no, r.category, r.details) for r in cause_rows(s).orderBy("cat_no").collect()]
    assert [c[1] for c in causes] == ["排班与调度问题", "培训形式适应性", "培训时间安排", "操作规范掌握不足", "培训效果转化不足",
                                      "考核标准执行严格"]
    assert causes[0] == (1, "排班与调度问题", ["1、轮班制度导致无法参加", "2、调度不灵活"])


def test_cause_details_are_strings_only(spark):
    body = json.dumps({"原因分析": {"Z": 5, "B": ["x ", 7, None, ["n"], ""], "C": {"k": "v"}, "D": '{"a": 1}', "E": None, "A": " s "}},
                      ensure_ascii=False)
    other = json.dumps({"原因分析": '{"F": "text, not an object"}'}, ensure_ascii=False)
    s = spark.createDataFrame([("r", 0, "s", body), ("r", 1, "s", other), ("r", 2, "s", "[1]"), ("r", 3, "s", None), ("q", 0, "s", "no json")],
                              "report string, sec_no int, section string, body string")
    got = [(r.cat_no, r.category, r.details) for r in cause_rows(s).orderBy("cat_no").collect()]
    assert got == [(1, "Z", []), (2, "B", ["x"]), (3, "C", []), (4, "D", ['{"a": 1}']), (5, "E", []), (6, "A", ["s"])]


def test_empty_analysis_and_scalar_cause(spark):
    s = sections(spark, SEC_EMPTY, {"原因分析": {"单项": " 只有一条 ", "空": ["", "  "]}})
    assert main_problem(s).first().main_problem == ""
    got = [(r.category, r.details) for r in cause_rows(s).orderBy("cat_no").collect()]
    assert got == [("单项", ["只有一条"]), ("空", [])]


def test_fields_keep_key_order_and_nested_text(spark):
    s = sections(spark, {"b": "2", "a": "1", "存在问题": {"总结": "x", "具体问题": []}})
    got = [(r.field_no, r.label, r.value) for r in section_fields(s).orderBy("field_no").collect()]
    assert got[:2] == [(1, "b", "2"), (2, "a", "1")]
    assert json.loads(got[2][2]) == {"总结": "x", "具体问题": []}


def test_outline_keeps_blank_values(spark):
    s = sections(spark, {"核心模块1": "A", "核心模块2": ""})
    got = [(r.pos, r.level, r.text) for r in section_outline(s).orderBy("pos").collect()]
    assert got == [(0, 0, "培训内容包含以下四大核心模块："), (1, 1, "• A；"), (2, 1, "• ；")]


def test_section_rows_and_append(spark):
    doc = json.dumps([{"培训组织概况": {"a": "1"}}, {"培训内容": {"m": "x"}}], ensure_ascii=False)
    docs = spark.createDataFrame([("r", doc), ("bad", "not json")], "report string, text string")
    secs = section_rows(docs, "report", "text")
    assert [(r.sec_no, r.section) for r in secs.orderBy("sec_no").collect()] == [(0, "培训组织概况"), (1, "培训内容")]
    extra = spark.createDataFrame([("r", 0, "统计表", "{}")], "report string, sec_no int, section string, body string")
    both = append_sections(secs, extra)
    assert [(r.sec_no, r.section) for r in both.orderBy("sec_no").collect()][-1] == (2, "统计表")


FOLD_CASES = [
    (["1、a", "2、b"], {1: "a", 2: "b"}),
    (["x", "1、b"], {1: "b"}),
    (["2、x", "y"], {2: "y"}),
    (["3.c", "q", "1.a"], {1: "a", 2: "q", 3: "c"}),
    (["10、z", "2、y"], {2: "y", 10: "z"}),
    (["1、a\nb"], {1: "a"}),
]


def test_suggestion_fold_cases(spark):
    rows = [(i, j, t) for i, (items, _) in enumerate(FOLD_CASES) for j, t in enumerate(items)]
    df = spark.createDataFrame(rows, "r int, p int, t string")
    got = {}
    for r in suggestion_steps(df, "r", "p", "t").collect():
        got.setdefault(r.report, {})[r.step_no] = r.value
        assert r.id == f"rec_{r.step_no}" and r.label == "建议内容"
    assert [got[i] for i in range(len(FOLD_CASES))] == [exp for _, exp in FOLD_CASES]


def test_json_repair_cases(spark):
    df = spark.createDataFrame([(1, '{"a": 1}'), (2, 'Here:\n```json\n{"b": [1, 2]}\n```\nbye'), (3, "no json here")],
                               "id int, reply string")
    got = {r.id: (r.source, r.json_text) for r in json_repair(df, "reply").collect()}
    assert got == {1: ("raw", '{"a": 1}'), 2: ("fenced", '{"b": [1, 2]}'), 3: (None, None)}


def test_block_parse_routes(spark):
    text = ("====文件名：/d/统计.xlsx====\n\n信息类型: table\n内容：Sheet: S\n科室名称,人数\n\n"
            "====文件名：/d/a.docx====\n\n信息类型: text\n内容： 正文 \n\n信息类型: table\n内容：x\n\n   "
            "====文件名：broken block")
    df = spark.createDataFrame([(text,)], "t string")
    got = {r.filename: (r.info_type, r.route, r.content, r.text_block) for r in block_parse(df, "t").collect()}
    assert got["/d/统计.xlsx"][:2] == ("table", "table") and got["/d/统计.xlsx"][3] is None
    assert got["/d/a.docx"][2] == "正文 \n\n信息类型: table\n内容：x"
    assert got["/d/a.docx"][3].startswith("====文件名：/d/a.docx====\n\n信息类型: text\n内容：正文")
    assert len(got) == 2


def test_format_checks(spark):
    df = spark.createDataFrame([("2025年5月10日至5月25日",), ("92.2%",), ("100.00%",), ("37分钟",), ("82.5",)],
                               "value string")
    got = {r.value: (r.is_date, r.is_percent, r.is_number, r.is_duration) for r in field_format_check(df).collect()}
    assert got["2025年5月10日至5月25日"] == (True, False, False, False)
    assert got["92.2%"] == (False, True, False, False)
    assert got["100.00%"] == (False, False, False, False)
    assert got["37分钟"][3] and got["82.5"][2]


def test_template_fill_blanks_missing(spark):
    s = sections(spark, {"培训时间": "2025年5月"}, {"培训时间": "6月"})
    got = [(r.label, r.value) for r in template_fill(s, section_fields(s), [("s1", "培训时间"), ("s1", "授课专家")])
           .orderBy("field_no").collect()]
    assert got == [("培训时间", "6月"), ("授课专家", "")]


def test_json_documents_from_files_to_sections(spark):
    import os
    import tempfile

    from tessera.sources.files import read_json_documents

    d = tempfile.mkdtemp(prefix="tessera-json-")
    doc = [{"培训组织概况": {"培训时间": "2025年5月", "授课专家": ""}}, {"培训内容": {"核心模块1": "A"}}]
    with open(os.path.join(d, "raw_output.json"), "w", encoding="utf-8") as f:
        json.dump(doc, f, ensure_ascii=False, indent=2)
    docs = read_json_documents(spark, d)
    secs = section_rows(docs, "path", "text")
    got = [(r.sec_no, r.section) for r in secs.orderBy("sec_no").collect()]
    assert got == [(0, "培训组织概况"), (1, "培训内容")]
    fields = [(r.label, r.value) for r in section_fields(secs.withColumnRenamed("path", "report"))
              .where("sec_no = 0").orderBy("field_no").collect()]
    assert fields == [("培训时间", "2025年5月"), ("授课专家", "")]
