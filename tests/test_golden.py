"""Golden checks re-typed from a recorded report: department table -> series, and report fields -> flow chart."""

import json

from pyspark.sql import functions as F

from tessera.operators.graph import flow_edges
from tessera.operators.tables import parse_tables, unpivot_series

HEADER = ["科室名称", "应参训人数", "实参训人数", "缺勤人数", "参训率", "理论考试参考人数", "理论通过人数", "操作考核通过人数",
          "总体通过率"]
DEPARTMENTS = [
    ("ICU", "45", "45", "0", "100.00%", "45", "45", "44", "97.80%"),
    ("急诊科", "38", "38", "0", "100.00%", "38", "37", "36", "94.70%"),
    ("手术室", "56", "56", "0", "100.00%", "56", "55", "54", "96.40%"),
    ("外科一病区", "62", "57", "5", "91.90%", "57", "49", "47", "82.50%"),
    ("外科二病区", "60", "52", "8", "86.70%", "52", "42", "41", "78.80%"),
    ("内科", "70", "66", "4", "94.30%", "66", "60", "59", "89.40%"),
    ("儿科", "49", "46", "3", "93.90%", "46", "44", "43", "91.50%"),
    ("康复医学科", "42", "36", "6", "85.70%", "36", "30", "28", "77.80%"),
    ("中医科", "25", "22", "3", "88.00%", "22", "21", "20", "90.90%"),
    ("感控科", "9", "9", "0", "100.00%", "9", "9", "9", "100.00%"),
    ("妇产科", "48", "47", "1", "97.90%", "47", "45", "44", "93.60%"),
    ("重症医学科", "33", "33", "0", "100.00%", "33", "32", "32", "96.90%"),
    ("神经内科", "38", "35", "3", "92.10%", "35", "34", "34", "97.10%"),
    ("神经外科", "36", "31", "5", "86.10%", "31", "27", "26", "83.90%"),
    ("呼吸科", "40", "37", "3", "92.50%", "37", "36", "36", "97.30%"),
    ("皮肤科", "15", "15", "0", "100.00%", "15", "15", "14", "93.30%"),
    ("检验科", "22", "22", "0", "100.00%", "22", "22", "22", "100.00%"),
    ("放射科", "20", "19", "1", "95.00%", "19", "18", "18", "94.70%"),
    ("麻醉科", "18", "18", "0", "100.00%", "18", "18", "17", "94.40%"),
    ("药剂科", "12", "12", "0", "100.00%", "12", "12", "12", "100.00%"),
]
# Expected series: (unit, number of points, sum of values) per column.
EXPECTED = {1: ("人", 20, 738), 2: ("人", 20, 696), 3: ("人", 20, 42), 4: ("%", 20, 1904.1), 5: ("人", 20, 696),
            6: ("人", 20, 651), 7: ("人", 20, 636), 8: ("%", 20, 1851.0)}


def test_department_table_to_series(spark):
    text = "Sheet: Sheet1\n" + ",".join(HEADER) + "\n" + "\n".join(",".join(r) for r in DEPARTMENTS) + "\n"
    tables = spark.createDataFrame([("/data/手卫生培训各科室参与与考核情况统计.xlsx", text)], "name string, content string")
    rows = parse_tables(tables, name_col="name")
    assert {r.title for r in rows.collect()} == {"手卫生培训各科室参与与考核情况统计"}
    wide = rows.select("row_no", *[F.col("row")[h].alias(h) for h in HEADER])
    long = unpivot_series(wide, "科室名称", "row_no").collect()
    got = {}
    for r in long:
        unit, n, total = got.get(r.col_no, (r.unit, 0, 0.0))
        got[r.col_no] = (unit, n + 1, total + r.value)
    assert {k: (u, n, round(t, 1)) for k, (u, n, t) in got.items()} == EXPECTED
    col4 = [r.value for r in sorted((r for r in long if r.col_no == 4), key=lambda r: r.pos)]
    assert col4[:5] == [100.0, 100.0, 100.0, 91.9, 86.7]
    assert {r.field for r in long if r.col_no == 8} == {"总体通过率"}


def test_recorded_flow_chart(spark):
    problem = {"总结": "部分科室参训不足", "具体问题": ["1、外科、康复医学科因轮班冲突或任务调度问题，部分人员未完成学习任务"]}
    fields = spark.createDataFrame([
        ("r", "overview", 0, 2, "培训主题", "手卫生执行力与依从性"), ("r", "overview", 0, 3, "组织部门", "医院感控科联合护理部"),
        ("r", "overview", 0, 6, "培训形式", "线上学习+线下集中授课"), ("r", "participation", 2, 8, "整体参训率", "92.2%"),
        ("r", "participation", 2, 13, "存在问题", json.dumps(problem, ensure_ascii=False)),
        ("r", "metrics", 4, 3, "理论考试平均成绩", "82.5"), ("r", "metrics", 4, 4, "操作评估合格率", "87.4%"),
        ("r", "metrics", 4, 5, "最终通过率", "89.7%")],
        "report string, part string, sec_no int, field_no int, label string, value string")
    steps = spark.createDataFrame([
        ("r", 1, "针对外科和康复医学科等参训率较低的科室，优化培训时间安排或提供补训机会。"),
        ("r", 2, "加强操作考核中的薄弱环节培训，如水量控制和指缝覆盖等细节问题。"),
        ("r", 3, "定期开展手卫生复查和反馈机制，确保培训效果持续改进。")], "report string, step_no int, value string")
    edges = [(r.src, r.dst, r.edge_label, r.dst_label)
             for r in flow_edges(fields, steps).orderBy("seq").collect()]
    first = flow_edges(fields, steps).where("seq = 1").first()
    assert first.src_label == "启动专项培训\\n手卫生执行力与依从性"
    assert edges == [
        ("A", "B", "", "组织部门: 医院感控科联合护理部"),
        ("B", "C", "", "培训形式: 线上学习+线下集中授课"),
        ("C", "D", "", "培训内容实施"),
        ("D", "E", "", "整体参训率: 92.2%"),
        ("E", "F", "", "理论考试平均成绩: 82.5"),
        ("F", "G", "", "操作合格率: 87.4%"),
        ("G", "H", "", "是否达标"),
        ("H", "I", "是", "最终通过率: 89.7%"),
        ("H", "J", "否", "问题分析: 部分科室参训不足\\n1、外科、康复医学科因轮班冲突或任务调度问题，部分人员未完成学习任务"),
        ("I", "K", "", "总结与持续改进"),
        ("J", "R1", "", "针对外科和康复医学科等参训率较低的科室，优化培训时间安排或提供补训机会。"),
        ("R1", "R2", "", "加强操作考核中的薄弱环节培训，如水量控制和指缝覆盖等细节问题。"),
        ("R2", "R3", "", "定期开展手卫生复查和反馈机制，确保培训效果持续改进。"),
    ]


def test_raw_sections_to_report_document(spark):
    """Re-typed excerpt of a recorded raw report (sections and conclusion) through the whole report path."""
    from tessera.operators.report import report_document
    from tessera.operators.sections import (cause_rows, main_problem, section_fields, section_outline,
                                            section_rows, suggestion_steps)

    raw = [
        {"培训组织概况": {"培训时间": "2025年5月10日至5月25日", "培训主题": "手卫生执行力与依从性", "授课专家": ""}},
        {"培训内容": {"核心模块1": "WHO 推荐的“手卫生五个时刻”标准动作讲解", "核心模块2": "洗手流程规范、常见误区与推荐消毒剂分类"}},
        {"培训参与情况和分析": {"整体参训率": "92.2%",
                        "存在问题": {"总结": "部分科室参训不足", "具体问题": ["1、外科、康复医学科因轮班冲突或任务调度问题，部分人员未完成学习任务"]},
                        "原因分析": {"排班与调度问题": ["1、外科和康复医学科的轮班制度导致部分人员无法参加培训"],
                                 "培训形式适应性": ["1、部分医护人员可能对线上学习形式不够熟悉，影响学习效果"]}}},
        {"考核内容": {"考核类型": "理论考试+现场操作考核"}},
        {"考核结果": {"理论考试平均成绩": "82.5", "最终通过率": "89.7%"}},
        {"考核问题和分析": {"存在问题": {"总结": "操作考核问题较多", "具体问题": []},
                     "原因分析": {"考核标准执行严格": ["1、考核标准可能较为严格，导致部分医护人员未能通过"]}, "整改措施": ""}},
    ]
    conclusion = ["1、针对外科和康复医学科等参训率较低的科室，优化培训时间安排或提供补训机会。",
                  "2、加强操作考核中的薄弱环节培训，如水量控制和指缝覆盖等细节问题。",
                  "3、定期开展手卫生复查和反馈机制，确保培训效果持续改进。"]
    docs = spark.createDataFrame([("pdf", json.dumps(raw, ensure_ascii=False))], "report string, text string")
    secs = section_rows(docs, "report", "text")
    fields = section_fields(secs)
    analysis = cause_rows(secs.where("section in ('培训参与情况和分析', '考核问题和分析')")).join(
        main_problem(secs.where("section in ('培训参与情况和分析', '考核问题和分析')")), "report")
    outline = section_outline(secs.where("section = '培训内容'")).select("report", "pos", "level", "text")
    items = spark.createDataFrame([("pdf", i, t) for i, t in enumerate(conclusion)], "r string, p int, t string")
    steps = suggestion_steps(items, "r", "p", "t")
    text = "Sheet: Sheet1\n" + ",".join(HEADER) + "\n" + "\n".join(",".join(r) for r in DEPARTMENTS[:3]) + "\n"
    rows = parse_tables(spark.createDataFrame([("pdf", text)], "report string, content string"))
    wide = rows.select("row_no", *[F.col("row")[h].alias(h) for h in HEADER])
    series = unpivot_series(wide, "科室名称", "row_no").withColumn("report", F.lit("pdf"))
    summary = spark.createDataFrame([("pdf", "总结文字")], "report string, content string")
    doc = json.loads(report_document(
        fields, analysis, steps, {"orgOverview": "培训组织概况"}, summary=summary,
        metrics={"assessmentChart": "考核结果"}, outline=outline, series=series).first().document)
    assert doc["orgOverview"]["fields"] == [{"label": "培训时间", "value": "2025年5月10日至5月25日"},
                                            {"label": "培训主题", "value": "手卫生执行力与依从性"},
                                            {"label": "授课专家", "value": ""}]
    assert [x["item"]["contents"][0]["text"] for x in doc["trainingContent"]] == [
        "培训内容包含以下四大核心模块：", "• WHO 推荐的“手卫生五个时刻”标准动作讲解；", "• 洗手流程规范、常见误区与推荐消毒剂分类；"]
    assert doc["assessmentAnalysis"]["mainProblem"] == "部分科室参训不足；操作考核问题较多"
    assert [c["category"] for c in doc["assessmentAnalysis"]["causes"]] == ["排班与调度问题", "培训形式适应性", "考核标准执行严格"]
    assert doc["assessmentChart"]["metrics"][1] == {"label": "最终通过率", "value": "89.7%"}
    assert doc["col_4"]["unit"] == "%" and [p["value"] for p in doc["col_4"]["data"]] == [100.0, 100.0, 100.0]
    assert [s["id"] for s in doc["conclusionSummary"]["rectificationFlow"]["steps"]] == ["rec_1", "rec_2", "rec_3"]
    assert doc["conclusionSummary"]["rectificationFlow"]["steps"][0]["value"].startswith("针对外科")
