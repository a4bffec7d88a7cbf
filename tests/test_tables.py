"""Table operators: CSV text, parsing rules, wide-to-long on a re-typed department table."""

from pyspark.sql import functions as F

from tessera.operators.tables import (chart_series, csv_header, fill_nulls, parse_tables, parse_tables_long,
                                      rows_long, serialize_tables, series_share, unpivot_series)


def test_serialize_quoting_nulls_and_sheet(spark):
    rows = spark.createDataFrame([(1, 1, "a,b", None), (1, 2, 'say "hi"', "x"), (2, 1, "z", " ")],
                                 "t int, r int, c1 string, c2 string")
    out = {r.t: r.content for r in serialize_tables(rows, ["t"], ["r"], ["c1", "c2"], null_mode="blank",
                                                    sheet=F.lit("S")).collect()}
    assert out[1] == 'Sheet: S\nc1,c2\n"a,b",空值\n"say ""hi""",x\n'
    assert out[2] == "Sheet: S\nc1,c2\nz,空值\n"
    assert csv_header(["a", "b,c"]) == 'a,"b,c"'


def test_fill_null_variants(spark):
    df = spark.createDataFrame([(None,), ("  ",), ("v",)], "c string")
    got = df.select(fill_nulls(F.col("c"), "null").alias("a"), fill_nulls(F.col("c"), "blank").alias("b"),
                    fill_nulls(F.col("c"), "none").alias("n")).collect()
    assert [(r.a, r.b, r.n) for r in got] == [("空值", "空值", None), ("  ", "空值", "  "), ("v", "v", "v")]


def test_parse_tables_rules(spark):
    text = ("Sheet: 第一页\n说明行\n科室名称,人数,率\nICU, 45 ,100%\n\n合计,45,100%\nbad,1\n"
            "Sheet: 第二页\n科室名称,人数,率\n儿科,33,93.9%\n")
    tables = spark.createDataFrame([(1, "/x/统计.xlsx", text), (2, "/x/none.xlsx", "a,b\n1,2\n")],
                                   "id int, name string, content string")
    parsed = parse_tables(tables, name_col="name")
    rows = [(r.id, r.title, r.sheet, r.row_no, dict(r.row)) for r in parsed.orderBy("row_no").collect()]
    assert rows == [
        (1, "统计", "第一页", 0, {"科室名称": "ICU", "人数": "45", "率": "100%"}),
        # the second sheet's header has the same arity, so it stays as a data row (sheets merge)
        (1, "统计", "第一页", 1, {"科室名称": "科室名称", "人数": "人数", "率": "率"}),
        (1, "统计", "第一页", 2, {"科室名称": "儿科", "人数": "33", "率": "93.9%"}),
    ]
    long = rows_long(parsed, ["id"]).where("row_no = 0").orderBy("col_no").collect()
    assert [(r.col_no, r.field) for r in long] == [(1, "科室名称"), (2, "人数"), (3, "率")]
    cells = parse_tables_long(tables, name_col="name")
    assert sorted((r.row_no, r.col_no, r.field, r.value) for r in cells.collect()) == sorted(
        (r.row_no, r.col_no, r.field, r.value) for r in rows_long(parsed, ["id"]).collect())


def test_duplicate_header_last_value_wins(spark):
    tables = spark.createDataFrame([(1, "k,a,a\nx, 1 , 2 \n")], "id int, content string")
    row = parse_tables(tables, key_col="k").select(F.map_entries("row").alias("e")).first().e
    assert [(e.key, e.value) for e in row] == [("k", "x"), ("a", "2")]
    cells = [(r.col_no, r.field, r.value) for r in parse_tables_long(tables, key_col="k").orderBy("col_no").collect()]
    assert cells == [(1, "k", "x"), (2, "a", "2")]


# Re-typed excerpt of a recorded department table (3 departments and the total row).
DEPT = [
    ("ICU", 1, "45", "45", "0", "100.00%"),
    ("外科一病区", 2, "37", "34", "3", "91.90%"),
    ("儿科", 3, "33", "31", "2", "93.90%"),
    ("合计", 4, "115", "110", "5", "95.7%"),
]
DEPT_SCHEMA = "`科室名称` string, ord int, `应参训人数` string, `实参训人数` string, `缺勤人数` string, `参训率` string"


def test_unpivot_series_units_values_total(spark):
    wide = spark.createDataFrame(DEPT, DEPT_SCHEMA)
    long = unpivot_series(wide, "科室名称", "ord")
    got = {}
    for r in long.collect():
        got.setdefault((r.col_no, r.field, r.unit), []).append((r.pos, r.name, r.value))
    assert sorted(got) == [(1, "应参训人数", "人"), (2, "实参训人数", "人"), (3, "缺勤人数", "人"), (4, "参训率", "%")]
    assert sorted(got[(4, "参训率", "%")]) == [(1, "ICU", 100.0), (2, "外科一病区", 91.9), (3, "儿科", 93.9)]
    assert all(name != "合计" for pts in got.values() for _, name, _ in pts)


def test_series_arrays_in_row_order(spark):
    from tessera.operators.tables import series_arrays

    long = unpivot_series(spark.createDataFrame(DEPT, DEPT_SCHEMA), "科室名称", "ord")
    s = {r.col_no: r for r in series_arrays(long).collect()}
    assert [p.name for p in s[1].data] == ["ICU", "外科一病区", "儿科"] and s[4].unit == "%"


def test_unit_uses_total_row(spark):
    rows = [("a", 1, "1"), ("合计", 2, "50%")]
    long = unpivot_series(spark.createDataFrame(rows, "k string, o int, v string"), "k", "o")
    assert {r.unit for r in long.collect()} == {"%"}


def test_unpivot_pivot_round_trip(spark):
    wide = spark.createDataFrame(DEPT, DEPT_SCHEMA).where("`科室名称` <> '合计'")
    long = unpivot_series(wide, "科室名称", "ord")
    back = long.groupBy("name").pivot("field").agg(F.first("value_raw"))
    orig = {r["科室名称"]: (r["应参训人数"], r["参训率"]) for r in wide.collect()}
    assert {r["name"]: (r["应参训人数"], r["参训率"]) for r in back.collect()} == orig


def test_chart_series_and_share(spark):
    long = unpivot_series(spark.createDataFrame(DEPT, DEPT_SCHEMA), "科室名称", "ord")
    chart = sorted((r.pos, r.name, r.value_2, r.value_3) for r in chart_series(long).collect())
    assert chart == [(1, "ICU", 45.0, 0.0), (2, "外科一病区", 34.0, 3.0), (3, "儿科", 31.0, 2.0)]
    share = {(r.col_no, r.pos): r.share for r in series_share(long).collect()}
    assert share[(3, 2)] == round(3 / 5, 6)
    assert chart_series(long, y_cols=(2, 9)).count() == 0


def test_quoted_mode_round_trips_commas(spark):
    rows = spark.createDataFrame([(1, 1, "a,b", 'say "hi"'), (1, 2, "plain", "x")], "t int, r int, c1 string, c2 string")
    text = serialize_tables(rows.withColumn("k", F.concat(F.lit("r"), F.col("r").cast("string"))),
                            ["t"], ["r"], ["k", "c1", "c2"])
    strict = parse_tables(text, key_col="k", quoted=True).orderBy("row_no").select(F.map_entries("row").alias("e"))
    got = [[(e.key, e.value) for e in r.e] for r in strict.collect()]
    assert got == [[("k", "r1"), ("c1", "a,b"), ("c2", 'say "hi"')], [("k", "r2"), ("c1", "plain"), ("c2", "x")]]
    # the default (naive comma split) drops the first line: its field count differs from the header's
    assert parse_tables(text, key_col="k").count() == 1
    cells = parse_tables_long(text, key_col="k", quoted=True).where("row_no = 0").orderBy("col_no").collect()
    assert [c.value for c in cells] == ["r1", "a,b", 'say "hi"']
