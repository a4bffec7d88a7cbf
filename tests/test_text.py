"""Column functions against the Python behaviour they reproduce."""

import hashlib

from pyspark.sql import functions as F

from tessera.functions import text as T


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_strip_matches_python_on_unicode_space(spark):
    cases = ["  a b  ", "　中文　", "\x1c\x1dx\x1e\x1f", "\xa0 y \x85", "\t\n z \r\x0b\x0c", "", "​"]
    df = spark.createDataFrame([(c,) for c in cases], "x string")
    got = [r["r"] for r in df.select(T.py_strip("x").alias("r")).collect()]
    assert got == [c.strip() for c in cases]


def test_cr_normalize_order(spark):
    assert one(spark, T.cr_normalize("x"), "a\r\nb\rc_x000D_d") == "a\nb\nc\nd"


def test_line_break_repair(spark):
    import re

    pattern = r'(?<![。！？；：)”》）\]）])\n(?!\n)'
    cases = ["第一行\n第二行", "结束。\n下一段", "段落\n\n新段落", "a\n\n\nb", "\nlead", "tail\n", "问）\n答"]
    df = spark.createDataFrame([(c,) for c in cases], "x string")
    got = [r["r"] for r in df.select(T.repair_line_breaks("x").alias("r")).collect()]
    assert got == [re.sub(pattern, "", c) for c in cases]


def test_split_lines_like_splitlines(spark):
    cases = ["a\nb", "a\r\nb\rc", "a\x0bb\x0cc", "a b\x85c", "one", "a\x1cb\x1dc\x1ed"]
    df = spark.createDataFrame([(c,) for c in cases], "x string")
    got = [r["r"] for r in df.select(T.split_lines("x").alias("r")).collect()]
    assert got == [c.splitlines() for c in cases]


def test_first_and_rest_lines(spark):
    df = spark.createDataFrame([("t\nb1\nb2",), ("only",)], "x string")
    rows = df.select(T.first_line("x").alias("f"), T.rest_lines("x").alias("r")).collect()
    assert [(r.f, r.r) for r in rows] == [("t", "b1\nb2"), ("only", "")]


def test_tokens_letters_digits_and_han_bigrams(spark):
    got = one(spark, T.tokens("x"), "Report 2025: 手卫生培训, x-ray 中")
    assert got == ["Report", "2025", "手卫", "卫生", "生培", "培训", "x", "ray", "中"]
    assert one(spark, T.tokens("x", lower=True), "ABC déf") == ["abc", "déf"]


def test_overlap_ratio_and_empty_query(spark):
    df = spark.createDataFrame([(["a", "b", "b", "c"], ["b", "c", "d"]), ([], ["x"])], "q array<string>, d array<string>")
    got = [r["r"] for r in df.select(T.overlap_ratio("q", "d").alias("r")).collect()]
    assert got == [2 / 3, 0.0]


def test_md5_suffix_is_stable(spark):
    v = "某个原因"
    expected = str(int(hashlib.md5(v.encode()).hexdigest()[:8], 16) % 10000)
    assert one(spark, T.md5_suffix("x"), v) == expected


def test_percent_and_number_text(spark):
    df = spark.createDataFrame([(0.0425, 17.0), (1.0, 3.5), (-0.0, 100.0)], "p double, n double")
    rows = df.select(T.percent_text("p").alias("p"), T.number_text("n").alias("n")).collect()
    assert [(r.p, r.n) for r in rows] == [(f"{0.0425:.2%}", "17.0"), (f"{1.0:.2%}", "3.5"), (f"{-0.0:.2%}", "100.0")]


def test_parse_value_ladder(spark):
    cases = ["92.2%", "45", "3.5", "abc", "", "12%x"]
    df = spark.createDataFrame([(c,) for c in cases], "x string")
    got = [r["r"] for r in df.select(T.parse_value("x").alias("r")).collect()]
    assert got == [92.2, 45.0, 3.5, None, None, None]


def test_label_width_rules(spark):
    # wide*w1 + upper*8 + rest*w3 + pad, per level
    s = "Ab中文"
    wide, upper, rest = 2, 1, 1
    df = spark.createDataFrame([(s,)], "x string")
    r = df.select(T.label_width("x", 1).alias("a"), T.label_width("x", 2).alias("b"),
                  T.label_width("x", 3).alias("c")).first()
    assert (r.a, r.b, r.c) == (wide * 16 + upper * 8 + rest * 10 + 40, wide * 13 + upper * 8 + rest * 5 + 50,
                               wide * 12 + upper * 8 + rest * 5 + 30)
    # an astral character counts as two UTF-16 units, both wide
    assert one(spark, T.wide_count("x"), "😀a") == 2


def test_dot_and_normalize(spark):
    df = spark.createDataFrame([([3.0, 4.0], [1.0, 2.0])], "a array<double>, b array<double>")
    r = df.select(T.dot("a", "b").alias("d"), T.unit_normalize("a").alias("u")).first()
    assert r.d == 11.0 and r.u == [0.6, 0.8]


def test_number_text_is_the_plain_repr(spark):
    from tessera.functions.text import number_text

    values = [1.23456789e7, 1e-4, 0.00012345678901234567, 1e15, 1e16, -2.5e-7, 123.0, 0.5, -1e22, 98765432109876.5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r.t for r in df.select(number_text("v").alias("t")).collect()] == [str(v) for v in values]
    assert spark.range(1).select(number_text("id").alias("t")).first().t == "0"
