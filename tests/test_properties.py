"""Property checks: Column functions equal their Python definitions on random text (hypothesis)."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.functions import text as T

ALPHABET = st.sampled_from(list("ab 中文。！？；：)”》）]）\n\r\t\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0 　,\"") + ["_x000D_"])
TEXTS = st.lists(ALPHABET, max_size=30).map("".join)


def _run(spark, col, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r["r"] for r in df.select(col.alias("r")).collect()]


@settings(max_examples=5, deadline=None)
@given(st.lists(TEXTS, min_size=20, max_size=40))
def test_strip_cr_repair_properties(spark, values):
    assert _run(spark, T.py_strip("x"), values) == [v.strip() for v in values]
    cr = [v.replace("\r\n", "\n").replace("\r", "\n").replace("_x000D_", "\n") for v in values]
    assert _run(spark, T.cr_normalize("x"), values) == cr
    pattern = r'(?<![。！？；：)”》）\]）])\n(?!\n)'
    assert _run(spark, T.repair_line_breaks("x"), values) == [re.sub(pattern, "", v) for v in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(TEXTS, min_size=20, max_size=40))
def test_lines_properties(spark, values):
    stripped = [v.strip() for v in values]
    got = _run(spark, T.split_lines(T.py_strip("x")), values)
    assert [g if s else [] for g, s in zip(got, stripped)] == [s.splitlines() for s in stripped]
    assert _run(spark, T.first_line("x"), values) == [v.split("\n")[0] for v in values]
    assert _run(spark, T.rest_lines("x"), values) == ["\n".join(v.split("\n")[1:]) for v in values]


WORDS = st.lists(st.sampled_from(["alpha", "Beta", "x1", "中文字", "é", "--", " ", "\n", "123", "手"]), max_size=12)


@settings(max_examples=5, deadline=None)
@given(st.lists(WORDS.map("".join), min_size=10, max_size=30))
def test_token_rule(spark, values):
    def py_tokens(s):
        out = []
        for t in re.findall(r"[^\W_]+", s):
            for run in re.findall(r"[一-鿿]+|[^一-鿿]+", t):
                if re.match(r"[一-鿿]", run) and len(run) > 1:
                    out += [run[i:i + 2] for i in range(len(run) - 1)]
                else:
                    out.append(run)
        return out

    assert _run(spark, T.tokens("x"), values) == [py_tokens(v) for v in values]


CELL = st.text(alphabet=st.sampled_from(list("ab1 é中")), max_size=4)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(CELL, min_size=3, max_size=3), min_size=1, max_size=8))
def test_serialize_then_parse_round_trip(spark, rows):
    from pyspark.sql import functions as F

    from tessera.operators.tables import parse_tables, serialize_tables

    data = [(1, i, "k", *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "t int, i int, key string, a string, b string, c string")
    text = serialize_tables(df.withColumn("key", F.concat(F.lit("row"), F.col("i").cast("string"))),
                            ["t"], ["i"], ["key", "a", "b", "c"])
    parsed = parse_tables(text, key_col="key").select("row_no", F.map_entries("row").alias("e")).collect()
    got = {r.row_no: [(e.key, e.value) for e in r.e] for r in parsed}
    # the parser strips values (Python str.strip) and starts data after the header line
    exp = {i: [("key", f"row{i}"), ("a", r[0].strip()), ("b", r[1].strip()), ("c", r[2].strip())]
           for i, r in enumerate(rows)}
    assert got == exp


ITEMS = st.lists(st.sampled_from(["1、a", "2、b", "3.c", "x", "y", "10、z", "2、q", " 4.d ", "5、e\nf"]), max_size=6)


def fold_model(items):
    """The documented rule: numbered items set their number, others set (number of keys so far) + 1."""
    m = {}
    for it in items:
        s = it.strip()
        hit = re.match(r"^(\d+)[、.](.+)", s)
        if hit:
            m[int(hit.group(1))] = hit.group(2).strip()
        else:
            m[len(m) + 1] = s
    return sorted(m.items())


@settings(max_examples=5, deadline=None)
@given(st.lists(ITEMS, min_size=5, max_size=15))
def test_suggestion_fold_property(spark, lists):
    from tessera.operators.sections import suggestion_steps

    rows = [(i, j, t) for i, items in enumerate(lists) for j, t in enumerate(items)]
    if not rows:
        return
    df = spark.createDataFrame(rows, "r int, p int, t string")
    got = {}
    for r in suggestion_steps(df, "r", "p", "t").collect():
        got.setdefault(r.report, []).append((r.step_no, r.value))
    exp = {i: fold_model(items) for i, items in enumerate(lists) if items}
    assert {k: sorted(v) for k, v in got.items()} == exp
