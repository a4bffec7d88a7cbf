"""CSV records with quoted commas, quotes and line breaks, against Python's csv module."""

import csv
import io
import random

import pytest

from tessera.operators.csvtext import csv_file_blocks, csv_maps, csv_rows
from tessera.session import checkpoint_dir


@pytest.fixture
def folder(spark, tmp_path):
    checkpoint_dir(spark)
    return tmp_path


def random_rows(seed, n):
    rng = random.Random(seed)
    part = ["a", ",", '"', "\n", "é", " ", "x y", "", "1.50", "\n\n"]
    return [["id", "te,xt", 'q"']] + [[str(i), "".join(rng.choices(part, k=rng.randrange(0, 6))), "".join(rng.choices(part, k=2))] for i in range(n)]


def written(path, rows, quoting=csv.QUOTE_MINIMAL, end="\n"):
    with open(path, "w", newline="") as f:
        csv.writer(f, quoting=quoting, lineterminator=end).writerows(rows)


def test_records_match_the_csv_module(spark, folder):
    written(folder / "a.csv", random_rows(1, 200))
    written(folder / "b.csv", random_rows(2, 50), csv.QUOTE_ALL, "\r\n")
    (folder / "head.csv").write_text("x,y\n")
    (folder / "empty.csv").write_text("")
    got = {}
    for r in csv_rows(spark, str(folder)).orderBy("filename", "record_no").collect():
        got.setdefault(r.filename.rsplit("/", 1)[1], []).append(r.cells)
    want = {n: [x for x in csv.reader(io.StringIO((folder / n).read_text(), newline="")) if x] for n in ("a.csv", "b.csv", "head.csv")}
    want = {n: rows for n, rows in want.items()}
    assert got == want


def test_splits_of_a_file_agree_with_one_split(spark, folder):
    rows = random_rows(3, 4000)
    written(folder / "big.csv", rows)
    old = [(k, spark.conf.get(k)) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")]
    try:
        spark.conf.set(old[0][0], "4096")
        spark.conf.set(old[1][0], "1")
        got = [r.cells for r in csv_rows(spark, str(folder)).orderBy("record_no").collect()]
    finally:
        for k, v in old:
            spark.conf.set(k, v)
    assert got == rows


def test_blocks_and_maps(spark, folder):
    (folder / "short.csv").write_text('a,b,c\n1,"x,\n""y"""\n\n2,,z,more\n')
    (folder / "head.csv").write_text("x,y\n")
    blocks = {r.filename.rsplit("/", 1)[1]: (r.order_index, r.content_type, r.content) for r in csv_file_blocks(spark, str(folder)).collect()}
    assert blocks == {"short.csv": (0, "table", 'a,b,c\n1,"x,\n""y""",\n2,,z,more\n'), "head.csv": (0, "table", "x,y\n")}
    maps = [r.cells for r in csv_maps(csv_rows(spark, str(folder))).orderBy("record_no").collect()]
    assert maps == [{"a": "1", "b": 'x,\n"y"', "c": ""}, {"a": "2", "b": "", "c": "z", "4": "more"}]


def test_long_quoted_cells_take_no_stack(spark, folder):
    rows = [["id", "text"], ["1", 'a, "b"\n' * 20_000], ["2", "x" * 100_000 + ","]]
    written(folder / "long.csv", rows)
    assert [r.cells for r in csv_rows(spark, str(folder)).orderBy("record_no").collect()] == rows


def test_cells_with_stray_quotes(spark):
    from pyspark.sql import functions as F

    from tessera.operators.csvtext import csv_cells

    texts = {'"a"",b': ["a", "b"], 'x"y,"c"z,': ['x"y', "c", ""], '"a""b""c': ['a"b'], '"",""""': ["", '"']}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.c for r in df.select("t", csv_cells(F.col("t")).alias("c")).collect()} == texts
