"""Growing indexes, normal paths, and routing of names in a table."""

import posixpath

import pytest
from pyspark.errors import PySparkException

from tessera.functions.text import base_name, normal_path
from tessera.session import scratch_path
from tessera.sources.files import route_names
from tessera.sources.index import append_index, index_versions, read_version


def rows(spark, texts, dim=2):
    return spark.createDataFrame([(t, [float(i)] * dim) for i, t in enumerate(texts)], "text string, embedding array<double>").repartition(3)


def test_three_appends_have_dense_ids_and_old_versions_stay(spark):
    path = scratch_path(spark, "growing")
    with pytest.raises(FileNotFoundError):
        read_version(spark, path)
    parts = [["b", "a", "c"], [], ["e", "d", "d"]]
    assert [append_index(rows(spark, p), path, ["text"]) for p in parts] == [1, 2, 3]
    got = read_version(spark, path).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text, r.version) for r in got] == [(0, "a", 1), (1, "b", 1), (2, "c", 1), (3, "d", 3), (4, "d", 3), (5, "e", 3)]
    assert read_version(spark, path, 2).count() == 3
    assert [(r.version, r.first_id, r["items"], r.dim) for r in index_versions(spark, path).orderBy("version").collect()] == [(1, 0, 3, 2), (2, 3, 0, 2), (3, 3, 3, 2)]
    with pytest.raises(FileNotFoundError):
        read_version(spark, path, 4)


def test_bad_appends_add_nothing(spark):
    path = scratch_path(spark, "growing")
    append_index(rows(spark, ["a"]), path, ["text"])
    for bad in (rows(spark, ["x"], 3), rows(spark, ["x"]).unionAll(spark.createDataFrame([("n", None)], "text string, embedding array<double>"))):
        with pytest.raises(ValueError):
            append_index(bad, path, ["text"])
    assert read_version(spark, path).count() == 1 and index_versions(spark, path).count() == 1
    spark.createDataFrame([(9, "half", [0.0, 0.0])], "doc_id long, text string, embedding array<double>").write.parquet(f"{path}/rows/version=2")
    assert read_version(spark, path).count() == 1           # an append that never ended is not seen
    assert append_index(rows(spark, ["b"]), path, ["text"]) == 2 and read_version(spark, path).count() == 2


def test_normal_paths(spark):
    paths = ["/a/b", "/a//b/./c", "/a/../../b", "a/../b/", ".", "", "/", "../../x", "/..", "a/b/../../..//c.txt", "/a/.../b", "/é/ /x"]
    got = spark.createDataFrame([(i, p) for i, p in enumerate([*paths, None])], "i int, p string").select("i", normal_path("p", "/home/in").alias("n"), base_name("p").alias("b")).orderBy("i").collect()
    assert [r.n for r in got] == [posixpath.normpath(posixpath.join("/home/in", p)) for p in paths] + [None]
    assert [r.b for r in got] == [posixpath.basename(p) for p in paths] + [None]


def test_routing_counts_in_the_same_pass(spark):
    names = spark.createDataFrame([(i, n) for i, n in enumerate(["a.PDF", "/x/../b.doc", "c.txt", "noext", None, "d.csv"])], "path int, name string")
    routed, seen = route_names(names, "name")
    got = {r.path: (r.filetype, r.reader, r.supported) for r in routed.collect()}
    assert got["/a.PDF"] == (".pdf", ".pdf", True) and got["/b.doc"] == (".doc", ".docx", True) and got[None] == ("", "", False)
    assert seen.get == {"kept": 3, "rejected": 3}
    with pytest.raises(PySparkException, match="Unsupported file type"):
        route_names(names, "name", strict=True)[0].collect()
