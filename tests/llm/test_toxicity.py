"""The toxicity classifier: features, ratios, held-out results and the defined edge cases."""

import numpy as np
import pytest

from tessera.llm import toxicity


def test_features_are_the_sets_of_n_grams(monkeypatch):
    text = "  Ab\tcde  fgh é " * 30
    padded = f" {' '.join(text.lower().split())} "
    grams = {padded[i:i + n] for n in toxicity.ORDERS for i in range(len(padded) - n + 1)}
    whole = toxicity.feature_set(text)
    assert len(whole) == len(grams)       # no two of these share a feature
    monkeypatch.setattr(toxicity, "BLOCK", 16)
    assert np.array_equal(toxicity.feature_set(text), whole)
    assert len(toxicity.feature_set("")) == len(toxicity.feature_set(None)) == len(toxicity.feature_set(" \n ")) == 0


def test_ratios_are_those_of_naive_bayes():
    sets = [np.array(x, np.uint32) for x in ([1, 2], [1], [1, 3], [3])]
    ratio, docs = toxicity.log_count_ratios(sets, [1, 1, 0, 0])
    assert list(docs[1:4]) == [3, 1, 2]
    assert ratio[1] == pytest.approx(np.log((3 / 4) / (2 / 4)))
    assert ratio[3] == pytest.approx(np.log((1 / 4) / (3 / 4)))


def texts(rng, n, marked):
    words = [f"{a}{b}" for a in ("lor", "ips", "dol", "sit") for b in ("em", "um", "or", "amet", "ing")]
    out = []
    for i in range(n):
        t = [words[k] for k in rng.integers(0, len(words), rng.integers(5, 400))]
        if marked:
            t[rng.integers(0, len(t))] = ("vexidu", "vexira", "vexion")[i % 3]
        out.append(" ".join(t))
    return out


def test_learns_a_stem_and_the_edge_cases(spark):
    rng = np.random.default_rng(1)
    marked, clean = texts(rng, 60, True), texts(rng, 200, False)
    rows = [(i, t, "x") for i, t in enumerate(marked + clean)]
    docs = spark.createDataFrame([*rows, (900, None, "x"), (901, "", "x"), (None, "lorem", "x"), (0, rows[0][1], "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(260)] + [(5, 0), (None, 1), (7000, 1), (901, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs.where("doc_id % 2 = 0"), labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    wrong = [i for i in range(1, 260, 2) if got[i].predicted != int(i < 60)]
    assert len(wrong) <= 3 and toxicity.score(docs, model).count() == docs.count()
    assert got[900].score == got[901].score < 0.5
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    long = "lorem ipsum " * 300_000 + "vexidu" + " dolor sit" * 1000
    assert toxicity.score(spark.createDataFrame([(1, long)], "doc_id long, text string"), model).first().predicted == 1


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert [r.predicted for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()] == [0, 0]
    assert [r.predicted for r in toxicity.score(docs, toxicity.fit(docs, one)).collect()] == [1, 1]
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), none)).count() == 0


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held_out", toxicity.held_out())
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.fit(docs.where("not held_out"), labels.where(~toxicity.held_out()))
    rows = toxicity.score(docs, model, carry=("doc_id", "held_out")).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows)
    assert len(rows) > 60 and right >= 0.93 * len(rows)
