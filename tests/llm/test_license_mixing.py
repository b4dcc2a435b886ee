import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from oracle_compare import compare, duck
from rivulet.llm import license_scan as L
from rivulet.llm import mixing as M

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, kept string, tokens string"


@pytest.mark.parametrize("query,sql", [(L.op4_license_scan, L.SQL), (M.op7_mixing, M.SQL)])
def test_query_matches_sql(spark, query, sql):
    r = compare(query(spark, SF_SMALL), duck(SF_SMALL), sql)
    assert r["hash_match"], r


@pytest.mark.parametrize("text,license,lines", [
    (L._MIT, "MIT", ""), ("Copyright (c) 2020 A. Person\n\n" + L._MIT.upper().replace(",", " ,"), "MIT", ""),
    ("MIT LICENCE\n(c) Someone, 1999\n" + L._MIT.replace("sublicense", "sub-license"), "MIT", ""),
    (L._MIT + " extra", None, ""), ("Intro.\n  released UNDER the  mit licence!\nmore", None, "MIT"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0", "CC-BY-NC-4.0"),
    ("SPDX-License-Identifier: MIT\nx\nReleased under the MIT License.", None, "MIT"),
    (None, None, ""), ("", None, ""), ("...\n!!", None, ""), ("Copyright 1999", None, ""),
    ("x" * 500_000 + "\nReleased under the MIT License.", None, "MIT"),
])
def test_scan(spark, text, license, lines):
    df = spark.createDataFrame([(1, text, "d", "l"), (1, text, "d", "l")],
                               "doc_id long, text string, digest string, license string")
    got = L.scan_licenses(df).collect()
    assert [(r.doc_id, r.license, r.line_licenses) for r in got] == [(1, license, lines)] * 2


def test_scan_of_nothing(spark):
    assert L.scan_licenses(spark.createDataFrame([], DOCS)).collect() == []


def test_scan_and_mix_run_without_python_workers(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for df in (L.scan_licenses(docs), M.mix(docs, "doc_id", M.n_words(F.col("text")), M.document_dimensions())):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_weights_meet_all_targets(spark):
    cells = spark.createDataFrame([(s, l, t, 10 + 7 * i) for i, (s, l, t) in enumerate(
        (s, l, t) for s in ("a", "b", None) for l in ("x", "y") for t in ("p", "q"))],
        "source string, lang string, topic string, tokens long")
    want = {"source": {"a": 2.0, "b": 1.0, None: 1.0}, "lang": {"x": 3.0, "y": 1.0}, "topic": {"p": 1.0, "q": 1.0}}
    rows = M.rake(cells, {n: spark.createDataFrame(list(v.items()), "value string, target double")
                          for n, v in want.items()}).collect()
    total = sum(r.tokens for r in rows)
    for name, shares in want.items():
        for value, share in shares.items():
            have = sum(r.weight for r in rows if r[name] == value)
            assert have == pytest.approx(total * share / sum(shares.values()), rel=1e-6)


def test_targets_may_leave_values_out(spark):
    docs = spark.createDataFrame([(i, "w w", "en", "ab"[i % 2], 3, "", "", "") for i in range(40)], DOCS)
    only = {"source": spark.createDataFrame([("a", 1.0), ("zz", 1.0)], "value string, target double")}
    got = M.mix(docs, "doc_id", M.n_words(F.col("text")), {n: F.col(n) for n in ("source", "lang")}, targets=only)
    assert {(r.source, r.probability) for r in got.collect()} == {("a", 1.0), ("b", 0.0)}


def test_nulls_repeats_empty_and_expected_tokens(spark):
    rows = [(i, " ".join(["w"] * (i % 9)), [None, "en", "de"][i % 3], ["s", "s", "s", "t", None][i % 5], 0, "", "", "")
            for i in range(3000)] + [(None, None, None, None, None, "", "", ""), (5, "", "en", "t", 0, "", "", ""),
                                     (5, "", "en", "t", 0, "", "", "")]
    docs = spark.createDataFrame(rows, DOCS)
    got = M.mix(docs, "doc_id", M.n_words(F.col("text")), M.document_dimensions()).collect()
    assert len(got) == len(rows) and max(r.probability for r in got) == pytest.approx(1.0)
    assert len({r.kept for r in got if r.doc_id == 5 and r.tokens == 0}) == 1
    expected, kept = (sum(r.tokens * w for r, w in zip(got, ws)) for ws in ([r.probability for r in got],
                                                                          [float(r.kept) for r in got]))
    assert kept == pytest.approx(expected, rel=0.08)
    stage = M.mixing_stage(spark, docs, "")
    assert stage.columns == docs.columns
    assert sorted(str(r.doc_id) for r in stage.collect()) == sorted(str(r.doc_id) for r in got if r.kept)
    assert M.mixing_stage(spark, docs.limit(0), "").collect() == []
    blank = docs.where("text = ''")
    assert M.mixing_stage(spark, blank, "").collect() == []


def test_rounds_go_on_until_the_targets_are_met(spark, caplog):
    cells = spark.createDataFrame([(f"s{i}", f"l{j}", "t", (10_000 if i % 4 == j else 1) * (50 if i == 0 else 1))
                                   for i in range(6) for j in range(4)],
                                  "source string, lang string, topic string, tokens long")
    rows = M.rake(cells, {n: M.targets_of(cells, n, 0.0) for n in M.DIMENSIONS}).collect()
    total = sum(r.tokens for r in rows)
    for name, n in (("source", 6), ("lang", 4)):
        sums = {}
        for r in rows:
            sums[r[name]] = sums.get(r[name], 0.0) + r.weight
        assert len(sums) == n and all(v == pytest.approx(total / n, rel=M.TOLERANCE) for v in sums.values())
    assert "not met" not in caplog.text


def test_targets_that_cannot_be_met_are_named(spark, caplog):
    cells = spark.createDataFrame([("a", "x", "t", 10), ("b", "x", "t", 10), ("b", "y", "t", 10)],
                                  "source string, lang string, topic string, tokens long")
    want = {"source": {"a": 0.6, "b": 0.4}, "lang": {"x": 0.5, "y": 0.5}, "topic": {"t": 1.0}}
    M.rake(cells, {n: spark.createDataFrame(list(v.items()), "value string, target double") for n, v in want.items()})
    assert "source a" in caplog.text


@pytest.mark.parametrize("odd", [("one", "en"), (None, "en"), (None, None)])
def test_one_odd_document_does_not_set_the_scale(spark, caplog, odd):
    rows = [(i, "w " * 20, ("en", "en", "de")[i % 3], "s" if i % 2 else f"s{i % 8}", 0, "", "", "") for i in range(600)]
    docs = spark.createDataFrame([*rows, (1000, "w", odd[1], odd[0], 0, "", "", "")], DOCS)
    dimensions = {n: F.col(n) for n in ("source", "lang")}
    got = M.mix(docs, "doc_id", M.n_words(F.col("text")), dimensions).collect()
    total = sum(r.tokens for r in got)
    assert sum(r.tokens * r.probability for r in got) == pytest.approx(M.BUDGET * total, rel=1e-6)
    assert max(r.probability for r in got) == 1 and [r.probability for r in got if r.doc_id == 1000] == [1]
    sums = {}
    for r in got:
        if r.doc_id != 1000:
            sums[r.source] = sums.get(r.source, 0.0) + r.tokens * r.probability
    assert sums["s"] / sums["s0"] == pytest.approx((300 / 75) ** 0.5, rel=0.03)
    assert f"source {odd[0]}" in caplog.text
    assert sum(r.kept for r in got) > 0.2 * len(got)
