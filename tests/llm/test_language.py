import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from rivulet.llm import language as L
from rivulet.llm.shingles import mixed

ODD = [int(k) for k in mixed(np.arange(1, 9, dtype=np.uint64)) | np.uint64(1)]
MASK = (1 << 64) - 1


def plain_counts(text):
    """Subword by subword."""
    out = np.zeros(L.BUCKETS, np.int64)
    words, word = [], ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            words, word = [*words, word], ""

    def put(total):
        out[(int(mixed(np.array([total & MASK], np.uint64))[0]) >> 32) % L.BUCKETS] += 1

    for w in words:
        points = [0, *map(ord, w), 0]
        for n in L.GRAMS:
            for i in range(len(points) - n + 1):
                put(n + sum(p * ODD[j] for j, p in enumerate(points[i:i + n])))
        put(sum(ord(c) * ODD[0] ** (j + 1) for j, c in enumerate(w)))
    return out


@pytest.mark.parametrize("text", ["", "1 2 3!", "a", "Ab cd", "straße l'été 12x3y", "Ein\nein 𐐀𐐨 ﬁ", "zz  zz"])
def test_subwords(text):
    assert L.bucket_counts(text).tolist() == plain_counts(text).tolist()


def test_pieces_of_a_long_text_add_up(monkeypatch):
    rng = np.random.default_rng(1)
    text = " ".join("".join(rng.choice(list("abcdé"), rng.integers(1, 9))) for _ in range(500))
    whole = L.bucket_counts(text)
    monkeypatch.setattr(L, "PIECE", 50)
    assert L.bucket_counts(text).tolist() == whole.tolist() == plain_counts(text).tolist()


def test_held_out_languages_are_found(spark):
    got = L.op11_language(spark, SF_CHECK)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score", "rejected"]
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "lang", "text")
    rows = got.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    tested = [r for r in rows if r.held_out]
    assert len(tested) > 200
    assert np.mean([r.lang == r.lang_pred for r in tested]) > 0.98
    kept = [r for r in tested if not r.rejected]
    assert len(kept) > 0.9 * len(tested) and np.mean([r.lang == r.lang_pred for r in kept]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_rows_teach_nothing(spark):
    """A language that only held-out rows have is never predicted, and their labels change no score."""
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").where("doc_id < 300").select("doc_id", "text", "lang")
    score = []
    for label in (F.col("lang"), F.lit("xx")):
        changed = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), label).otherwise(F.col("lang")))
        model = L.learn(changed.where(~L.held_out(F.col("doc_id"))).select(F.col("doc_id").alias("key"), "text", "lang"), 60)
        assert "xx" not in model.languages
        score.append([L.read(model, r.text) for r in docs.orderBy("doc_id").limit(40).collect()])
    assert score[0] == score[1]


def test_temperature_and_threshold():
    """Two languages that share a bucket: what only that bucket speaks for is uncertain, and rejected."""
    rows = []
    for label in (0, 1):
        rows += [(label, np.array([1 + label, 5]), np.array([3.0, 1.0]))] * 40 + [(label, np.array([5]), np.array([1.0]))] * 40
    model = L.train(rows, ["aa", "bb"], epochs=20)
    L.calibrate(model, rows)
    scores = model.scores(np.array([L.mean_vector(model, b, c) for _, b, c in rows]))
    sure = [s.max() >= model.threshold for s in scores]
    assert sure == ([True] * 40 + [False] * 40) * 2
    assert np.mean(scores.max(axis=1)) == pytest.approx(0.75, abs=0.05)  # three quarters of the guesses are right


def test_awkward_rows(spark):
    schema = "doc_id long, text string, lang string, read string, READ_ string"
    text = {"aa": "aba baba abab baab", "bb": "cdc dcdc cdcd dccd"}
    rows = [(i, f"{text[k]} {i}", k, "mine", "") for i in range(60) for k in text]
    rows += [(None, "abab", "aa", None, None), (7, None, "aa", "x", "y"), (8, "", None, "", ""), (9, "123 ...", "bb", "", ""),
             (10, "abab " * 40000, None, "", ""), (11, "abab", None, "", ""), (11, "abab", None, "", "")]
    df = spark.createDataFrame(rows, schema)
    model = L.learn(df.select(F.col("doc_id").alias("key"), "text", "lang"))
    assert model.languages == ["aa", "bb"]
    got = L.identify(df, "text", model)
    assert got.columns == [*df.columns, "read__"]
    back = got.collect()
    assert sorted(map(str, (tuple(r)[:5] for r in back))) == sorted(map(str, rows))
    for r in back:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert tuple(r.read__) == ("und", 0.0, True)
        else:
            assert r.read__.lang_pred == ("aa" if "a" in r.text else "bb")
    assert L.identify(df.where("false"), "text", model).count() == 0
    nothing = L.learn(df.where("lang is null").select(F.col("doc_id").alias("key"), "text", "lang"))
    assert nothing is None
    assert {tuple(r.read__) for r in L.identify(df, "text", nothing).collect()} == {("und", 0.0, True)}
