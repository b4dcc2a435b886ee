import random
import re
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from rivulet.llm import common
from rivulet.llm import shingles as H
from rivulet.llm import similarity_join as J
from rivulet.llm.common import cut
from rivulet.llm.components import connected_components

SCHEMA = "doc_id long, text string, n long, part string, component_id string"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def components(pairs, ids):
    to = {i: i for i in ids}

    def top(x):
        while to[x] != x:
            x = to[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        to[b] = a
    return {i: top(i) for i in ids}


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    pairs = []
    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                pairs.append((i, j))
    return sorted((i, len(s), components(pairs, [i for i, _ in rows])[i]) for i, s in sets)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, 1, "", "") for i, t in rows], SCHEMA)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(df).collect())


def corpus(seed, groups=12, size=9):
    """Groups of near copies around the threshold, a passage that many share, short texts and copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    line = " ".join(rng.choice(vocabulary) for _ in range(30))
    out = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 25, 90, 200]))]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 30))):
                at = rng.randrange(len(words))
                words[at:at + rng.randint(0, 2)] = [rng.choice(vocabulary)] * rng.randint(0, 2)
            text = " ".join(words)
            out.append(rng.choice([text, text, text.upper(), line + "\n" + text, text + "  "]))
    out += ["", None, "one", "One", "one two", "a b c d", "A  B\tC\nD", "a b c d e", line, line]
    rng.shuffle(out)
    return [(3 * i + 1, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = corpus(seed)
    want = brute([(i, t or "") for i, t in rows])
    assert run(spark, rows) == want
    assert len({c for _, _, c in want}) < len(rows) - 20


def test_every_round_is_needed_or_harmless(spark, monkeypatch):
    rows = corpus(3)
    want = brute([(i, t or "") for i, t in rows])
    for stars, most in ((0, 1), (0, 16), (1, 4)):
        monkeypatch.setattr(J, "STARS", stars)
        monkeypatch.setattr(J, "MOST", most)
        assert run(spark, rows) == want


def test_large_group_of_near_copies_and_hot_passage(spark):
    rng = random.Random(9)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, "same text of many copies again and again") for i in range(300)]
    for i in range(300, 500):
        words = list(base)
        words[rng.randrange(60)] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(i, "a very common line of many words that all texts hold " * 1 + " ".join(
        f"u{i}_{k}" for k in range(40))) for i in range(500, 700)]
    assert run(spark, rows) == brute(rows)


def edited_copies(seed, count):
    """Copies of one text of 150 words with 1 to 6 words replaced: many of them link with no other."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(150)]
    out = []
    for i in range(count):
        words = list(base)
        for k, at in enumerate(rng.sample(range(150), rng.randint(1, 6))):
            words[at] = f"x{i}_{k}"
        out.append((i, " ".join(words)))
    return out


def test_rows_matched_in_a_group_of_edited_copies_are_not_its_square(spark, monkeypatch):
    made, match = [], J.open_matches
    monkeypatch.setattr(J, "open_matches", lambda *a: made.append(match(*a).count()) or match(*a))
    for count in (200, 400):
        rows = edited_copies(6, count)
        want = brute(rows)
        assert run(spark, rows) == want
        assert len({c for _, _, c in want}) > count // 10
    assert len(made) == 2 and made[0] <= 5 * 200 and made[1] <= 5 * 400


def test_signs_of_earlier_shingles_never_rule_out_a_pair_that_links(spark, monkeypatch):
    monkeypatch.setattr(J, "EARLIER", 1)
    monkeypatch.setattr(J, "STARS", 0)
    rows = corpus(8) + [(1000 + i, t) for i, t in edited_copies(8, 60)]
    assert run(spark, rows) == brute(rows)


def test_whole_table_against_brute_force_on_an_inverted_index(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()]
    sets = {i: shingles(t) for i, t in rows}
    index, pairs = {}, []
    for i, s in sorted(sets.items()):
        common = {}
        for x in s:
            for j in index.setdefault(x, []):
                common[j] = common.get(j, 0) + 1
            index[x].append(i)
        pairs += [(i, j) for j, n in common.items() if 100 * n >= 80 * (len(s) + len(sets[j]) - n)]
    want = components(pairs, list(sets))
    got = J.op9_similarity_join(spark, SF_CHECK).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(
        (i, len(sets[i]), want[i]) for i in sets)


def test_null_ids_repeated_ids_empty_table(spark):
    text = "one two three four five six seven"
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]
    df = spark.createDataFrame([(5, text), (5, text), (9, text), (None, text), (None, "alone here"), (None, None)],
                               "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 3, 5), (5, 3, 5), (9, 3, 5), (None, 3, 5), (None, 1, None), (None, 0, None)], key=str)


def test_stage_keeps_one_of_each_group(spark):
    rows = corpus(4)
    want = brute([(i, t or "") for i, t in rows])
    df = spark.createDataFrame([(i, t, 1, "", "") for i, t in rows], SCHEMA)
    out = J.dedupe_stage(spark, df, "")
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [i for i, _, c in want if i == c]


def test_signs_never_rule_out_a_pair_that_links(spark):
    """Pairs just inside the threshold, on both sides of a step in the signs' length, stay; pairs without a common
    shingle go."""
    rng = np.random.default_rng(5)
    sets, pairs, far = [], [], []
    for n in (1, 5, 40, 255, 256, 257, 300, 513, 2048, 2100, 9000):
        h = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        part = h[:-(-80 * n // 100)]  # a subset with 80% of it
        changed = np.unique(np.concatenate([h[n // 9:], rng.integers(0, 1 << 63, n // 9, dtype=np.uint64)]))
        for x, y in ((h, part), (h, changed), (h, h)):
            assert 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y))
            pairs.append((len(sets), len(sets) + 1))
            sets += [x, y]
        if n >= 40:
            far.append((len(sets), len(sets) + 1))
            sets += [h, np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    longs, at = J.sign_bits(np.concatenate(sets), bounds)
    marks = spark.createDataFrame([(i, len(s), longs[at[i]:at[i + 1]].tolist()) for i, s in enumerate(sets)],
                                  "doc_id long, n long, sign array<long>")
    got = J.not_far(spark.createDataFrame(pairs + far, "a long, b long"), marks, 80).collect()
    assert sorted(map(tuple, got)) == pairs


def test_very_long_text_and_word():
    long = "x" * 300_000 + " " + "w " * 100_000
    h, bounds = H.shingle_sets([long.encode(), b"", b" \t", b"A b", b"a B"], 5)
    assert np.diff(bounds).tolist() == [2, 0, 0, 1, 1] and h[bounds[3]] == h[bounds[4]]


def test_components_of_paths_stars_and_nothing(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (2001, 2000)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {r.id: r.component for r in connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(50)}, 2000: 2000, 2001: 2000}
    assert connected_components(df.limit(0)).collect() == []
    assert connected_components(df.where(F.col("a") == 7).where("b = 7")).collect() == []


def test_what_no_later_step_reads_is_deleted(spark, monkeypatch):
    made, make = [], common.scratch_dir
    monkeypatch.setattr(common, "scratch_dir", lambda *a: made.append(make(*a)) or made[-1])
    docs = spark.createDataFrame([(i, t, 1, "", "") for i, t in corpus(5, groups=4)], SCHEMA)
    out = J.near_duplicates(docs)
    left = {Path(d).name.rpartition("-")[0] for d in made if any(Path(d.removeprefix("file:")).rglob("part-*"))}
    assert {"join-sizes", "join-classes"} <= left <= {"join-sizes", "join-classes", "join-links", "components"}
    assert len(made) > 10 and out.count() == docs.count()


def test_shuffle_files_go_with_the_query_and_the_setting_is_put_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own = [d.toString() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def files():
        return {f for d in own for f in Path(d).rglob("shuffle_*.data")}

    before, was = files(), spark.conf.get(key)
    cut(spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count(), "test-shuffle")
    for _ in range(50):
        if not (left := files() - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(key) == was
    with pytest.raises(Exception):
        cut(spark.range(5).select(F.raise_error(F.lit("no"))), "test-error")
    assert spark.conf.get(key) == was


@pytest.mark.parametrize("bits", [64, J.ID_BITS])
def test_rows_without_keys_are_exact_whatever_the_bitmap_holds(spark, monkeypatch, bits):
    monkeypatch.setattr(J, "ID_BITS", bits)
    rows = spark.createDataFrame([(i % 500, f"text {i}") for i in range(1000)] + [(None, "none")], "key long, text string")
    for gone in (range(0, 500, 3), range(0), range(500)):
        ids = spark.createDataFrame([(i,) for i in gone], "key long")
        got = sorted((r.key, r.text) for r in J.without(rows, "key", ids).collect() if r.key is not None)
        assert got == sorted((i % 500, f"text {i}") for i in range(1000) if i % 500 not in set(gone))
        assert J.without(rows, "key", ids).where("key is null").count() == 1


def test_the_stage_does_not_move_the_texts_that_stay(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdefgh ", k=2000)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    auto = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(auto)
    spark.conf.set(auto, "-1")
    try:
        out = J.dedupe_stage(spark, df, "")
        assert out.count() == 300
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(auto, was)
    assert "BroadcastHashJoin" in plan
