import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from rivulet.llm import url_filter as U


@pytest.mark.parametrize("url,host,path,rule", [
    ("http://a.Example.NET/en/x?y#z", "a.example.net", "/en/x", "example.net/en/"),
    ("http://example.net/de/x", "example.net", "/de/x", "net/"), ("http://net/", "net", "/", "net/"),
    ("http://planet/", "planet", "/", None), ("http://x.net", "x.net", "", None),
    ("http://x.net?/a", "x.net", "", None), ("https://example.com/de/?q=://other.net/", "example.com", "/de/",
                                             "example.com/de/"),
    ("http://b.org/fr/#f", "b.org", "/fr/", "org/fr/"), ("http://b.org/fr", "b.org", "/fr", None),
    ("no scheme", "", "", None), (None, "", "", None), ("", "", "", None), ("a://b://c/d", "b:", "//c/d", None),
    ("http://ÄB.net/x", "Äb.net", "/x", "net/"), ("http://x\n.net/a\nb", "x\n.net", "/a\nb", "net/"),
])
def test_host_path_and_rule(spark, url, host, path, rule):
    h, p = U.split_url(F.col("url"))
    df = spark.createDataFrame([(url,)], "url string").select(h.alias("h"), p.alias("p"))
    r = df.select("h", "p", U.match_rules(F.col("h"), F.col("p"))[0].alias("r")).first()
    assert (r.h, r.p, r.r) == (host, path, rule)


def contexts(url):
    """(symbol, its contexts of 0 to ORDER symbols as tuples) along a URL."""
    sym = tuple(U.encode([url.encode()])[0].tolist())
    return [(sym[i], [sym[i - k:i] for k in range(U.ORDER + 1)]) for i in range(U.ORDER, len(sym))]


def scalar_model(rows):
    """Brute force: counts per (class, context) of symbols."""
    counts = {}
    for url, good in rows:
        for c, before in contexts(url):
            for context in before:
                at = counts.setdefault((good, context), {})
                at[c] = at.get(c, 0) + 1
    return counts


def scalar_ratio(counts, url):
    total = n = 0
    for c, before in contexts(url):
        logs = []
        for good in (False, True):
            p = 1 / U.SYMBOLS
            for context in before:
                at = counts.get((good, context))
                if at:
                    p = (at.get(c, 0) + len(at) * p) / (sum(at.values()) + len(at))
            logs.append(math.log(p))
        total, n = total + logs[1] - logs[0], n + 1
    return total / n


@pytest.mark.parametrize("folder,chunk", [(SF_SMALL, 1 << 20), (SF_SMALL, 300), (SF_CHECK, 5000)])
def test_scores_match_brute_force(spark, folder, chunk):
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    got = U.judge_urls(pages, chunk_bytes=chunk).collect()
    good = ("example.net/en/", "org/fr/")
    counts = scalar_model([(r.url, r.rule in good) for r in got if r.rule and zlib.crc32(r.url.encode()) % 5])
    assert len(got) == pages.count()
    curve = None
    for r in got:
        if 1e-6 < r.score < 1 - 1e-6:  # scores are one logistic curve of the scalar ratios
            point = (scalar_ratio(counts, r.url), math.log(r.score / (1 - r.score)))
            if curve is None:
                curve = [point]
            elif len(curve) == 1 and abs(point[0] - curve[0][0]) > 0.1:
                slope = (point[1] - curve[0][1]) / (point[0] - curve[0][0])
                curve = slope, point[1] - slope * point[0]
            elif len(curve) == 2:
                assert point[1] == pytest.approx(curve[0] * point[0] + curve[1], abs=1e-5)
        ours = ("allow" if r.rule in good else "block") if r.rule else "allow" if r.score >= 0.5 else "block"
        assert r.verdict == ours


def test_ratios_equal_the_scalar_model(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeé/.-%") for _ in range(rng.randint(0, 30)))
    rows = [(f"http://{word()}", rng.random() < 0.4) for _ in range(400)]
    new = [word() for _ in range(100)] + ["", "x" * 3000]
    cells = U.count_cells(spark.createDataFrame(rows, "url string, accepted boolean"))
    got = U.url_ratios(spark.createDataFrame([(u,) for u in new], "url string"), cells).collect()
    counts = scalar_model(rows)
    assert sorted(r.url for r in got) == sorted(new)
    for r in got:
        assert r.ratio == pytest.approx(scalar_ratio(counts, r.url), abs=1e-9)


def test_model_tells_unruled_urls_apart(spark):
    good = [(i, f"http://h{i}.example.net/en/{i}", True) for i in range(200)]
    bad = [(1000 + i, f"http://spam{i}.net/buy/{i}", False) for i in range(200)]
    new = [(5000, "http://h9.example.edu/en/77"), (5001, "http://spam8.info/buy/9")]
    df = spark.createDataFrame([r[:2] for r in good + bad] + new, "page_id long, url string")
    got = {r.page_id: r.verdict for r in U.judge_urls(df).collect()}
    assert got[5000] == "allow" and got[5001] == "block"


def test_nulls_long_repeated_and_clashing(spark):
    rows = [(1, None), (2, ""), (3, "x" * 200_000), (4, "http://a.net/"), (4, "http://a.net/"),
            (None, "http://b.org/fr/1"), (5, "http://é.org/ü")]
    df = spark.createDataFrame([(*r, "h", "v") for r in rows], "page_id long, url string, host string, verdict string")
    got = U.judge_urls(df).collect()
    assert len(got) == len(rows) and all(r.verdict in ("allow", "block") for r in got)
    assert [r.verdict for r in got if r.page_id == 4] == ["block", "block"]
    assert U.judge_urls(df.limit(0)).collect() == []
    one_kind = U.judge_urls(df.where("page_id = 2 or page_id = 4"))
    assert {(r.page_id, r.score, r.verdict) for r in one_kind.collect()} == {(2, 0.5, "allow"), (4, 0.5, "block")}
