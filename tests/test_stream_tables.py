"""Rankings with retraction, keyed state with a lifetime, moving lookup tables, the event-time carry, commit markers."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rivulet.functions.timecols import epoch_millis
from rivulet.operators.running import repair_event_time
from rivulet.session import ensure_state_store, scratch_dir, ship_package
from rivulet.sources.sinks import fan_out_writer
from rivulet.streaming import operators as O
from rivulet.streaming.harness import file_stream, run_batches
from rivulet.streaming.ranking import bucket_lists, rank_writer
from rivulet.streaming.state import BucketTop, RetainedPairs
from rivulet.streaming.versions import Versions, commit, committed, read_committed, uncommit

CHANGES = "industry string, symbol string, shares long, n long"


def feed(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def ranking(spark, base, batch):
    rows = read_committed(spark, base, "changes").where(F.col("batch_id") == batch).orderBy("rank").collect()
    out = {}
    for r in rows:
        out.setdefault(r.group, []).extend([(r.member, r.amount)] if r["rank"] else [])
    return out


def test_ranking_with_falling_values_moves_and_a_hot_group(spark):
    """State and lists go on after a restart; each batch emits the touched groups only."""
    ensure_state_store(spark)
    ship_package(spark)
    path, base, ckpt = (scratch_dir(spark, f"rank-{n}") for n in ("in", "out", "ckpt"))
    schema = spark.createDataFrame([], CHANGES).schema

    def run():
        s = file_stream(spark, path, schema, max_files=1)
        lists = bucket_lists(s, F.col("industry"), F.col("symbol"), F.col("shares"), F.col("n"), k=3, buckets=4)
        run_batches(spark, lists, "rank", rank_writer(base, 3), ckpt, mode="update")

    hot = [("H", f"s{i:03d}", 1000 - i, 1) for i in range(300)]  # a group over all buckets
    feed(spark, path, [*hot, ("X", "a", 5, 1), ("X", "b", 5, 1), ("Y", None, 2, 1), (None, "n", 1, 1)], CHANGES)
    # s000 falls out of the list; b moves from X to Y; a is taken back, so X is empty
    feed(spark, path, [("H", "s000", -900, 1), ("X", "b", -5, -1), ("Y", "b", 5, 1), ("X", "a", -5, -1)], CHANGES)
    run()
    assert ranking(spark, base, 0) == {"H": [("s000", 1000), ("s001", 999), ("s002", 998)], "X": [("a", 5), ("b", 5)],
                                       "Y": [(None, 2)], None: [("n", 1)]}
    assert ranking(spark, base, 1) == {"H": [("s001", 999), ("s002", 998), ("s003", 997)], "X": [],
                                       "Y": [("b", 5), (None, 2)]}
    feed(spark, path, [("H", f"s{i:03d}", -(1000 - i), -1) for i in range(1, 299)], CHANGES)
    run()
    assert ranking(spark, base, 2) == {"H": [("s299", 701), ("s000", 100)]}
    assert committed(spark, base) == [0, 1, 2]


class Memory(dict):
    """State variables of one key, in memory."""

    def __init__(self):
        super().__init__()
        self.timers = []

    def getMapState(self, name, *_):
        values = self.setdefault(name, {})
        return type("Map", (), {"getValue": values.get, "updateValue": values.__setitem__, "removeKey": values.pop,
                                "iterator": lambda: iter(values.items())})

    def getValueState(self, name, *_):
        return type("Value", (), {"exists": lambda: name in self, "get": lambda: self[name],
                                  "update": lambda v: self.__setitem__(name, v)})

    def getListState(self, name, *_):
        values = self.setdefault(name, [])
        return type("List", (), {"exists": lambda: bool(values), "get": lambda: iter(values),
                                 "appendList": values.extend, "clear": values.clear})

    def registerTimer(self, ms):
        self.timers.append(ms)


def test_bucket_lists_against_all_totals():
    import random

    rng, memory, truth = random.Random(7), Memory(), {}
    for _ in range(300):
        top = BucketTop(3)
        top.init(memory)
        rows = []
        for _ in range(rng.randrange(1, 4)):
            m = rng.choice([None, *"abcdefgh"])
            live = truth.get(m, [])
            if live and rng.random() < 0.45:
                rows.append((m, -live.pop(rng.randrange(len(live))), -1))
            else:
                amount = rng.randrange(-5, 20)
                truth.setdefault(m, []).append(amount)
                rows.append((m, amount, 1))
        frame = pd.DataFrame([(m, a, n, 4) for m, a, n in rows], columns=["member", "amount", "n", "mark"])
        out = next(top.handleInputRows(("g", 1), iter([frame]), None))
        got = [(m, a) for r, m, a in zip(out["rank"], out["member"], out["amount"], strict=True) if r]
        want = sorted(((m, sum(v)) for m, v in truth.items() if v), key=lambda e: (-e[1], e[0] is not None, e[0] or ""))
        assert [(m if isinstance(m, str) else None, a) for m, a in got] == want[:3]
    assert all(v[1] for v in memory["totals"].values())  # members taken back leave no state


def test_pairs_within_the_retention_only_and_state_ends():
    memory, w = Memory(), 1000
    p = RetainedPairs(w)
    p.init(memory)
    frame = lambda rows: iter([pd.DataFrame(rows, columns=["side", "rid", "ms"])])
    got = list(p.handleInputRows(("k", 5), frame([("a", 1, 5000), ("a", 2, 5900), ("b", 3, 5901)]), None))
    assert [tuple(r) for r in got[0][["a_id", "b_id"]].to_numpy()] == [(1, 3), (2, 3)]
    got = list(p.handleInputRows(("k", 5), frame([("b", 4, 6001), ("b", 5, 4000), ("b", 6, 6901)]), None))
    assert sorted(map(tuple, got[0][["a_id", "b_id"]].to_numpy())) == [(1, 5), (2, 4)]
    assert memory.timers == [7000]
    assert len(next(p.handleExpiredTimer(("k", 5), None, None))) == 0
    assert memory["a"] == [] and memory["b"] == []


def test_retained_pairs_over_a_restart(spark):
    """The default retention is 120 s. A record stored before a restart meets one that comes after it within the
    retention; one that comes after the watermark has passed it does not, whatever its time."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    t = dt.datetime(2024, 1, 1)
    schema = "id long, who string, ts timestamp_ntz"
    paths = [scratch_dir(spark, f"kept-{s}") for s in "ab"]
    out, ckpt = scratch_dir(spark, "kept-out"), scratch_dir(spark, "kept-ckpt")
    at = lambda s: t + dt.timedelta(seconds=s)

    def run(a, b):
        for path, rows in zip(paths, (a, b), strict=True):
            feed(spark, path, rows, schema)
        streams = [file_stream(spark, p, spark.createDataFrame([], schema).schema, max_files=1) for p in paths]
        df = O.retained_pairs(*streams, "who", "ts", "id")
        q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return sorted((r.key, r.a_id, r.b_id) for r in spark.read.schema(df.schema).parquet(out).collect())

    first = run([(1, "u", at(0)), (2, "v", at(10)), (3, None, at(0)), (4, "w", at(20))], [(5, "u", at(60)), (6, None, at(0))])
    assert first == [("u", 1, 5)]
    # on time: v's 120 s end exactly at its partner's time; u's first record is 121 s away from the next one
    second = run([(7, "z", at(100))], [(8, "v", at(130)), (9, "u", at(121))])
    assert second == [("u", 1, 5), ("v", 2, 8)]
    run([(10, "z", at(2000))], [(11, "z", at(5000))])  # the watermark passes all of these
    last = run([(13, "z", at(5010))], [(12, "w", at(21))])
    assert last == [("u", 1, 5), ("v", 2, 8), ("z", 13, 11)]


def test_a_moving_table_shows_changes_to_later_batches_only(spark):
    log, base = scratch_dir(spark, "move-log"), scratch_dir(spark, "move")
    names = spark.createDataFrame([(1, "old", 0), (2, "gone", 0)], "id long, name string, seq long")
    table = O.MovingTable(log, base, names.schema, "id", "seq")
    write = O.look_up_writer(base, [(table, "who")])
    facts = lambda n: spark.createDataFrame([(10 * n + (i or 9), i) for i in (1, 2, 3, None)], "fact long, who long")
    show = lambda: {r.fact: r.name for r in read_committed(spark, base, "joined").where("who > 0").collect()}
    write(facts(0), 0)  # nothing in the log yet
    O.log_writer(log)(names, 0)
    write(facts(1), 1)
    O.log_writer(log)(spark.createDataFrame([(1, "new", 1), (2, None, 1), (3, "third", 1), (1, "stale", -1)],
                                            names.schema), 1)
    write(facts(2), 2)
    want = {1: None, 2: None, 3: None, 11: "old", 12: "gone", 13: None, 21: "new", 22: None, 23: "third"}
    assert show() == want
    write(facts(1), 1)  # a replay sees what the first run saw
    assert show() == want
    write(facts(3), 3)  # a log without new batches
    assert show() == {**want, 31: "new", 32: None, 33: "third"}
    assert read_committed(spark, base, "joined").where("who is null").count() == 4


def test_event_time_carry_between_batches(spark):
    schema = "event_id long, partition int, offset long, ts_ms long"
    rows = [(i, i % 3 if i % 10 else None, i, -1 if i < 6 or i % 4 == 0 else 1000 - 7 * i if i % 5 else 2000 + i)
            for i in range(120)]
    df = spark.createDataFrame(rows, schema)
    base = scratch_dir(spark, "carry")
    write = O.repair_writer(base, df.schema)
    for n, (low, high) in enumerate([(0, 40), (40, 41), (41, 90), (90, 120)]):
        write(df.where((F.col("offset") >= low) & (F.col("offset") < high)), n)
    write(df.where("offset >= 90"), 3)
    cols = ["event_id", "partition", "offset", "ts_ms", "event_ms", "repaired"]
    got = sorted(map(str, read_committed(spark, base, "fixed").select(*cols).collect()))
    assert got == sorted(map(str, repair_event_time(df).select(*cols).collect()))


def test_half_written_batches_are_invisible(spark):
    base = scratch_dir(spark, "markers")
    df = spark.range(5)
    ok = fan_out_writer(lambda b: {"one": b, "two": b.selectExpr("id * 2 as id")}, base)
    ok(df, 0)

    def broken(b):
        return {"one": b, "two": b.select(F.assert_true(F.lit(False), F.lit("lost")).alias("x"))}

    with pytest.raises(Exception, match="lost"):
        fan_out_writer(broken, base)(df, 1)
    assert committed(spark, base) == [0]
    assert read_committed(spark, base, "one").count() == 5 and spark.read.parquet(f"{base}/one/batch=*").count() == 10
    with pytest.raises(Exception, match="lost"):
        fan_out_writer(broken, base)(df, 0)  # a replay that fails takes its batch away
    assert committed(spark, base) == []
    ok(df, 0)
    ok(df, 1)
    assert committed(spark, base) == [0, 1] and read_committed(spark, base, "two").agg(F.sum("id")).first()[0] == 40


def test_versions_keep_what_a_replay_needs(spark):
    v = Versions(scratch_dir(spark, "versions"), spark.range(1).schema)
    assert v.before(spark, 0).count() == 0
    for i in range(6):
        v.write(spark.range(i), i)
        assert v.before(spark, i + 1).count() == i
    assert v.before(spark, 5).count() == 4 and committed(spark, v.base) == [3, 4, 5]
    uncommit(spark, v.base, 5)
    assert v.before(spark, 9).count() == 4
    commit(spark, v.base, 5)
    assert v.before(spark, 9).count() == 5


def test_milliseconds_are_floored(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 1999),)], "ts timestamp_ntz")
    assert df.select((epoch_millis("ts") % 1000).alias("ms")).first().ms == 1
