"""Keyed state (transformWithStateInPandas).

Rows reach the handlers already reduced to the JVM-computed columns they
need, and keys are split (by bucket or time slot) so that no key holds a hot
group's state.  Totals per key do not need a processor:
``rivulet.streaming.operators`` keeps them as native update-mode aggregates.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

RANKED = T.StructType([
    T.StructField("group", T.StringType()),
    T.StructField("bucket", T.IntegerType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("member", T.StringType()),
    T.StructField("amount", T.LongType()),
    T.StructField("mark", T.LongType()),
])


class BucketTop(StatefulProcessor):
    """Per (group, bucket): the totals of its members, and the k largest of those with contributions (ties: the
    least member, null first). Members' totals are read and written one by one; all of the bucket's are read again only
    when a member of the list has fallen below the list's last place, so that one from outside may take it."""

    def __init__(self, k: int):
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getMapState("totals", "member string", "amount long, n long")
        self.top = handle.getValueState("top", "members string")

    @staticmethod
    def place(entry: tuple) -> tuple:
        member, amount = entry
        return (-amount, member is not None, member or "")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        changes = batch.groupby("member", dropna=False)[["amount", "n"]].sum()
        before = [tuple(e) for e in json.loads(self.top.get()[0])] if self.top.exists() else []
        listed = dict(before)
        for member, amount, n in changes.itertuples():
            member = None if pd.isna(member) else member
            slot = ("" if member is None else "=" + member,)
            had = self.totals.getValue(slot) or (0, 0)
            amount, n = int(had[0]) + int(amount), int(had[1]) + int(n)
            if n or amount:
                self.totals.updateValue(slot, (amount, n))
            elif had != (0, 0):
                self.totals.removeKey(slot)
            listed.pop(member, None)
            if n > 0:
                listed[member] = amount
        top = sorted(listed.items(), key=self.place)[:self.k]
        # members outside the list come after its last place, if it was full
        if len(before) == self.k and (len(top) < self.k or self.place(top[-1]) > self.place(before[-1])):
            found = ((slot[0][1:] if slot[0] else None, int(v[0])) for slot, v in self.totals.iterator() if v[1] > 0)
            top = heapq.nsmallest(self.k, found, key=self.place)
        self.top.update((json.dumps(top),))
        mark, (group, bucket) = int(batch["mark"].max()), key
        shown = [(i + 1, m, a) for i, (m, a) in enumerate(top)] or [(0, None, None)]
        out = pd.DataFrame({"group": [group] * len(shown), "bucket": [bucket] * len(shown),
                            "rank": [r for r, _, _ in shown], "member": [m for _, m, _ in shown],
                            "amount": [a for _, _, a in shown], "mark": [mark] * len(shown)}, dtype=object)
        yield out.astype({"bucket": "int32", "rank": "int32", "amount": "Int64", "mark": "int64"})

    def close(self) -> None:
        pass


PAIRED = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("a_id", T.LongType()),
    T.StructField("b_id", T.LongType()),
    T.StructField("a_ms", T.LongType()),
    T.StructField("b_ms", T.LongType()),
])


class RetainedPairs(StatefulProcessor):
    """Per (key, slot of ``retention_ms`` event time): the records of two sides that may still meet. A record of side a is
    here in its own slot, one of side b also in the slots beside its own, so every pair meets in a's slot once. A new
    record is paired with the stored ones of the other side that are no further than the retention from it. When the
    watermark has passed all that can still come, a timer empties the key's lists."""

    def __init__(self, retention_ms: int):
        self.retention = retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sides = {s: handle.getListState(s, "rid long, ms long") for s in "ab"}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        new = {s: batch.loc[batch["side"] == s, ["rid", "ms"]].to_numpy(dtype="int64") for s in "ab"}
        old = {s: np.array(list(state.get()) if state.exists() else [], dtype="int64").reshape(-1, 2)
               for s, state in self.sides.items()}
        if not any(len(o) for o in old.values()):
            self.handle.registerTimer((int(key[1]) + 2) * self.retention)
        for s, state in self.sides.items():
            if len(new[s]):
                state.appendList([(int(r), int(m)) for r, m in new[s]])
        parts = [self.near(new["a"], np.concatenate([old["b"], new["b"]])), self.near(old["a"], new["b"])]
        found = np.concatenate(parts)
        if len(found):
            yield pd.DataFrame({"key": [key[0]] * len(found), **{c: found[:, i] for i, c in enumerate(
                ("a_id", "b_id", "a_ms", "b_ms"))}})

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rows (a_id, b_id, a_ms, b_ms) of the pairs within the retention."""
        b = b[np.argsort(b[:, 1], kind="stable")]
        low = np.searchsorted(b[:, 1], a[:, 1] - self.retention, "left")
        n = np.searchsorted(b[:, 1], a[:, 1] + self.retention, "right") - low
        left = np.repeat(np.arange(len(a)), n)
        right = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        return np.column_stack([a[left, 0], b[right, 0], a[left, 1], b[right, 1]])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for state in self.sides.values():
            state.clear()
        yield pd.DataFrame({f.name: pd.Series(dtype="object" if f.name == "key" else "int64") for f in PAIRED.fields})

    def close(self) -> None:
        pass
