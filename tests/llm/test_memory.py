"""What a task holds at a time, in the similarity join and the neighbour search."""

import io
from contextlib import redirect_stdout

import numpy as np
import pyarrow as pa

from rivulet.llm import neighbours as N
from rivulet.llm import similarity_join as J


def test_sets_are_made_in_one_python_pass_and_only_for_the_ids(spark):
    docs = spark.createDataFrame([(i, f"one two three four five six {i}") for i in range(300)] + [(None, "a b c d e f")],
                                 "doc_id long, text string")
    sets = J.sets_of(docs, spark.createDataFrame([(7,), (250,), (999,)], "doc_id long"), 5)
    out = io.StringIO()
    with redirect_stdout(out):
        sets.explain()
    assert out.getvalue().count("MapInArrow") == 1 and "EvalPython" not in out.getvalue()
    assert {r.doc_id: len(r.shingles) for r in sets.collect()} == {7: 3, 250: 3}


def test_filed_vectors_leave_a_task_in_bounded_batches():
    class Rows:
        schema = {"vector": type("Field", (), {"dataType": type("Type", (), {"simpleString": lambda: "array<double>"})})}

        def mapInArrow(self, run, _):
            return run

    vectors = np.random.RandomState(1).randn(600, 128)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(600)), pa.array(list(vectors))], names=["id", "vector"])
    out = list(N.filed(Rows(), 128, 2, {0: 200, 3: 1})(iter([batch])))
    assert max(b.num_rows for b in out) * 128 * 8 <= N.FILED_BYTES
    assert sum(b.num_rows for b in out) == 2 * 600 * 201
    t, axis, ids = (np.concatenate([np.asarray(b.column(c)) for b in out]) for c in ("t", "axis", "id"))
    for table, y in enumerate(N.rotated(vectors, 2)):
        for i in (0, 311, 599):
            assert list(axis[(t == table) & (ids == i)]) == list(N.axes_in_order(y)[i, :200])
    assert all((np.asarray(b.column("vector").to_pylist()) == vectors[np.asarray(b.column("id"))]).all() for b in out[:2])
