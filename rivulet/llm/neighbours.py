"""Approximate nearest neighbours by cross-polytope hashing.

Each of ``TABLES`` tables turns all vectors by a fast pseudo-rotation (three times: random signs, then a Hadamard
transform) and files a vector under its nearest signed axis, which is the coordinate of largest absolute value. A query
looks at the axes nearest to it in every table; all vectors filed there are ranked by their exact inner product. For the
largest inner product, vectors of unequal lengths fall into bands, each of squared lengths within a factor of two (the
last band holds all that are shorter), and get one more coordinate that brings a band to one length (the queries' is 0),
so that the nearest direction is the largest product. Every band has tables of its own.

How many axes a query looks at is measured, per band: ``probe_counts`` ranks a sample of ``SAMPLE`` queries (those of
least hash) against all vectors by brute force, finds how far down the query's list of axes each true neighbour is
filed, in the best of the tables, and takes as many axes as find ``RECALL`` of them. So dimension, lengths and clusters
of the data set the cost, not the recall. A query that still meets fewer than k vectors is ranked against all vectors,
in blocks.

Equal vectors are filed once: the k + 1 least ids of each distinct vector are enough for k neighbours, and equal queries
are answered once. A crowded axis is cut into blocks of at most about ``BLOCK`` vectors by ``BLOCK`` queries, each a
group of its own, so no group grows with the data and nothing is left out. A group returns its best k + 1 per query.

Parameters: more tables find more with fewer probes; ``probes`` fixes the number of axes instead of measuring it. To the
driver go the sampled queries and their neighbours, at most SAMPLE * (k + 1) vectors.

Defined results: rows with a null id, or whose vector is null, empty, all zero, or holds a null or a non-finite component
take no part. Of rows with equal ids, each takes part; a query's own id is no candidate. Vectors of different dimensions
are filled up with zeros. A query gets fewer than k rows only if there are fewer. Equal products are ordered by id. Other
columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rivulet.llm.common import cut, partitions, table

TABLES = 6
SAMPLE = 64
RECALL = 0.97
BANDS = 16
BLOCK = 4096
#: bytes of vectors that a task hands on at a time
FILED_BYTES = 4 << 20
SEED = 20_240_607
#: vectors whose squared lengths differ by less than this share of the largest count as of one length
LENGTH_SLACK = 1e-6


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotated(x: np.ndarray, tables: int) -> Iterator[np.ndarray]:
    """The rows of ``x``, turned for each table in turn."""
    signs = np.random.RandomState(SEED).choice([-1.0, 1.0], (tables, 3, x.shape[1]))
    for of_table in signs:
        y = x
        for s in of_table:
            y = hadamard(y * s)
        yield y


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of ``width`` doubles, filled up with zeros."""
    ends = np.asarray(vectors.offsets)
    flat = np.asarray(vectors.values)[ends[0]:ends[-1]].astype(np.float64)
    size = np.diff(ends)
    out = np.zeros((len(size), width))
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], size)] = flat
    return out


def lifted(x: np.ndarray, longest: np.ndarray) -> np.ndarray:
    """The rows of ``x`` with the last coordinate that brings them to the squared length ``longest`` (0: as they are)."""
    x[:, -1] += np.sqrt(np.where(longest > 0, np.maximum(longest - (x * x).sum(axis=1), 0.0), 0.0))
    return x


def nearest_axis(y: np.ndarray) -> np.ndarray:
    """The signed axis nearest to each row: 0 to width - 1, or width more for the negative half."""
    axis = np.abs(y).argmax(axis=1)
    return axis + y.shape[1] * (y[np.arange(len(y)), axis] < 0)


def axes_in_order(y: np.ndarray) -> np.ndarray:
    """All signed axes for each row, the nearest first."""
    return np.argsort(-np.concatenate([y, -y], axis=1), axis=1, kind="stable")


def filed(rows: DataFrame, width: int, tables: int, probes: dict[int, int] | None = None) -> DataFrame:
    """rows (id, vector) once per table and axis. Points (with columns band and longest) go to the nearest axis of their
    band's tables, queries to as many axes as ``probes`` tells for each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = matrix(part.column("vector"), width)
                if probes is None:
                    band = np.asarray(part.column("band"))
                    x = lifted(x, np.asarray(part.column("longest")))
                for t, y in enumerate(rotated(x, tables)):
                    if probes is None:
                        found = [(band * tables + t, nearest_axis(y)[:, None])]
                    else:
                        order = axes_in_order(y)
                        found = [(np.full(len(x), b * tables + t), order[:, :n]) for b, n in probes.items()]
                    for of, axes in found:
                        row, axis = np.repeat(np.arange(len(x)), axes.shape[1]), axes.ravel().astype(np.int32)
                        step = max(1, FILED_BYTES // (8 * width))
                        for at_row in range(0, len(row), step):
                            these = row[at_row:at_row + step]
                            take = pa.array(these)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(of[these].astype(np.int32)), pa.array(axis[at_row:at_row + step]),
                                 part.column("id").take(take), part.column("vector").take(take)],
                                names=["t", "axis", "id", "vector"])

    return rows.mapInArrow(run, f"t int, axis int, id long, vector {rows.schema['vector'].dataType.simpleString()}")


def probe_counts(points: DataFrame, asked: DataFrame, width: int, tables: int, k: int, sample: int = SAMPLE,
                 recall: float = RECALL) -> dict[int, int]:
    """How many axes a query looks at in each band of points (id, vector, band, longest), so that the sampled queries
    of asked (id, vector) find the share ``recall`` of their k nearest. Bands without a neighbour are not looked at."""
    chosen = asked.orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(sample).toArrow()
    ids, vectors = np.asarray(chosen.column("id")), chosen.column("vector").combine_chunks()
    if not len(ids):
        return {}
    q = matrix(vectors, width)
    shared = points.sparkSession.sparkContext.broadcast((ids, q))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked_ids, wanted = shared.value
        scores, of = np.full((len(wanted), k), -np.inf), np.zeros((len(wanted), k), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                new = np.asarray(part.column("id"))
                near = wanted @ matrix(part.column("vector"), width).T
                near[asked_ids[:, None] == new[None, :]] = -np.inf
                near = np.concatenate([scores, near], axis=1)
                all_ids = np.concatenate([of, np.broadcast_to(new, (len(wanted), len(new)))], axis=1)
                top = np.argpartition(-near, k - 1, axis=1)[:, :k]
                scores, of = np.take_along_axis(near, top, 1), np.take_along_axis(all_ids, top, 1)
        row, col = np.nonzero(scores > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(of[row, col]), pa.array(scores[row, col])],
                                         names=["query", "id", "score"])

    top = W.partitionBy("query").orderBy(F.desc("score"), "id")
    true = (points.select("id", "vector").mapInArrow(best, "query long, id long, score double")
            .withColumn("n", F.row_number().over(top)).where(F.col("n") <= k).select("query", "id"))
    found = true.join(points, "id").select("query", "vector", "band", "longest").toArrow()
    if not found.num_rows:
        return {}
    of, band = np.asarray(found.column("query")), np.asarray(found.column("band"))
    x = lifted(matrix(found.column("vector").combine_chunks(), width), np.asarray(found.column("longest")))
    depth = np.full(len(x), 2 * width)
    for y, z in zip(rotated(q, tables), rotated(x, tables), strict=True):
        place = np.argsort(axes_in_order(y), axis=1)
        depth = np.minimum(depth, place[of, nearest_axis(z)])
    enough = np.sort(depth)[min(len(depth) - 1, int(np.ceil(recall * len(depth))) - 1)]
    return {int(b): int(depth[(band == b) & (depth <= enough)].max()) + 1
            for b in np.unique(band[depth <= enough])}


def blocks(rows: DataFrame, count: str, own: str, other: str) -> DataFrame:
    """rows dealt to one of ``own`` blocks, by id, and copied to each of the ``other`` side's."""
    mine = F.pmod(F.xxhash64("id"), F.col(own)).cast("int").alias(f"{count}_block")
    theirs = F.explode(F.sequence(F.lit(0), (F.col(other) - 1).cast("int")))
    name = "query_block" if count == "point" else "point_block"
    return rows.select("t", "axis", "id", "vector", mine, theirs.alias(name))


def best_in_blocks(points: DataFrame, queries: DataFrame, k: int, block: int) -> DataFrame:
    """(query, point, score): the best k + 1 points of each group for each query."""
    sizes = (points.groupBy("t", "axis").agg(F.ceil(F.count("*") / block).alias("points"))
             .join(queries.groupBy("t", "axis").agg(F.ceil(F.count("*") / block).alias("queries")), ["t", "axis"]))
    sizes = cut(sizes, "ann-sizes")  # at most BANDS * tables * 2 * width rows
    key = ["t", "axis", "point_block", "query_block"]
    x = blocks(points.join(F.broadcast(sizes), ["t", "axis"]), "point", "points", "queries")
    y = blocks(queries.join(F.broadcast(sizes), ["t", "axis"]), "query", "queries", "points")

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        got = pa.table({"query": pa.array([], pa.int64()), "point": pa.array([], pa.int64()),
                        "score": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return got
        of, vectors = (np.asarray(left.column("id")), left.column("vector").combine_chunks())
        asked, wanted = (np.asarray(right.column("id")), right.column("vector").combine_chunks())
        width = max(int(np.diff(np.asarray(v.offsets)).max()) for v in (vectors, wanted))
        p, out = matrix(vectors, width), [got]
        for at in range(0, len(asked), 512):
            q = matrix(wanted.slice(at, 512), width)
            near = q @ p.T
            if near.shape[1] > k + 1:
                least = np.partition(near, near.shape[1] - k - 1, axis=1)[:, near.shape[1] - k - 1]
                row, col = np.nonzero(near >= least[:, None])
            else:
                row, col = (i.ravel() for i in np.indices(near.shape))
            score = (q[row] * p[col]).sum(axis=1)
            order = np.lexsort((of[col], -score, row))
            row, col, score = row[order], col[order], score[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            row, col, score = row[rank <= k], col[rank <= k], score[rank <= k]
            out.append(pa.table({"query": pa.array(asked[at:][row]), "point": pa.array(of[col]),
                                 "score": pa.array(score)}))
        return pa.concat_tables(out)

    return x.groupBy(*key).cogroup(y.groupBy(*key)).applyInArrow(best, "query long, point long, score double")


def nearest(vectors: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20,
            tables: int = TABLES, probes: int | None = None, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest inner products found for each row where ``queries`` (over
    the columns of ``vectors``) holds, its own id left out."""
    spark = vectors.sparkSession
    rows = (vectors.where(usable(F.col(vector)) & F.col(key).isNotNull())
            .select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), queries.alias("asks"),
                    F.xxhash64(vector).alias("h1"), F.xxhash64(vector, F.lit(1)).alias("h2")))
    same = W.partitionBy("h1", "h2").orderBy("id")
    kept = cut(rows.select("id", "vector", "h1", "h2").distinct().withColumn("n", F.row_number().over(same))
               .where(F.col("n") <= k + 1), "ann-kept")
    distinct = kept.where("n = 1").drop("n")
    square = F.aggregate("vector", F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double"))
    about = distinct.agg(F.max(square).alias("most"), F.min(square).alias("least"),
                         F.max(F.size("vector")).alias("size")).first()
    if about["size"] is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    longer = about["most"] - about["least"] > LENGTH_SLACK * about["most"]
    width = 1 << (about["size"] + int(longer) - 1).bit_length()
    classes = distinct.select("h1", "h2", F.col("id").alias("class"))
    asking = cut(rows.where(F.coalesce("asks", F.lit(False))).select(F.col("id").alias("query_id"), "h1", "h2")
                 .join(classes, ["h1", "h2"]).select("query_id", "class").distinct(), "ann-asking")
    asked = distinct.join(asking.select(F.col("class").alias("id")).distinct(), "id", "left_semi")
    band = F.least(F.floor(F.log2(F.lit(about["most"]) / square)), F.lit(BANDS - 1)) if longer else F.lit(0)
    banded = cut(distinct.select("id", "vector", F.greatest(band, F.lit(0)).cast("int").alias("band")).withColumn(
        "longest", F.lit(about["most"] if longer else 0.0) / F.pow(F.lit(2.0), "band")), "ann-banded")
    if probes is None:
        axes = probe_counts(banded, asked.select("id", "vector"), width, tables, k)
    else:
        axes = {r["band"]: min(probes, 2 * width) for r in banded.select("band").distinct().collect()}
    points = cut(filed(banded, width, tables), "ann-points")
    probing = cut(filed(asked.select("id", "vector"), width, tables, axes), "ann-probes")
    itself = asked.select(F.col("id").alias("query"), F.col("id").alias("point"), square.alias("score"))
    found = cut(best_in_blocks(points, probing, k, block).unionByName(itself), "ann-found")
    members = kept.join(classes, ["h1", "h2"]).select(F.col("id").alias("vec_id"), F.col("class").alias("point"))
    met = (found.select("query", "point").distinct().join(members.groupBy("point").count(), "point")
           .groupBy("query").agg(F.sum("count").alias("met")))
    few = cut(met.where(F.col("met") <= k).select(F.col("query").alias("id")), "ann-few")
    if not few.isEmpty():
        everywhere = lambda rows: rows.select(F.lit(0).alias("t"), F.lit(0).alias("axis"), "id", "vector")
        found = found.unionByName(best_in_blocks(everywhere(banded), everywhere(asked.join(few, "id", "left_semi")), k,
                                                 block))
    found = found.repartition(partitions(spark), "query")
    top = W.partitionBy("query").orderBy(F.desc("score"), "point")
    found = (found.groupBy("query", "point").agg(F.max("score").alias("score"))
             .withColumn("n", F.row_number().over(top)).where(F.col("n") <= k + 1).drop("n"))
    lists = (found.join(members, "point").withColumn("n", F.row_number().over(
        W.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("n") <= k + 1))
    own = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (asking.join(cut(lists, "ann-lists"), F.col("class") == F.col("query")).where("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 20 == 0)
