"""Compression classifier: how much better a text compresses with a dictionary of good text than with one of bad text.

``fit_quality`` takes labelled texts, trains one zstandard dictionary per class and fits a logistic curve; both use
bounded samples, all else covers every row. ``score_quality`` cuts the whole text into blocks of ``BLOCK_BYTES``,
compresses each with either dictionary (a block is small enough that the dictionary matters in every part of a long
text), and adds up the sizes. With g and b the sizes with the good and the bad dictionary, p the size without one and n
the text's bytes, the score is the logistic curve of the normalised difference (b - g) / (n + 16), of the plain ratio
p / (n + 16) that the difference is to be read against, and of their product.

Bounds of the sample: of two thirds of the labelled rows (by a hash of the id), ``PER_CLASS`` per class for the
dictionaries; of the other third, ``CALIBRATE`` rows as they come for the curve; in either, the rows with the least hash
of their id. The dictionary rows' texts give ``BLOCKS`` blocks per class, those with the least hash; calibration rows
count with their whole text. Inputs of a score are the text alone.

Defined results: a null text is the empty text, and has a score like any other (that of differences and ratio 0).
Null labels teach nothing; a row that is labelled twice counts twice. Without labels of both classes every score is
0.5. Repeated documents are scored alike. The query drops columns
other than the key and the text; the stage keeps all, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import bound_batches, extended, packed, table, widened

BLOCK_BYTES = 4096
DICTIONARY_BYTES = 112 << 10
LEVEL = 3
PER_CLASS = 3000
BLOCKS = 3000
CALIBRATE = 4000
THRESHOLD = 0.3


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0)


def train_dictionary(blocks: list[bytes]) -> bytes:
    """A zstandard dictionary; too few blocks for its trainer make a raw-content dictionary of their bytes."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[:DICTIONARY_BYTES]


class Sizer:
    """Compressed sizes of whole texts with the good, the bad and no dictionary."""

    def __init__(self, model: QualityModel):
        plain = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=0, write_checksum=0,
                                                               write_dict_id=0)
        make = lambda d: zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d),
                                                  compression_params=plain)
        self.compressors = (make(model.good), make(model.bad), zstandard.ZstdCompressor(compression_params=plain))

    def features(self, text: str) -> tuple[float, float, float, float]:
        data = text.encode("utf-8", "surrogatepass")
        blocks = [data[i:i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        good, bad, plain = (sum(len(c.compress(b)) for b in blocks) for c in self.compressors)
        n = len(data) + 16
        return (bad - good) / n, plain / n, (bad - good) / n * plain / n, 1.0


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the logistic curve over columns ``x`` (Newton steps; columns are scaled first). The difference leads:
    the columns after it are held back more, so that a few calibration rows do not let them decide."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-12)
    z, w = x / scale, np.zeros(x.shape[1])
    ridge = np.diag([1e-3, 0.1, 0.1, 1e-3])
    for _ in range(100):
        p = sigmoid(z @ w)
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += np.clip(step, -20, 20)
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS,
                calibrate: int = CALIBRATE) -> QualityModel | None:
    """The model from docs (key, text) and labels (key, good boolean). Only the sampled ids and texts go to the
    driver; ids meet the documents in a join with at most 2 * per_class + calibrate rows on one side."""
    known = labels.where(F.col("good").isNotNull()).withColumn("order", F.xxhash64("key", F.lit("quality")))
    for_curve = F.pmod(F.xxhash64("key", F.lit("fold")), F.lit(3)) == 0
    least = lambda rows, n, use: rows.orderBy("order", "key").limit(n).withColumn("use", F.lit(use))
    ids = (least(known.where(~for_curve & F.col("good")), per_class, 0)
           .unionByName(least(known.where(~for_curve & ~F.col("good")), per_class, 0))
           .unionByName(least(known.where(for_curve), calibrate, 1)))
    sample = docs.join(F.broadcast(ids), "key")
    start = F.explode(F.sequence(F.lit(1), F.length("text"), F.lit(BLOCK_BYTES)))
    blocks = (sample.where("use = 0").where("text <> ''").select("good", "key", "text", start.alias("start"))
              .select("good", F.substr("text", F.col("start"), F.lit(BLOCK_BYTES)).alias("block"),
                      F.xxhash64("key", "start").alias("order")))
    good, bad = ([b.encode() for b in blocks.where(F.col("good") == kind).orderBy("order", "block").limit(BLOCKS)
                  .toArrow()["block"].to_pylist()] for kind in (True, False))
    if not good or not bad:
        return None
    model = QualityModel(train_dictionary(good), train_dictionary(bad))
    points = (with_features(sample.where("use = 1").select("good", "text"), model, "text").drop("text")
              .orderBy("difference", "ratio", "good").toArrow())
    y = np.array(points["good"].to_pylist(), float)
    if 0 < y.sum() < len(y):
        x = np.column_stack([points[n].to_numpy() for n in ("difference", "ratio", "product")] + [np.ones(len(y))])
        model.weights = tuple(fit_curve(x, y))
    return model


def with_features(df: DataFrame, model: QualityModel, text: str) -> DataFrame:
    """``df`` and the columns difference, ratio, product."""
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = Sizer(shared.value)
        for batch in batches:
            rows = [sizer.features(t.as_py() or "") for t in batch.column(text)]
            cols = [pa.array([r[k] for r in rows], pa.float64()) for k in range(3)]
            yield extended(batch, difference=cols[0], ratio=cols[1], product=cols[2])

    return df.mapInArrow(run, widened(df.schema, difference="double", ratio="double", product="double"))


def score_column(weights: tuple[float, ...]) -> Column:
    at = sum((F.col(n) * float(w) for n, w in zip(("difference", "ratio", "product"), weights, strict=False)),
             F.lit(float(weights[3])))
    return 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), at))))


def score_quality(docs: DataFrame, model: QualityModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """docs (with column text) with score and predicted, in place of any columns of these two names; all others stay."""
    rows, back = packed(docs.drop("score", "predicted"), "text")
    score = F.lit(0.5) if model is None else score_column(model.weights)
    scored = rows if model is None else with_features(rows, model, "text")
    return (scored.withColumn("score", score)
            .select(*back, "score", (F.col("score") >= threshold).cast("int").alias("predicted")))


def held_out(key: Column) -> Column:
    """The fold that is kept from learning: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame) -> QualityModel | None:
    """The model from documents (doc_id, text) and labels (doc_id, quality), without the held-out fold."""
    good = F.when(F.col("quality") == 1, True).when(F.col("quality") == 0, False)
    taught = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").alias("key"), good.alias("good"))
    return fit_quality(docs.select(F.col("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text")), taught)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return (score_quality(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; labels come from the input's table."""
    model = learn(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    rows, back = packed(docs, "doc_id", "text")
    return score_quality(rows, model).where("predicted = 1").select(*back)
