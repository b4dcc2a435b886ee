"""Language ID: averaged embeddings of hashed subwords under a linear softmax.

Texts are lower-cased; a word is a stretch of letters. Its subwords are the word itself and the GRAMS-grams of the word
between marks; each falls into one of BUCKETS buckets by a hash of its code points. A text's vector is the mean of its subwords' embeddings,
and a linear softmax over the learned languages reads it. Embeddings and softmax are trained together by stochastic
gradient descent in numpy, on the driver, from a bounded sample; every text is then scored whole, in the tasks, which
get the model (BUCKETS x DIMENSIONS numbers) as a broadcast.

Sample: PER_LANGUAGE labelled rows of each language at most, and SAMPLE in all, by a hash of the id (every language's
first row comes before any second one, so that none is missed as long as there are at most SAMPLE languages, else the
SAMPLE commonest ones count; rows that repeat a sampled id and language come along). Ids are ranked without texts, and only those whose hash can be among the
least of their language; the sampled ones, at most SAMPLE, then meet the texts. A row sends at most BUCKETS
counts to the driver, of the whole text and of its first EXCERPT letters; so short texts are learned too. One row of
CALIBRATE is kept from training: on these, the softmax's temperature is fitted by likelihood, and the rejection
threshold is set to the least score from which on at least PRECISION of the calibration texts are right. A text whose
score is below it is marked as rejected.

Defined results: a null text, or one without a letter, has language ``und``, score 0 and is rejected; so has every text
if nothing could be learned. Rows do not meet each other: repeated rows get equal results. Equal scores go to the
language that sorts first. A row with a null id belongs to the learning folds. Extra columns of the input are kept and
may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import bound_batches, table
from rivulet.llm.shingles import mixed

BUCKETS = 1 << 13
DIMENSIONS = 16
GRAMS = (2, 3, 4)
#: labelled rows of one language, and of all, that go into the sample
PER_LANGUAGE = 400
SAMPLE = 2000
#: times as many rows of a language are ranked as are taken
WIDER = 4
#: letters of the short form of a sampled text
EXCERPT = 40
#: one sampled row of so many calibrates
CALIBRATE = 4
#: share of calibration texts above the threshold that are right
PRECISION = 0.99
EPOCHS = 4
RATE = 0.5
#: code points of a text that are hashed at once (more, where a word is longer)
PIECE = 1 << 20
UNKNOWN = "und"

#: odd factors of a gram's code points
_KEYS = mixed(np.arange(1, 9, dtype=np.uint64)) | np.uint64(1)


@cache
def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def bucket_counts(text: str) -> np.ndarray:
    """How often each bucket occurs among a text's subwords."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.zeros(len(points) + 2, np.uint64)
    code[1:-1] = np.where(letters()[points], points, 0)
    code = code[np.concatenate([[True], (code[1:] != 0) | (code[:-1] != 0)])]  # one mark between words
    marks = np.flatnonzero(code == 0)
    out, first = np.zeros(BUCKETS, np.int64), 0
    while first + 1 < len(code):
        last = int(marks[min(np.searchsorted(marks, first + PIECE), len(marks) - 1)])
        out += _counts(code[first:last + 1])
        first = last
    return out


def _counts(code: np.ndarray) -> np.ndarray:
    """The same for code points of words, with a 0 before and after each."""
    out = np.zeros(BUCKETS, np.int64)
    for n in GRAMS:
        size = max(0, len(code) - n + 1)
        total, inside = np.full(size, n, np.uint64), np.ones(size, bool)
        for j in range(n):
            total += code[j:j + size] * _KEYS[j]
            if 0 < j < n - 1:
                inside &= code[j:j + size] != 0
        out += np.bincount(_bucket(total[inside]), minlength=BUCKETS)
    begin = np.flatnonzero((code[:-1] == 0) & (code[1:] != 0)) + 1
    if len(begin):
        place = np.arange(len(code)) - np.repeat(np.append(0, begin), np.diff(begin, prepend=0, append=len(code)))
        place[code == 0] = 0
        powers = np.cumprod(np.full(int(place.max()) + 1, _KEYS[0], np.uint64))
        out += np.bincount(_bucket(np.add.reduceat(code * powers[place], begin)), minlength=BUCKETS)
    return out


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes) >> np.uint64(32)).astype(np.int64) % BUCKETS


def counts_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of a text's subwords."""
    counts = bucket_counts(text)
    at = np.flatnonzero(counts)
    return at, counts[at]


@dataclass
class Model:
    languages: list[str]
    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.weights + self.bias

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        return softmax(self.logits(vectors) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], languages: list[str], epochs: int = EPOCHS,
          rate: float = RATE, seed: int = 11) -> Model:
    """The model from rows (language's number, buckets, counts); one gradient step a row, at a falling rate."""
    rng = np.random.default_rng(seed)
    k = len(languages)
    m = Model(languages, rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS, np.zeros((DIMENSIONS, k)), np.zeros(k))
    shares = [(label, b, (c / c.sum())[:, None]) for label, b, c in rows]
    total, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(shares)):
            label, buckets, share = shares[i]
            step = rate * (1 - done / total)
            done += 1
            mean = (m.embeddings[buckets] * share).sum(axis=0)
            error = softmax(m.logits(mean))
            error[label] -= 1
            back = m.weights @ error
            m.weights -= step * np.outer(mean, error)
            m.bias -= step * 0.1 * error
            # a row's buckets are distinct; sparse shares are scaled up, as a bucket meets few rows
            m.embeddings[buckets] -= step * np.sqrt(len(buckets)) * share * back
    return m


def mean_vector(m: Model, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return counts @ m.embeddings[buckets] / counts.sum()


def calibrate(m: Model, rows: list[tuple[int, np.ndarray, np.ndarray]], precision: float = PRECISION) -> None:
    """Set the temperature (least log loss on a grid) and the rejection threshold of ``m`` from rows not trained on."""
    if not rows:
        return
    labels = np.array([r[0] for r in rows])
    logits = m.logits(np.array([mean_vector(m, b, c) for _, b, c in rows]))
    loss = lambda t: -np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean()
    m.temperature = float(min(np.geomspace(0.05, 20, 121), key=loss))
    p = softmax(logits / m.temperature)
    best, right = p.max(axis=1), p.argmax(axis=1) == labels
    order = np.argsort(-best, kind="stable")
    ends = np.append(np.flatnonzero(np.diff(best[order])), len(order) - 1)  # equal scores stand or fall together
    good = np.cumsum(right[order])[ends] >= precision * (ends + 1)
    m.threshold = float(best[order][ends[np.flatnonzero(good)[-1]]]) if good.any() else 1.0


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE, sample: int = SAMPLE) -> Model | None:
    """The model from ``docs`` (key, text, lang), all of which may be learned from."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = known.select("lang", "key", F.xxhash64("key", F.lit("language")).alias("hash"))
    # a share of about WIDER * per_language rows of each language is enough to rank
    sizes = rows.groupBy("lang").agg(F.count("*").alias("size")).orderBy(F.desc("size"), "lang").limit(sample)
    likely = F.pmod("hash", F.lit(1 << 30)).cast("double") * F.col("size") <= float(WIDER * per_language * (1 << 30))
    nth = Window.partitionBy("lang").orderBy("place", "key")
    ids = (rows.join(F.broadcast(sizes), "lang").where(likely).withColumn("place", F.pmod("hash", F.lit(1 << 30)))
           .withColumn("_n", F.row_number().over(nth)).where(F.col("_n") <= per_language)
           .orderBy("_n", "lang").limit(sample)
           .select(F.col("key").alias("_key"), F.col("lang").alias("_lang"),
                   (F.pmod("_n", F.lit(CALIBRATE)) == 0).alias("held")).distinct())
    chosen = (known.join(F.broadcast(ids), F.col("key").eqNullSafe(F.col("_key")) & (F.col("lang") == F.col("_lang")))
              .select("lang", "text", "held"))
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text, held in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                forms = [counts_of(f) for f in (text, text[:EXCERPT])]
                yield pa.RecordBatch.from_pydict({
                    "lang": [lang] * 2, "held": [held] * 2, "buckets": [f[0].astype(np.int32) for f in forms],
                    "counts": [f[1].astype(np.int32) for f in forms], "form": [0, 1]}, _COUNTED)

    counted = chosen.mapInArrow(run, "lang string, held boolean, buckets array<int>, counts array<int>, form int").toArrow()
    counted = counted.sort_by([(n, "ascending") for n in ("lang", "form")])
    languages = sorted(set(counted["lang"].to_pylist()))
    rows: dict[bool, list] = {False: [], True: []}
    for lang, held, buckets, counts in zip(*(counted[n] for n in ("lang", "held", "buckets", "counts")), strict=True):
        b = buckets.values.to_numpy()
        if len(b):
            rows[held.as_py()].append((languages.index(lang.as_py()), b, counts.values.to_numpy().astype(float)))
    for part in rows.values():  # the order in which rows come back from the tasks decides nothing
        part.sort(key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))
    taught = rows[False] or rows[True]
    if not taught:
        return None
    model = train(taught, languages)
    calibrate(model, rows[True])
    return model


_COUNTED = pa.schema([("lang", pa.string()), ("held", pa.bool_()), ("buckets", pa.list_(pa.int32())),
                      ("counts", pa.list_(pa.int32())), ("form", pa.int32())])


def read(model: Model, text: str | None) -> tuple[str, float, bool]:
    """(language, score, rejected) of a text."""
    counts = bucket_counts(text or "")
    total = counts.sum()
    if not total:
        return UNKNOWN, 0.0, True
    p = model.scores(counts @ model.embeddings / total)
    best = int(p.argmax())
    return model.languages[best], float(p[best]), bool(p[best] < model.threshold)


OUT = {"lang_pred": T.StringType(), "score": T.DoubleType(), "rejected": T.BooleanType()}


def identify(docs: DataFrame, text: str, model: Model | None) -> DataFrame:
    """``docs`` and the column ``read`` (lang_pred, score, rejected) of the column ``text``; a column of that name is
    the caller's, and stays: the new one then has the first of the names read_, read__, ... that is free."""
    name = free_name("read", docs.columns)
    out = T.StructType([T.StructField(n, t) for n, t in OUT.items()])
    if model is None:
        return docs.withColumn(name, F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                                              F.lit(True).alias("rejected")))
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [read(shared.value, t.as_py()) for t in batch.column(at)]
            column = pa.StructArray.from_arrays([pa.array([f[i] for f in found], t) for i, t in
                                               enumerate((pa.string(), pa.float64(), pa.bool_()))], list(OUT))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, out)]))


def free_name(name: str, taken: list[str]) -> str:
    """``name`` with as many underscores as it takes to differ from the names taken, in any case."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def held_out(key: Column) -> Column:
    """The fold that is kept from learning: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = learn(docs.where(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("key"), "text", "lang"))
    return (identify(docs.select("doc_id", "text"), "text", model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "read.*"))
