"""URL filter: fixed host and path rules, and for all other URLs the ratio of two character language models.

``count_cells`` counts, over every labelled URL, how often a symbol follows each of its contexts of 0 to ``ORDER``
symbols, once for accepted and once for rejected URLs. Contexts are counted as they are, in a table that grows with the
URLs; a context and the symbol after it (a cell) are a 64-bit code, six bits a symbol, so no two meet by chance.

The probability of a symbol mixes all orders (Witten-Bell): a context that has been seen often, with few different
successors, counts most, and an unseen one passes its whole weight to the next shorter one, so the order varies with the
evidence. A URL's score is the difference of the two log-likelihoods per symbol, its end included. A fifth of the
labelled URLs (by crc32 of the text) is kept out of the counts; a logistic curve fitted to their scores makes the score
a probability of acceptance.

Scoring (``url_ratios``) is a chain of joins, without a model that travels whole. URLs are dealt to chunks of at most
``CHUNK_BYTES``, each of which asks once for every distinct string of ``ORDER`` + 1 symbols in it, so a string that all
URLs share costs one row per chunk. Each distinct string is valued once: its cells meet the counts, then order after
order takes the value of the next shorter cell. A context has at most ``SYMBOLS`` cells and a cell at most as many
longer ones, so no key of these joins is hot. The values go back to the chunks, which add them up.

Defined results: a null URL, or one without ``://``, has the empty host and path and is scored as its text (null: the
empty text). Without labelled URLs of both kinds every score is 0.5. A score of at least ``threshold`` (0.5) means
allow. Repeated rows are judged alike. Input columns other than the URL and the key columns are dropped, so none can
clash with the results.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rivulet.llm.common import ascii_lower, cut, extended, table, widened

#: verdict, host, start of the path
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))

ORDER = 5
SYMBOLS = 64
SYMBOL_BITS = 6
#: the order of a cell stands above this bit of its code
ORDER_BIT = SYMBOL_BITS * (ORDER + 1)
#: URL bytes of a chunk (or one longer URL)
CHUNK_BYTES = 1 << 20
#: symbols 0-61; 61: other ASCII, 62: other bytes, 63: start and end of a URL
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789-._~:/?#[]@!$&'()*+,;=%"
OTHER, FOREIGN, EDGE = 61, 62, 63
#: bins of a held-out score histogram, over [-SPAN, SPAN]
BINS, SPAN = 400, 8.0


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path (after it, up to ``?`` or ``#``); else both empty."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def match_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (null if none) and its verdict."""
    rule = verdict = None
    for kind, on, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(start)
        rule = rule.when(fits, on + start) if rule is not None else F.when(fits, on + start)
        verdict = verdict.when(fits, kind) if verdict is not None else F.when(fits, kind)
    return rule, verdict


def _symbol_table() -> np.ndarray:
    lut = np.full(256, OTHER, np.int64)
    lut[128:] = FOREIGN
    for i, ch in enumerate(ALPHABET):
        lut[ord(ch)] = lut[ord(ch.upper())] = i
    return lut


def encode(urls: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all URLs, each after ORDER start marks and before an end mark, and the index of the URL that a symbol
    belongs to (-1 at start marks)."""
    size = np.fromiter(map(len, urls), np.int64, len(urls))
    width = size + ORDER + 1
    first = np.cumsum(width) - width
    sym = np.full(int(width.sum()), EDGE, np.int64)
    owner = np.repeat(np.arange(len(urls)), width)
    inside = np.arange(len(sym)) - first[owner]
    body = (inside >= ORDER) & (inside < ORDER + size[owner])
    sym[body] = _symbol_table()[np.frombuffer(b"".join(urls), np.uint8)]
    owner[inside < ORDER] = -1
    return sym, owner


def strings(sym: np.ndarray) -> np.ndarray:
    """For every position the code of the ORDER + 1 symbols that end there (without meaning at start marks)."""
    code = np.zeros(len(sym), np.int64)
    for back in range(ORDER + 1):
        code[back:] |= sym[:len(sym) - back] << (SYMBOL_BITS * back)
    return code


def cells_of(code: np.ndarray, order: int) -> np.ndarray:
    """Codes of the cells of one order at the ends of the strings."""
    return (code & ((1 << SYMBOL_BITS * (order + 1)) - 1)) | (order << ORDER_BIT)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label = np.array(batch.column(1).to_pylist(), bool)
        for at, urls in pieces([(u or "").encode() for u in batch.column(0).to_pylist()]):
            sym, owner = encode(urls)
            real = owner >= 0
            code, good = strings(sym)[real], label[at:at + len(urls)][owner[real]]
            cells, where = np.unique(np.concatenate([cells_of(code, k) for k in range(ORDER + 1)]), return_inverse=True)
            accepted = np.bincount(where, np.tile(good, ORDER + 1), len(cells)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.bincount(where) - accepted),
                                              pa.array(accepted)], names=["cell", "rejected", "accepted"])


def pieces(urls: list[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """``urls`` in order, cut into lists of at most ``most`` bytes (or one longer URL), with the place of the first."""
    first, size = 0, 0
    for i, url in enumerate(urls):
        if i > first and size + len(url) > most:
            yield first, urls[first:i]
            first, size = i, 0
        size += len(url)
    if urls:
        yield first, urls[first:]


def count_cells(labelled: DataFrame) -> DataFrame:
    """cell, rejected, accepted: how often each cell occurs in the URLs of rows (url string, accepted boolean)."""
    return (labelled.where(F.col("accepted").isNotNull()).select("url", "accepted")
            .mapInArrow(_count, "cell long, rejected long, accepted long")
            .groupBy("cell").agg(F.sum("rejected").alias("rejected"), F.sum("accepted").alias("accepted")))


def string_gains(wanted: DataFrame, cells: DataFrame) -> DataFrame:
    """code, gain for the distinct strings ``wanted`` (code): the log-probability of the last symbol after the others
    among accepted URLs, less that among rejected ones, by the counts in ``cells``."""
    short = lambda k: F.col("code").bitwiseAND(F.lit((1 << SYMBOL_BITS * (k + 1)) - 1)).bitwiseOR(
        F.lit(k << ORDER_BIT))
    asked = (wanted.select(F.explode(F.array(*[short(k) for k in range(ORDER + 1)])).alias("cell"))
             .select("cell", F.lit(0).cast("long").alias("rejected"), F.lit(0).cast("long").alias("accepted"),
                     F.lit(True).alias("asked")))
    order = F.shiftright("cell", ORDER_BIT)
    body = F.col("cell").bitwiseAND(F.lit((1 << ORDER_BIT) - 1))
    context = F.shiftright(body, SYMBOL_BITS).bitwiseOR(F.shiftleft(order, ORDER_BIT))
    of_context = W.partitionBy("context")
    known = (asked.unionByName(cells.withColumn("asked", F.lit(False))).groupBy("cell")
             .agg(F.sum("rejected").alias("rejected"), F.sum("accepted").alias("accepted"), F.max("asked").alias("asked"))
             .withColumn("context", context))
    for kind in KINDS:
        known = known.withColumns({
            f"{kind}_total": F.sum(kind).over(of_context),
            f"{kind}_types": F.sum(F.when(F.col(kind) > 0, 1).otherwise(0)).over(of_context)})
    known = cut(known.where("asked").select("cell", order.cast("int").alias("order"), *KINDS,
                                            *[f"{kind}_{n}" for kind in KINDS for n in ("total", "types")]), "url-known")
    value = None
    for k in range(ORDER + 1):
        rows = known.where(F.col("order") == k)
        if k:
            inner = F.lit((1 << SYMBOL_BITS * k) - 1)
            rows = rows.withColumn("shorter", F.col("cell").bitwiseAND(inner).bitwiseOR(F.lit((k - 1) << ORDER_BIT)))
            rows = rows.join(value, "shorter")
        before = {kind: F.col(f"{kind}_p") if k else F.lit(1.0 / SYMBOLS) for kind in KINDS}
        p = [F.when(F.col(f"{kind}_total") > 0, (F.col(kind) + F.col(f"{kind}_types") * before[kind])
                    / (F.col(f"{kind}_total") + F.col(f"{kind}_types"))).otherwise(before[kind]).alias(f"{kind}_p")
             for kind in KINDS]
        value = rows.select(F.col("cell").alias("shorter"), *p)
    return value.select(F.col("shorter").bitwiseAND(F.lit((1 << ORDER_BIT) - 1)).alias("code"),
                        (F.log("accepted_p") - F.log("rejected_p")).alias("gain"))


KINDS = ("rejected", "accepted")


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        chunk = np.asarray(batch.column("chunk"))
        urls = [(u or "").encode() for u in batch.column("url").to_pylist()]
        ends = [0, *(np.flatnonzero(chunk[1:] != chunk[:-1]) + 1).tolist(), len(urls)]
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            if a < b:
                sym, owner = encode(urls[a:b])
                code = np.unique(strings(sym)[owner >= 0])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), chunk[a])), pa.array(code)],
                                                 names=["chunk", "code"])


def url_ratios(rows: DataFrame, cells: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``rows`` (with column url, without chunk and ratio) and ratio: log-likelihood as accepted less that as rejected,
    per symbol."""
    kept = rows.columns

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, urls in pieces([(u or "").encode() for u in batch.column("url").to_pylist()], chunk_bytes):
                number = np.full(len(urls), uuid.uuid4().int >> 65, np.int64)
                yield extended(batch.slice(at, len(urls)), chunk=pa.array(number))

    # chunks are numbered at random, so they are written before anything depends on them
    dealt = cut(rows.mapInArrow(deal, widened(rows.schema, chunk="long")), "url-chunks")
    asked = cut(dealt.select("url", "chunk").mapInArrow(_ask, "chunk long, code long"), "url-strings")
    gains = string_gains(asked.select("code").distinct(), cells)
    told = asked.join(gains, "code")

    def add_up(urls: pa.Table, values: pa.Table) -> pa.Table:
        out = urls.select(kept)
        sym, owner = encode([(u or "").encode() for u in urls.column("url").to_pylist()])
        real = owner >= 0
        code, gain = (np.asarray(values.column(n)) for n in ("code", "gain"))
        order = np.argsort(code, kind="stable")
        at = order[np.searchsorted(code[order], strings(sym)[real])]
        owner = owner[real]
        ratio = np.bincount(owner, gain[at], len(out)) / np.bincount(owner, minlength=len(out))
        return out.append_column("ratio", pa.array(ratio, pa.float64()))

    return (dealt.groupBy("chunk").cogroup(told.groupBy("chunk"))
            .applyInArrow(add_up, widened(rows.schema, ratio="double")))


def platt(x: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve for weighted points (ridge-damped Newton steps)."""
    w = np.zeros(2)
    design, n = np.column_stack([x, np.ones_like(x)]), positive + negative
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (positive - n * p) - 1e-2 * w
        hess = (design * (n * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w += np.clip(step, -10, 10)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit_curve(scored: DataFrame) -> tuple[float, float]:
    """Slope and offset of the curve from rows (ratio, accepted boolean). To the driver go BINS + 1 counts."""
    at = F.floor((F.least(F.greatest("ratio", F.lit(-SPAN)), F.lit(SPAN)) + SPAN) * (BINS / (2 * SPAN)))
    bins = (scored.groupBy(at.alias("bin")).agg(F.sum(F.col("accepted").cast("long")).alias("yes"), F.count("*").alias("n"))
            .orderBy("bin").collect())
    if not bins:
        return 1.0, 0.0
    x = np.array([(r["bin"] + 0.5) * (2 * SPAN / BINS) - SPAN for r in bins])
    yes, n = (np.array([r[k] for r in bins], float) for k in ("yes", "n"))
    return platt(x, yes, n - yes)


def kept_out(url: Column) -> Column:
    """The fifth of the URLs that is not counted, but fits the curve."""
    return F.pmod(F.crc32(F.coalesce(url, F.lit("")).cast("binary")), F.lit(5)) == 0


def judge_urls(df: DataFrame, key: str = "page_id", url: str = "url", rules=RULES,
               threshold: float = 0.5, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """key, url, host, path, rule, score, verdict. URLs that a rule decides are the labelled ones."""
    def ruled(rows: DataFrame) -> DataFrame:
        host, path = split_url(F.col("url"))
        rule, by_rule = match_rules(F.col("host"), F.col("path"), rules)
        return (rows.withColumns({"host": host, "path": path}).withColumns({"rule": rule, "ruled": by_rule})
                .withColumn("accepted", F.col("ruled") == "allow"))

    rows = df.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"))
    cells = cut(count_cells(ruled(rows.select("url")).where(~kept_out(F.col("url")))), "url-cells")
    if all(cells.agg(*[F.sum(kind) for kind in KINDS]).first()):
        scored = ruled(cut(url_ratios(rows, cells, chunk_bytes), "url-ratios"))
        slope, offset = fit_curve(scored.where(kept_out(F.col("url")) & F.col("accepted").isNotNull()))
        power = F.least(F.greatest(F.lit(slope) * F.col("ratio") + F.lit(offset), F.lit(-500.0)), F.lit(500.0))
        scored = scored.withColumn("score", 1 / (1 + F.exp(-power)))
    else:
        scored = ruled(rows).withColumn("score", F.lit(0.5))
    verdict = F.coalesce("ruled", F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    return scored.select(F.col("key").alias(key), "url", "host", "path", "rule", "score", verdict.alias("verdict"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages", "page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("score", 9).alias("score"))
