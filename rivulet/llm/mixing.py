"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells by source, language and topic; a cell's weight starts as its number of tokens. Raking scales
the cells so that the sums over each source meet the sources' target, then the languages', then the topics', and again,
``ROUNDS`` times at least and until no sum was more than ``TOLERANCE`` off its target in a whole round. Targets that no
weights meet together stop the rounds when these change nothing any more (or after ``MOST_ROUNDS``); the sums that then
miss their targets are logged as a warning. A document is kept with its cell's probability (fitted weight per token, divided by the largest such
ratio, so that no probability passes 1), by a uniform number made from a hash of its id: the expected tokens then have
the target marginals.

Where one rare cell would set the scale so low that fewer than ``BUDGET`` of all tokens are expected, the scale is set by
that budget instead: a cell's probability ends at 1, values that have too few tokens for their target give all they
have, the others share the rest by their targets, and the cells are raked again within these bounds. The expected tokens
are then ``BUDGET`` of all (or all that have targets, if these are fewer), and the targets missed are logged. The stage
of the pipeline does so; ``op7_mixing`` has no budget, as its SQL divides by the largest ratio in any case.

Only DataFrame operations are used. Documents are reduced to cells by a partial aggregate, so a source with a third of
the rows costs one row per task and cell. A cell carries its values' targets, and a round is one window sum over the
cells per dimension, without a join; every few rounds are written to shared storage.
Documents meet the cells' probabilities in one join with that small table, which moves no document when the planner
finds it small enough to broadcast.

Targets are given per dimension as the power of the observed share (``TEMPER``: 1 keeps the shares, 0 makes them even),
or as a table (value, target). Values with no tokens, or that the target leaves out or gives nothing, have weight 0 and
are not sampled; the other values share the total by their targets.

Defined results: a null source, language or topic is a value like any other. A null or empty text has no tokens; it
counts for no weight and is kept with its cell's probability (0 for a cell without tokens). Rows with equal ids get the
same uniform number; a null id counts as the empty text in the hash. An empty table gives an empty result.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from rivulet.llm.common import cut, packed, table

DIMENSIONS = ("source", "lang", "topic")
ROUNDS = 12
#: largest relative error of a marginal that counts as met
TOLERANCE = 0.01
MOST_ROUNDS = 1000
#: rounds that make one plan
CUT_ROUNDS = 3
#: share of all tokens that the sample is expected to have at least
BUDGET = 0.25
#: misses named in a warning, per fit
NAMED = 20
TEMPER = 0.5
#: white space between words
GAP = r"[\x20\x09-\x0D]+"

log = logging.getLogger(__name__)


def n_words(text: Column) -> Column:
    """Tokens that weights count: words [^\\x20\\x09-\\x0D]+."""
    clean = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), GAP, " "))
    return F.when(clean == "", 0).otherwise(1 + F.char_length(clean) - F.char_length(F.replace(clean, F.lit(" "),
                                                                                             F.lit(""))))


def text_topic(text: Column) -> Column:
    """documents has no topic, so the query takes the kind of text by its code points for one: note (under 900),
    article (under 1800), report (under 3500) or book."""
    size = F.char_length(F.coalesce(text, F.lit("")))
    return F.when(size < 900, "note").when(size < 1800, "article").when(size < 3500, "report").otherwise("book")


def uniform(key: Column) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    return F.conv(F.substr(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(1), F.lit(12)), 16,
                  10).cast("double") / float(16 ** 12)


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def over(name: str) -> WindowSpec:
    """All cells with the same value of a dimension."""
    return Window.partitionBy(name)


def target(name: str) -> str:
    """The column that holds the target of a cell's value."""
    return f"target_{name}"


def targets_of(cells: DataFrame, dimension: str, temper: float) -> DataFrame:
    """(value, target): each value's share of the tokens, to the power of ``temper``; only ratios matter."""
    return (cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").alias("sum")).where("sum > 0")
            .select("value", F.pow(F.col("sum").cast("double"), F.lit(temper)).alias("target")))


def reachable(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """cells with weight (their tokens, 0 where a value has no target) and each value's target, 0 for values without
    weight; each dimension's targets add up to the total of all tokens."""
    now = cells
    for name, rows in targets.items():
        rows = rows.where("target > 0").select(F.col("value").alias("_value"), F.col("target").alias(target(name)))
        now = (now.join(rows, same(F.col(name), F.col("_value")), "left").drop("_value")
               .withColumn(target(name), F.coalesce(target(name), F.lit(0.0))))
    meant = F.least(*[F.col(target(n)) for n in targets], F.lit(1.0)) > 0
    now = now.withColumn("weight", F.when(meant, F.col("tokens").cast("double")).otherwise(0.0))
    for name in targets:
        there = F.sum("weight").over(over(name)) > 0
        now = now.withColumn(target(name), F.when(there, F.col(target(name))).otherwise(0.0))
    now = cut(now, "mix-cells")
    total = now.agg(F.sum("tokens").alias("all")).first()["all"] or 0
    return now.withColumns({target(n): F.col(target(n)) * (float(total) / (sum_of(values_of(now, n), "target") or 1.0))
                            for n in targets})


def values_of(cells: DataFrame, name: str) -> DataFrame:
    """(value, target, sum, room): the values of a dimension, their weights and the tokens that have weight."""
    return (cells.groupBy(F.col(name).alias("value")).agg(
        F.max(target(name)).alias("target"), F.sum("weight").alias("sum"),
        F.sum(F.when(F.col("weight") > 0, F.col("tokens")).otherwise(0)).cast("double").alias("room")))


def sum_of(rows: DataFrame, column: str) -> float:
    return rows.agg(F.sum(column).alias("all")).first()["all"] or 0.0


def warn_of_misses(cells: DataFrame, dimensions: list[str]) -> None:
    """Log the targets that the cells' weights miss by more than TOLERANCE."""
    far = F.abs(F.col("sum") - F.col("target"))
    rows = [values_of(cells, n).where(far > TOLERANCE * F.col("target")).select(
        F.lit(n).alias("dimension"), F.col("value").cast("string").alias("value"), "target", "sum") for n in dimensions]
    worst = reduce(DataFrame.unionByName, rows).orderBy(F.desc(far)).limit(NAMED + 1).collect()
    if worst:
        log.warning("mixing: targets are not met: %s%s", "; ".join(
            f"{r['dimension']} {r['value']}: {r['sum']:.6g} of {r['target']:.6g}" for r in worst[:NAMED]),
            " and others" if len(worst) > NAMED else "")


def one_round(cells: DataFrame, dimensions: list[str], bound: bool) -> DataFrame:
    """Scaled to each dimension's targets in turn; off: the largest relative error that was met on the way."""
    now = cells.withColumn("off", F.lit(0.0))
    for name in dimensions:
        # if bound, a cell counts with no more than its tokens, but keeps its weight for the next rounds
        counted = F.least("weight", F.col("tokens").cast("double")) if bound else F.col("weight")
        now = now.withColumn("_sum", F.sum(counted).over(over(name)))
        factor = F.when(F.col("_sum") > 0, F.col(target(name)) / F.col("_sum")).otherwise(0.0)
        grown = F.col("weight") * factor
        now = now.withColumns({
            "weight": F.least(grown, F.col("tokens") * 1e9) if bound else grown,
            "off": F.greatest("off", F.when(factor > 0, F.abs(1 / factor - 1)).otherwise(0.0))})
    return now.drop("_sum")


def fit(cells: DataFrame, dimensions: list[str], rounds: int, bound: bool = False) -> DataFrame:
    """cells (``reachable``) scaled to their targets, as often as the docstring above says. CUT_ROUNDS rounds are one
    plan of windows over the cells, without joins, and end in shared storage."""
    now, before, done = cells, None, 0
    while done < max(rounds, MOST_ROUNDS):
        for _ in range(min(CUT_ROUNDS, max(rounds - done, 1)) if done < rounds else CUT_ROUNDS):
            now, done = one_round(now, dimensions, bound), done + 1
        now = cut(now, "mix-cells")
        if done >= rounds:
            off = now.agg(F.max("off").alias("off")).first()["off"] or 0.0
            if off <= TOLERANCE:
                break
            if (done - rounds) % ROUNDS == 0:
                if before is not None and off > 0.999 * before:
                    break
                before = off
    return now.drop("off")


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """cells (the dimensions, tokens) with weight: fitted to all targets, each scaled to the total of all tokens."""
    now = fit(reachable(cells, targets), list(targets), rounds)
    warn_of_misses(now, list(targets))
    return now


def level(rows: DataFrame, amount: float) -> float:
    """The factor by which the targets of rows (target, room), each ended at its room, add up to ``amount``."""
    found = 0.0
    while True:
        full = F.col("target") * found >= F.col("room")
        r = rows.agg(F.sum(F.when(full, F.col("room")).otherwise(0.0)).alias("full"),
                     F.sum(F.when(full, 0.0).otherwise(F.col("target"))).alias("rest")).first()
        if not r["rest"] or (amount - r["full"]) / r["rest"] <= found * (1 + 1e-12):
            return found
        found = (amount - r["full"]) / r["rest"]


def saturated(cells: DataFrame, dimensions: list[str], amount: float, rounds: int) -> DataFrame:
    """Fitted cells with weights of at most their tokens that add up to ``amount`` and come as near to the targets as
    that allows."""
    now = cells.withColumn("weight", F.col("weight") * (amount / sum_of(cells, "weight")))
    wanted = {}
    for name in dimensions:
        rows = cut(values_of(cells, name).where("room > 0"), "mix-target")
        scale = amount / sum_of(rows, "target")
        wanted[f"wanted_{name}"] = F.col(target(name)) * scale
        room = F.sum(F.when(F.col("weight") > 0, F.col("tokens")).otherwise(0)).over(over(name)).cast("double")
        now = now.withColumn(f"wanted_{name}", wanted[f"wanted_{name}"]).withColumn(
            target(name), F.least(F.col(f"wanted_{name}") * level(rows.withColumn("target", F.col("target") * scale), amount),
                                  room))
    now = fit(cut(now, "mix-cells"), dimensions, rounds, bound=True)
    room = F.col("tokens").cast("double")
    scale = level(now.where("weight > 0").select(F.col("weight").alias("target"), room.alias("room")), amount)
    now = cut(now.withColumns({"weight": F.least(F.col("weight") * scale, room),
                               **{target(n): F.col(f"wanted_{n}") for n in dimensions}}), "mix-cells")
    warn_of_misses(now, dimensions)
    return now


def cell_chances(rows: DataFrame, dimensions: list[str], temper: float = TEMPER,
                 targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS,
                 budget: float = BUDGET) -> DataFrame:
    """(of_<dimension>..., probability) per cell of rows (the dimensions, tokens)."""
    cells = cut(rows.groupBy(*dimensions).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    given = targets or {}
    fitted = fit(reachable(cells, {n: given.get(n) or targets_of(cells, n, temper) for n in dimensions}), dimensions,
                 rounds)
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    of_all = fitted.agg(F.max(ratio).alias("most"), F.sum("weight").alias("weight"), F.sum("tokens").alias("tokens"),
                        F.sum(F.when(F.col("weight") > 0, F.col("tokens"))).alias("there")).first()
    most = of_all["most"] or 1.0
    amount = min(budget * float(of_all["tokens"] or 0), float(of_all["there"] or 0))
    if (of_all["weight"] or 0.0) / most < amount * (1 - 1e-9):
        fitted, most = saturated(fitted, dimensions, amount, rounds), 1.0
    else:
        warn_of_misses(fitted, dimensions)
    return cut(fitted.select(*[F.col(n).alias(f"of_{n}") for n in dimensions],
                             (ratio / F.lit(most)).alias("probability")), "mix-chances")


def in_cell(dimensions: dict[str, Column]) -> Column:
    """Whether a document belongs to a cell of ``cell_chances``."""
    meet = F.lit(True)
    for name, value in dimensions.items():
        meet = meet & same(value, F.col(f"of_{name}"))
    return meet


def mix(docs: DataFrame, key: str, tokens: Column, dimensions: dict[str, Column], temper: float = TEMPER,
        targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS, budget: float = BUDGET) -> DataFrame:
    """One row per row of docs: key, the dimensions, tokens, probability, kept."""
    rows = cut(docs.select(F.col(key).alias("_key"), *[c.alias(n) for n, c in dimensions.items()],
                           tokens.cast("long").alias("tokens")), "mix-documents")  # texts are read once
    chance = cell_chances(rows, list(dimensions), temper, targets, rounds, budget)
    return (rows.join(chance, in_cell({n: F.col(n) for n in dimensions}), "left")
            .select(F.col("_key").alias(key), *dimensions, "tokens",
                    F.coalesce("probability", F.lit(0.0)).alias("probability"))
            .withColumn("kept", uniform(F.col(key)) < F.col("probability")))


def document_dimensions() -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": text_topic(F.col("text"))}


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    return (mix(docs, "doc_id", n_words(F.col("text")), document_dimensions(), budget=0.0)
            .withColumn("probability", F.round("probability", 6)))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled documents: rows whose id's uniform number is under the probability of their own cell."""
    own = document_dimensions()
    rows, back = packed(docs, "doc_id", "text", "source", "lang")
    chance = cell_chances(docs.select(*[c.alias(n) for n, c in own.items()], n_words(F.col("text")).cast("long")
                                      .alias("tokens")), list(own))
    return rows.join(chance, in_cell(own)).where(uniform(F.col("doc_id")) < F.col("probability")).select(*back)


def _sql() -> str:
    text = "coalesce(text, '')"
    clean = rf"trim(regexp_replace({text}, '[\x20\x09-\x0D]+', ' ', 'g'))"
    steps = [f"""
docs AS (SELECT doc_id, source, lang,
  CASE WHEN length({text}) < 900 THEN 'note' WHEN length({text}) < 1800 THEN 'article'
       WHEN length({text}) < 3500 THEN 'report' ELSE 'book' END AS topic,
  CASE WHEN {clean} = '' THEN 0 ELSE 1 + length({clean}) - length(replace({clean}, ' ', '')) END::BIGINT AS tokens
  FROM documents)""",
             """
cells AS (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM docs GROUP BY ALL),
w0 AS MATERIALIZED (SELECT *, tokens::DOUBLE AS weight FROM cells)"""]
    for n in DIMENSIONS:
        steps.append(f"""
t_{n} AS MATERIALIZED (SELECT {n} AS value, sqrt(sum(tokens)::DOUBLE) AS t FROM cells GROUP BY 1 HAVING sum(tokens) > 0)""")
    i = 0
    for _ in range(ROUNDS):
        for n in DIMENSIONS:
            steps.append(f"""
w{i + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens, weight * coalesce((SELECT t FROM t_{n} WHERE value IS NOT DISTINCT FROM {n})
  * ((SELECT sum(tokens) FROM cells) / (SELECT sum(t) FROM t_{n})), 0) / nullif(sum(weight) OVER (PARTITION BY {n}), 0) AS weight FROM w{i})""")
            i += 1
    return "WITH " + ",".join(steps) + f""",
chance AS (SELECT source, lang, topic, coalesce(weight / nullif(tokens, 0), 0) AS ratio FROM w{i}),
chosen AS (SELECT d.doc_id, d.source, d.lang, d.topic, d.tokens,
  coalesce(ratio / (SELECT max(ratio) FROM chance), 0) AS p,
  ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '')), 1, 12))::BIGINT / {16 ** 12}.0 AS u
  FROM docs d LEFT JOIN chance c ON d.source IS NOT DISTINCT FROM c.source AND d.lang IS NOT DISTINCT FROM c.lang
   AND d.topic IS NOT DISTINCT FROM c.topic)
SELECT doc_id, source, lang, topic, tokens, round(p, 6) AS probability, u < p AS kept FROM chosen"""


SQL = _sql()
