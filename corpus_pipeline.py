"""The corpus pipeline over ``documents``: quality classifier, near-duplicate removal, source mixing, tokenisation.

``STAGES`` lists (name, function) in order. A function takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents, for the rows that go on. ``run`` writes what each stage returns to shared storage
and reads it back for the next, so a lost executor never takes a finished stage with it. An empty table, or one of which
a stage keeps nothing, gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm.bpe import bpe_stage
from rivulet.llm.common import cut
from rivulet.llm.mixing import mixing_stage
from rivulet.llm.quality import quality_stage
from rivulet.llm.similarity_join import dedupe_stage

STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", dedupe_stage),
    ("mixing", mixing_stage),
    ("tokens", bpe_stage),
]

#: dictionaries of a compressor and a file of merge ranks are beyond SQL; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
