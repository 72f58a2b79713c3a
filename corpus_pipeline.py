"""The corpus pipeline: documents to packed sequences.

Each stage works on all rows that the stage before kept, written as Parquet in the
shared folder and read again. Toxic documents go, low-quality documents go, one
document of each near-duplicate group stays, documents that hold a benchmark
passage go, and the rest is packed into sequences. The first four stages return the
columns of ``documents``.

A stage's models are learned from the rows that it is given, with the labels of
``sf_dir`` whose id's remainder is not the held-out one.

Defined cases: null and empty texts get their models' base scores and no group of copies; if they stay, they are
packed as one end token. Very long texts are read whole and cut by packing only. Repeated rows of one id
are one group, of which one row stays; of equal texts the smallest id stays; rows without an id are judged by
themselves and all stay. Without labels no row is rejected as toxic, and quality scores are 0.5, which keeps a row. An empty
table passes every stage and gives no sequences. Extra columns stay until packing, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from notecodes.llm import decontaminate, neardup, packing, quality, toxicity
from notecodes.llm.common import staged


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_only(docs, _table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document whose id names the group stays (once, if the row is repeated)."""
    return neardup.group_heads(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_dedup", one_of_each_group),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The first stages are learned models, which SQL cannot express; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
