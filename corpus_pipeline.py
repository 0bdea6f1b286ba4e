"""From raw documents to shards: toxic documents go, one of each group of near
copies stays, documents that hold benchmark passages go, sources are mixed to
their target weights and the mix is dealt to shards.

``run(spark, sf_dir)`` applies all stages; each stage is written as Parquet
under the shared staging folder and read again.  Some stages use methods that
SQL cannot express (a trained classifier, fuzzy hashing, a random shuffle), so
there is no oracle statement; the stages are tested against brute force."""

from __future__ import annotations

from flowstrata.llm.common import fresh, table
from flowstrata.llm.golay import keep_one
from flowstrata.llm.hypershuffle import shuffle_shards
from flowstrata.llm.pfair import mixed
from flowstrata.llm.qgram import without_leaks
from flowstrata.llm.toxfm import score_column, train
from flowstrata.session import stage
from pyspark.sql import functions as F

ORACLE_SQL = None


def toxicity(spark, docs, sf_dir):
    """Documents that the factorization machine scores below 0.5."""
    model = train(docs, table(spark, sf_dir, "labels"))
    name = fresh(docs, "_toxic")
    return docs.withColumn(name, score_column(model, F.col("text"))).where(F.col(name) < 0.5).drop(name)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near copies."""
    return keep_one(docs)


def decontamination(spark, docs, sf_dir):
    """Documents into which no benchmark item leaks."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"), short_items=True)


def mixing(spark, docs, sf_dir):
    """Every document at least once, sources interleaved to tempered shares."""
    return mixed(docs)


def sharding(spark, docs, sf_dir):
    """The mix in shards of equal size, with ``shard`` and ``slot``."""
    return shuffle_shards(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
