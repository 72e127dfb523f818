"""A corpus from raw documents: language, toxicity, near-duplicates, packing.

Each stage takes the documents that the stage before kept and returns
documents; the last returns their places in training sequences.  A stage's
result is written as Parquet and read again by the next.

Defined results, for every stage: whole texts are read, however long; further
columns are kept and may have any name; an empty table stays empty.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairflow.llm import langid, packing, simhash, toxicity
from pairflow.llm.base import fresh, labels
from pairflow.session import ensure_checkpoint_dir

LEAST_HIT = 0.3  # share of a text's trigrams that its best language must hold
MOST_TOXIC = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter (null texts too) and those too few of
    whose trigrams occur in any language.  Without a single labelled document
    there is nothing to decide by, and all stay.  Repeated rows stay or go
    together; ties between languages decide nothing."""
    model = langid.train(docs)
    if not model["names"]:
        return docs
    p = fresh(docs, "_lang")
    found = langid.predict(model, docs, out=p)
    good = (F.col(f"{p}.lang") != langid.UNDETERMINED) & (F.col(f"{p}.hit") >= LEAST_HIT)
    return found.where(good).drop(p)


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are toxic with a probability of ``MOST_TOXIC`` or more.
    Null and empty texts have the least probability and stay; null ids are
    judged by their text like others; repeated rows stay or go together."""
    model = toxicity.train(docs, labels(spark, sf_dir))
    p = fresh(docs, "_toxic")
    found = docs.withColumn(p, toxicity.score(model, spark, F.col("text")))
    return found.where(toxicity.probability(model, F.col(p)) < MOST_TOXIC).drop(p)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: that of the smallest
    id, null ids last; of repeated rows any one.  Texts without words (null,
    empty) are one group."""
    return simhash.one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents in sequences.  A null or empty text is one
    token; a text longer than a sequence takes several; repeated rows each get
    their places; of equal sizes the earlier row goes first."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language),
    ("toxicity", harmless),
    ("SimHash near-dedup", distinct),
    ("best-fit packing", packed),
]

# The stages learn models and pack by input split; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs.write.parquet(f"{folder}/{i}")
        docs = spark.read.schema(docs.schema).parquet(f"{folder}/{i}")
    return docs
