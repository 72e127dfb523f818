"""What the operators of this subpackage share.

Operators take a DataFrame and the names of its id and text columns, read only
those, and return columns of their own, so extra input columns never clash.
"""

import sys
import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairflow.session import ensure_checkpoint_dir

LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def saved(df: DataFrame, **options) -> DataFrame:
    """Write ``df`` as Parquet into the session's shared checkpoint folder and
    read it back: cuts the lineage, and a lost executor loses nothing of it."""
    spark = df.sparkSession
    folder = ensure_checkpoint_dir(spark)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{folder}/table-{uuid.uuid4().hex}"
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_SIZES = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Jobs that run inside read Parquet and hand rows to Python by at most ``rows``
    rows at once.  Else a task holds 4096 rows of a file and up to 64 MB on their way
    to Python, both in buffers that double as they grow."""
    before = {k: spark.conf.get(k) for k in BATCH_SIZES}
    try:
        for k in BATCH_SIZES:
            spark.conf.set(k, str(rows))
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def fold(id_col: str, mod: int):
    """crc32 of the id as text, modulo ``mod``; -1 (no fold) for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod, F.lit(-1))


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    names = {c.lower() for c in df.columns}
    while stem.lower() in names:
        stem += "_"
    return stem


def per_process(key, build):
    """Build a model once per Python worker process, not once per task."""
    models = sys.__dict__.setdefault("_pairflow_models", {})
    if key not in models:
        if len(models) >= 4:
            models.clear()
        models[key] = build()
    return models[key]


def strings(series) -> list:
    """A text column's batch as Python strings; null becomes the empty string."""
    return [t if isinstance(t, str) else "" for t in series]


def slices(texts: list, most: int):
    """Consecutive ranges of ``texts`` with about ``most`` characters each."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
