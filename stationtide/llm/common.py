"""Small helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stationtide.session import scratch_path

FOLDS = 5  # rows whose crc32(id) mod FOLDS is 0 are held out


def importable_on_workers(spark: SparkSession) -> None:
    """Let Python workers that share this file system import the package, whatever folder the driver was started in."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column | str) -> Column:
    """True where crc32 of the id as text is divisible by FOLDS; rows without an id are held out too."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ids_and_texts(batch, id_column: str = "doc_id", text_column: str = "text", max_chars: int = 4_000_000) -> Iterator[tuple]:
    """(ids as an Arrow array, texts as a list) in slices of about ``max_chars``, so that memory follows the slice and
    not the batch. A text of any length stays whole; null texts come as None."""
    ids, texts = batch.column(id_column), batch.column(text_column)
    start, n = 0, 0
    out: list = []
    for i in range(len(texts)):
        text = texts[i].as_py()
        out.append(text)
        n += len(text) if text else 0
        if n >= max_chars:
            yield ids.slice(start, len(out)), out
            start, n, out = i + 1, 0, []
    if out:
        yield ids.slice(start, len(out)), out


def keep_rows(docs: DataFrame, decide: Callable[[list], np.ndarray], text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` for whose texts ``decide`` gives True, all columns as they are; no shuffle and no key is needed.
    ``decide`` gets lists of whole texts, null as None."""
    # An Arrow map looks its columns up by name, which names with dots do not survive.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = f"c{docs.columns.index(text_column)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for _, texts in ids_and_texts(batch, text, text, 1_000_000):
                yield batch.slice(at, len(texts)).filter(pa.array(np.asarray(decide(texts), bool)))
                at += len(texts)

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
