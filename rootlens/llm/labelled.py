"""A bounded, repeatable sample of labelled texts for training a small model."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootlens.llm.frames import small_batches


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    rows_per_class: int,
    max_chars: int | None,
    allowed: Column,
    reduced: Callable[[str], Any] | None = None,
) -> dict[int, list]:
    """For each label value 0 and 1, at most ``rows_per_class`` texts, whole or of at most
    ``max_chars`` characters; or what ``reduced`` makes of each text, within the tasks.

    ``docs`` has doc_id and text, ``labels`` doc_id and the label; ``allowed``
    is a condition on doc_id. Of an id that is labelled twice, the larger label
    holds; of an id with several texts, the smallest text. Rows with a null id, label
    or text are not used. Only the sampled ids, whose number is bounded, are
    broadcast to the texts.
    """
    known = docs.filter(F.col("text").isNotNull() & allowed).select("doc_id").dropna()
    truth = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .dropna()
        .filter(F.col("label").isin(0, 1) & allowed)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .join(known, "doc_id", "left_semi")
    )
    order = (F.xxhash64(F.col("doc_id"), F.lit(label)), F.col("doc_id"))
    picked = None
    for value in (0, 1):
        part = truth.filter(F.col("label") == value).orderBy(*order).limit(rows_per_class)
        picked = part if picked is None else picked.unionByName(part)
    rows = (
        docs.select("doc_id", "text" if max_chars is None else F.substring("text", 1, max_chars).alias("text"))
        .dropna()
        .join(F.broadcast(picked), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.min("text").alias("text"))
    )
    if reduced:
        small_batches(docs)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column("text").cast(pa.large_binary()).to_pylist()
                made = [pickle.dumps(reduced(t.decode("utf-8", "replace"))) for t in texts]
                columns = [batch.column("doc_id"), batch.column("label"), pa.array(made, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "text"])

        rows = rows.mapInArrow(run, rows.select("doc_id", "label").schema.add("text", "binary"))
    out: dict[int, list] = {0: [], 1: []}
    for row in rows.orderBy(*order).collect():
        out[row["label"]].append(pickle.loads(row["text"]) if reduced else row["text"])
    return out
