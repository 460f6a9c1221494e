"""A bounded training sample of labelled documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghelm.llm.common import BLANKED, byte_texts, doc_text, document_words, mix64, slices, store


def sketches(texts: list[bytes]) -> np.ndarray:
    """The least hash of three words in a row of each text (of all its words, if fewer)."""
    hashes, words = document_words(texts, BLANKED)
    a, b = np.append(hashes[1:], np.zeros(1, np.uint64)), np.append(hashes[2:], np.zeros(2, np.uint64))
    three = mix64(hashes + mix64(a[: len(hashes)] + mix64(b[: len(hashes)]))) if len(hashes) else hashes
    out, at = np.zeros(len(texts), np.uint64), 0
    for i, n in enumerate(words.tolist()):
        if n:
            out[i] = three[at : at + max(1, n - 2)].min()
        at += n
    return out


def training_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, rows: int) -> DataFrame:
    """label (0 or 1), text of about `rows` labelled documents of the training
    fold, drawn by a hash of the id; near copies, which share their least word
    triple, count once per label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch, "text")
            parts = [sketches(texts[a:b]) for a, b in slices(texts, 1 << 21)]
            made = np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made)], ["label", "text", "sketch"])

    own = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & train)
    own = own.groupBy("doc_id").agg(F.max("label").alias("label"))
    total = own.count()
    parts = 1_000_000
    share = min(parts, rows * parts // max(total, 1))
    chosen = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < share)
    joined = doc_text(docs).join(chosen, "doc_id").select("label", "text")
    made = joined.mapInArrow(run, "label int, text string, sketch long")
    return store(made.dropDuplicates(["label", "sketch"]).select("label", "text"), "training")
