"""Values of very many documents, found without counting all values."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakflow.llm import text as X

_BLOCK = 1 << 20  # values looked at together


def frequent(docs: DataFrame, values_of: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], share: float = 0.005) -> np.ndarray:
    """Hashed values (sorted, as longs) that about `share` of the documents have or more.

    `values_of` gives (text, value) of a text column. Values are counted within blocks of documents;
    those frequent in a block are added up. The list is bounded: each value in it has half that share of the
    documents at least, so there are at most twice a mean document's values, divided by the share.
    It only steers work (what is salted or ranked last), never what is found."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs_held = [], 0

        def found():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            often = n > max(4, share * docs_held)
            return pa.record_batch([pa.array(X.signed(values[often])), pa.array(n[often])], names=["h", "n"])

        for part in X.slices(batches):
            text, values = values_of(part.column("text"))
            if len(values):
                order = np.lexsort((values, text))
                new = np.ones(len(order), bool)
                new[1:] = (text[order][1:] != text[order][:-1]) | (values[order][1:] != values[order][:-1])
                held.append(values[order][new])
            docs_held += part.num_rows
            if sum(map(len, held)) >= _BLOCK:
                yield found()
                held, docs_held = [], 0
        if held:
            yield found()

    local = docs.select("text").mapInArrow(count, "h long, n long")
    least = max(4.0, share * docs.count() / 2)
    hot = local.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > least).select("h")
    return np.sort(np.array([r.h for r in hot.collect()], np.int64))
