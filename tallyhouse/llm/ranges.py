"""Documents in ascending doc_id order without one global sort: range slices of about equal rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_EACH = 4096
MOST_SLICES = 100_000


def slice_bounds(docs: DataFrame, rows_each: int = ROWS_EACH) -> list[int]:
    """Ascending doc_ids at which a new slice starts: at most ``MOST_SLICES`` of them.

    Beyond that slices hold more rows, none is left out.
    """
    n = docs.count()
    slices = min(MOST_SLICES, -(-n // rows_each))
    if slices < 2:
        return []
    shares = [i / slices for i in range(1, slices)]
    accuracy = max(10_000, 20 * slices)
    found = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), shares, accuracy)).first()[0]
    return sorted(set(found or []))


def sliced(docs: DataFrame, bounds: list[int]) -> DataFrame:
    """(slice, doc_id, text) of every row: slices ascend with doc_id, null ids come last."""
    edges = np.array(bounds, np.int64)

    @F.arrow_udf("int")
    def place(ids: pa.Array) -> pa.Array:
        found = np.searchsorted(edges, ids.fill_null(0).to_numpy(zero_copy_only=False), "right")
        last = len(edges) + 1
        return pa.array(np.where(ids.is_null().to_numpy(zero_copy_only=False), last, found), pa.int32())

    key = F.col("doc_id").cast("long")
    return docs.select(place(key).alias("slice"), key.alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
