"""Posting lists as bitmaps, and Boolean AND by intersecting them.

A word's documents are one bitmap for each range of 32,768 ids that holds any
(Spark's ``bitmap_*`` functions: 4 KB). Most words have one document in a range, so
a posting is sent as its place in the range, and bitmaps are built where the places
have met, one at a time: of 4 KB rows none is shuffled or sorted. A (word, range)
holds 32,768 places at most. The lists of a query's words meet by (query, range) and are intersected by
``bitmap_and_agg``, again combined before the shuffle, so what crosses the
network is bounded by the ranges, however long a list is. Only ranges that all
words have are kept, and only non-empty intersections are turned back into ids.

Document ids must be whole numbers; null ids have no bitmap.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.operators.query import hot_join, is_small

# Workers need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Ids of a range.
RANGE = 32_768


def posting_bitmaps(postings: DataFrame) -> DataFrame:
    """(term, range, bits, n): the documents of every word, by range of ids."""
    ids = postings.where(F.col("doc_id").isNotNull()).select("term", F.col("doc_id").cast("long").alias("doc_id"))
    at = ids.select("term", F.bitmap_bucket_number("doc_id").alias("range"),
                    F.bitmap_bit_position("doc_id").cast("int").alias("bit"))
    bits = F.bitmap_construct_agg(F.col("bit").cast("long"))
    return (at.repartition("term", "range").groupBy("term", "range").agg(bits.alias("bits"))
              .withColumn("n", F.bitmap_count("bits")))


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps as rows of ids: range r over 0 holds the ids from
    (r - 1) * RANGE + 1 up, the others those from r * RANGE down."""
    for batch in batches:
        for q, r, raw in zip(*(batch.column(c).to_pylist() for c in range(3))):
            at = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little"))
            docs = (r - 1) * RANGE + 1 + at if r > 0 else r * RANGE - at
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(docs), q, np.int64)),
                                              pa.array(docs.astype(np.int64))], names=["query_id", "doc_id"])


def bitmap_and(bitmaps: DataFrame, qterms: DataFrame) -> DataFrame:
    """(query_id, doc_id): documents holding every word of the query.
    ``bitmaps`` as from ``posting_bitmaps``, each (term, range) once."""
    q = qterms.select(F.col("query_id").cast("long").alias("query_id"), "term", "n_terms")
    hits = hot_join(bitmaps.select("term", "range", "bits"), q, "term", small=is_small(q))
    met = hits.groupBy("query_id", "range", "n_terms").agg(F.bitmap_and_agg("bits").alias("bits"),
                                                          F.count(F.lit(1)).alias("m"))
    met = met.where((F.col("m") == F.col("n_terms")) & (F.bitmap_count("bits") > 0))
    return met.select("query_id", "range", "bits").mapInArrow(_ids, "query_id long, doc_id long")
