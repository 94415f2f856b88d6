"""Run a Python function over the texts of a table, slice by slice."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_CHARS = 1_000_000

TYPES = {"long": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
         "array<double>": pa.list_(pa.float64()), "array<int>": pa.list_(pa.int32())}


def slices(texts: list, limit: int = SLICE_CHARS):
    """Bounds of consecutive slices of about ``limit`` characters (or one longer text)."""
    at, size = 0, 0
    for k, t in enumerate(texts):
        n = len(t) + 100
        if size and size + n > limit:
            yield at, k
            at, size = k, 0
        size += n
    if at < len(texts):
        yield at, len(texts)


def over_texts(docs: DataFrame, id_col: str, text_col: str, make: Callable, columns: dict[str, str],
               limit: int = SLICE_CHARS, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id and ``columns`` (name -> type) for every document.

    ``make()`` runs once a task and returns a function from a list of texts
    (null as empty), and the values of each column in ``also``, to a dict of
    equally long lists.  Ids pass through as they are; memory holds one slice
    of about ``limit`` characters.
    """
    def run(batches):
        function = make()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, z in slices(texts, limit):
                got = function(texts[a:z], *(batch.column(2 + k).slice(a, z - a).to_pylist() for k in range(len(also))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, z - a), *(pa.array(got[c], TYPES[t]) for c, t in columns.items())], ["doc_id", *columns])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"), *(F.col(c).alias(f"a{k}") for k, c in enumerate(also))).mapInArrow(
        run, ", ".join([f"doc_id {kind}", *(f"{c} {t}" for c, t in columns.items())]))
