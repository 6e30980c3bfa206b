"""What the operators have in common: reading tables, stored intermediates, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.files import fresh_path

# Text bytes of one slice that Python code works on at a time; a longer text is a slice of its own.
SLICE_BYTES = 8 << 20


def col(name: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the id (long) and the text (null: empty), whatever else the table holds."""
    return docs.select(col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(col(text).cast("string"), F.lit("")).alias("text"))


def stored(df: DataFrame, label: str, file_rows: int = 0) -> DataFrame:
    """The table, written to the shared folder and read again; a lost executor costs no more
    than the step that read it. Files of at most ``file_rows`` rows, if given, are read by more
    tasks."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to a bounded number of text bytes; rows stay in order."""
    for batch in batches:
        start = size = 0
        for i, n in enumerate(pc.binary_length(batch.column(text)).to_pylist()):
            if size + (n or 0) > most and i > start:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)
        # what was freed meanwhile would stay with this worker, beside the memory of later stages
        pa.default_memory_pool().release_unused()


SPACES = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def split_words(raws: list[bytes], more=None) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, as ``bytes.split`` cuts them, and how many each text has.

    ``more(data, space, begins)`` may give further places where a word begins: a mask of the
    bytes, from the bytes of all texts, which of them are white space, and where texts begin.
    """
    data = np.frombuffer(b"".join(raws), np.uint8)
    sizes = np.array([len(r) for r in raws], np.int64)
    ends = np.cumsum(sizes)
    begins = np.zeros(len(data) + 1, bool)
    begins[ends - sizes] = True
    space = SPACES[data]
    start = ~space
    start[1:] &= space[:-1] | begins[1:-1]
    if more is not None:
        start |= more(data, space, begins)
    at = np.flatnonzero(start)
    body = data[~space]
    before = np.cumsum(~space, dtype=np.int64)[at] - 1  # places among the bytes of words
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at),
        [None, pa.py_buffer(np.append(before, len(body))), pa.py_buffer(body)])
    return words, np.diff(np.searchsorted(at, ends), prepend=0)


class Memory:
    """What is known about keys, in two generations, so that keys in use outlast a bounded size."""

    def __init__(self, most: int):
        self.half = most // 2
        self.young: dict = {}
        self.old: dict = {}

    def missing(self, keys) -> list:
        """The keys to be worked out; all others can now be looked up in ``young``."""
        if len(self.young) > self.half:
            self.old, self.young = self.young, {}
        young, old, out = self.young, self.old, []
        for k in keys:
            if k not in young:
                if k in old:
                    young[k] = old[k]
                else:
                    out.append(k)
        return out


class Shipped:
    """A file's bytes (a vocabulary, of bounded size) and what a worker makes of them, once."""

    def __init__(self, spark: SparkSession, path: str, make):
        with open(path, "rb") as f:
            self.data = spark.sparkContext.broadcast(f.read())
        self.make = make

    def get(self):
        return _made(self.make, self.data.value)


@lru_cache(maxsize=4)
def _made(make, data):
    return make(data)
