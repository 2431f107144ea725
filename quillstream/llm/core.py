"""Shared vectorised text helpers and the materialisation helper."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the white space of the word definition, U+0020 and U+0009-U+000D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
#: Bytes of text handled at once; a longer document is handled alone.
CHUNK = 1 << 19
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i (mod 2**64) for i < n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * CHUNK)
        up, down = np.full(size, BASE), np.full(size, _INV)
        up[0] = down[0] = 1
        _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x * np.uint64(0x94D049BB133111EB)


class Hasher:
    """Hashes of any slice of a symbol array, through prefix sums of a polynomial."""

    def __init__(self, symbols: np.ndarray):
        up, self.down = powers(len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def byte_symbols(data: np.ndarray) -> np.ndarray:
    return _BYTES[data]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string column; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = CHUNK):
    """Ranges (i, j) of documents of about `most` bytes together."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each document the index of its first word (n + 1)."""
    inside = ~space[data]
    begins, last = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def owners(bounds: np.ndarray) -> np.ndarray:
    """The document of each symbol, from the first symbol of each."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def spans_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Only a local session may do without; it gets one below the warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return found or spark.conf.get("spark.sql.warehouse.dir") + "/checkpoints"


#: Has Spark remove the shuffle files of a finished query, so that finished phases do not fill the disks.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, codec: str = "zstd", by: Sequence[str] = ()) -> DataFrame:
    """The rows as a table in the shared folder, partitioned `by` columns, which outlives executors and cuts the lineage."""
    spark, schema = df.sparkSession, df.schema
    path = f"{shared_folder(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", codec).partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(schema).parquet(path)
    out._written = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Removes written tables that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_written", None):
            there = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            there.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(there, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(d, h, t): the id (null as the largest), a hash that tells apart rows of one id, the text (null as empty)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col), F.lit((1 << 63) - 1)).cast("long").alias("d"), F.xxhash64(text).alias("h"), text.alias("t"))
