"""Operator 9: token counts of documents in flat token files, by a separator scan.

A token file is a run of little-endian uint16 ids, each document closed by the end-of-document id, cut into blocks
of fixed size without any index. Each block is searched for separators in one vectorised comparison. Window sums
over the blocks of a file (a prefix scan) stitch the borders: how many separators and ids came before, and where
the last separator was. A document that spans blocks is thus counted once. A second flat file holds the documents'
ids in order, without lengths.

Nulls: a null text counts as empty, with 0 tokens; null and repeated ids keep a row each. An empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import core, tokens

FILES = "file long, block int, part string, data binary"
NO_ID = -(1 << 63)


def write_token_files(docs: DataFrame, block_tokens: int = 1 << 18, ranks_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token files of all documents, in the shared folder: a file for each input split, a row for each block."""
    ranks_path = ranks_path or tokens.default_ranks()

    def run(batches):
        context = TaskContext.get()
        file = context.partitionId() if context else 0
        kept: dict[str, list] = {"tokens": [], "names": []}
        held, done = {"tokens": 0, "names": 0}, {"tokens": 0, "names": 0}
        most = {"tokens": block_tokens, "names": 1 << 15}

        def blocks(last=False):
            for part in kept:
                if held[part] >= most[part] or last and held[part]:
                    flat = np.concatenate(kept[part])
                    for i in range(0, len(flat) if last else len(flat) - len(flat) % most[part], most[part]):
                        yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([done[part]], pa.int32()), pa.array([part]), pa.array([flat[i : i + most[part]].tobytes()], pa.binary())], names=["file", "block", "part", "data"])
                        done[part] += 1
                    rest = flat[len(flat) - len(flat) % most[part] :]
                    kept[part], held[part] = [rest], len(rest)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = np.append(tokens.ids(text.as_py(), ranks_path, special=False), tokens.END_ID).astype("<u2")
                kept["tokens"].append(found)
                kept["names"].append(np.array([NO_ID if doc is None else doc], "<i8"))
                held["tokens"] += len(found)
                held["names"] += 1
                yield from blocks()
        yield from blocks(last=True)

    return core.written(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, FILES))


def count_tokens(files: DataFrame, separator: int = tokens.END_ID) -> DataFrame:
    """(file, ordinal, n_tokens) of each document, without its separator."""

    def scan(batches):
        for batch in batches:
            flat = [np.frombuffer(x.as_buffer(), "<u2") for x in batch.column("data")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), pa.array([len(x) for x in flat], pa.int64()), pa.array([np.flatnonzero(x == separator) for x in flat], pa.list_(pa.int64()))], names=["file", "block", "n", "ends"]
            )

    found = files.where("part = 'tokens'").select("file", "block", "data").mapInArrow(scan, "file long, block int, n long, ends array<long>")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = found.withColumns({"base": F.coalesce(F.sum("n").over(before), F.lit(0)), "ordinal0": F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0))})
    placed = placed.withColumn("open", F.coalesce(F.max(F.when(F.size("ends") > 0, F.col("base") + F.element_at("ends", -1) + 1)).over(before), F.lit(0)))
    each = placed.select("file", "base", "ordinal0", "open", "ends", F.posexplode("ends").alias("k", "at"))
    from_ = F.when(F.col("k") == 0, F.col("open")).otherwise(F.col("base") + F.expr("element_at(ends, k)") + 1)
    return each.select("file", (F.col("ordinal0") + F.col("k")).alias("ordinal"), (F.col("base") + F.col("at") - from_).alias("n_tokens"))


def names_in_order(files: DataFrame, per_block: int = 1 << 15) -> DataFrame:
    def run(batches):
        for batch in batches:
            for file, block, data in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("data"), strict=True):
                flat = np.frombuffer(data.as_buffer(), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), file)), pa.array(block * per_block + np.arange(len(flat))), pa.array(flat, mask=flat == NO_ID)], names=["file", "ordinal", "doc_id"])

    return files.where("part = 'names'").select("file", "block", "data").mapInArrow(run, "file long, ordinal long, doc_id long")


def document_token_counts(docs: DataFrame, block_tokens: int = 1 << 18, ranks_path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of every document, by writing its ids to token files and scanning these."""
    files = write_token_files(docs, block_tokens, ranks_path)
    return names_in_order(files).join(count_tokens(files), ["file", "ordinal"]).select("doc_id", "n_tokens")
