"""Token counts of flat token files by a scan for separators.

A flat file is nothing but token ids, 16 bits each, with an end-of-document id behind each document;
there is no index. The file is read in blocks by many tasks. A block reports its separators; a
prefix scan over the blocks' reports gives the number of documents and the last separator before
each block, which joins documents that cross blocks.
"""

from __future__ import annotations

import base64
import os
import re
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.frames import binaries, column, record, slices
from tidemark.session import scratch_path, stored

BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.tiktoken")
END = 50_256
KIND = "<u2"
BLOCK_BYTES = 4 << 20


@cache
def byte_encoding(model: str = BYTE_MODEL) -> tiktoken.Encoding:
    with open(model, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or URI."""
    path = re.sub(r"^file:/+", "/", path)
    if "://" in path:
        return pyarrow.fs.FileSystem.from_uri(path)
    return pyarrow.fs.LocalFileSystem(), os.path.abspath(path)


def write_flat(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", model: str = BYTE_MODEL) -> DataFrame:
    """Write the ids of all documents to flat files, one per task, and return which document went where.

    Columns ``doc_id``, ``file``, ``ordinal``. A task that runs again writes a file of another name,
    so only files that are named here count. A null text is empty; each row is a document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, out, n = byte_encoding(model), None, 0
        name = f"part-{uuid.uuid4().hex}.bin"
        for batch in slices(batches, "text"):
            if out is None:
                system, base = _place(folder)
                system.create_dir(base, recursive=True)
                out = system.open_output_stream(f"{base}/{name}")
            for text in column(batch, "text").to_pylist():
                # Half of a surrogate pair cannot be text; it is written as the replacement character.
                clean = (text or "").encode("utf-8", "replace").decode("utf-8")
                out.write(np.append(encoding.encode_to_numpy(clean, disallowed_special=()), END).astype(KIND).tobytes())
            yield record(
                doc=column(batch, "doc"), file=pa.array([name] * batch.num_rows),
                ordinal=np.arange(n, n + batch.num_rows, dtype=np.int64),
            )
            n += batch.num_rows
        if out is not None:
            out.close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    return stored(rows.mapInArrow(run, "doc long, file string, ordinal long"), "written").withColumnRenamed("doc", id_col)


def scan_separators(spark: SparkSession, folder: str, end: int = END, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document of every flat file below a folder: ``file``, ``ordinal``, ``start``, ``n_tokens``, ``ended``.

    ``start`` is the place of the first id in the file; the separator does not count. Ids after the
    last separator are a document that has not ended. Empty files have no documents.
    """
    block_bytes -= block_bytes % 2
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    blocks = files.where("length > 1").select(
        "path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 2, F.lit(block_bytes).cast("long"))).alias("at")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, at in zip(*(column(batch, c).to_pylist() for c in ("path", "length", "at"))):
                system, name = _place(path)
                with system.open_input_file(name) as source:
                    source.seek(at)
                    ids = np.frombuffer(source.read(min(block_bytes, length - length % 2 - at)), KIND)
                found = np.flatnonzero(ids == end).astype(np.int64) + at // 2
                yield record(
                    path=pa.array([path]), at=np.array([at]), n=np.array([len(found)]),
                    last=pa.array([found[-1] if len(found) else None], pa.int64()), size=np.array([length // 2]),
                    places=binaries(found.view(np.uint8), np.array([8 * len(found)])),
                )

    schema = "path string, at long, n long, last long, size long, places binary"
    # Every block is read once: its report is small, and the scan below needs it in order.
    reports = stored(blocks.repartition(F.col("path"), F.col("at")).mapInArrow(read, schema), "reports")
    before = W.partitionBy("path").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    prefix = reports.select(
        "path", "at", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ordinal"),
        F.coalesce(F.last("last", ignorenulls=True).over(before), F.lit(-1)).alias("earlier"),
        (F.lead("at").over(W.partitionBy("path").orderBy("at"))).isNull().alias("final"),
    )
    joined = reports.join(prefix, ["path", "at"])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ends = np.frombuffer(r["places"], np.int64)
                starts = np.append(r["earlier"], ends) + 1
                open_ = r["final"] and starts[-1] < r["size"]
                ended = np.append(np.ones(len(ends), bool), np.zeros(int(open_), bool))
                ends = np.append(ends, r["size"]) if open_ else ends
                starts = starts[: len(ends)]
                if len(ends):
                    yield record(
                        file=pa.array([r["path"].rsplit("/", 1)[-1]] * len(ends)),
                        ordinal=np.arange(r["ordinal"], r["ordinal"] + len(ends), dtype=np.int64),
                        start=starts.astype(np.int64), n_tokens=(ends - starts).astype(np.int64), ended=pa.array(ended),
                    )

    return joined.mapInArrow(documents, "file string, ordinal long, start long, n_tokens long, ended boolean")


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write flat files of the documents and count their tokens from the files alone: ``doc_id``, ``start``, ``n_tokens``."""
    folder = scratch_path(docs.sparkSession, "tokens")
    written = write_flat(docs, folder, id_col, text_col)
    if written.isEmpty():
        return written.select(id_col, F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("n_tokens"))
    return written.join(scan_separators(docs.sparkSession, folder), ["file", "ordinal"]).select(id_col, "start", "n_tokens")
