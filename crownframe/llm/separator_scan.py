"""Token counts of flat files without an index, by a search for the end-of-document id.

A flat file holds the ids of one document after the other, each ended by the separator. The files are cut
into blocks of bytes; a task searches its block for separators in one vectorised comparison. A document may
begin in an earlier block: a prefix scan over the blocks of a file carries on the last separator before
each block and the number of separators so far, and with these every separator gives one document.

Defined results: a document without ids has count 0; ids after the last separator of a file make one more
document, marked as not ended; an empty file gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crownframe.llm.shared import Output, dealt, file_size, fresh_folder, open_input, ship, whole_text
from crownframe.llm.words import encoder
from crownframe.session import cut

#: Bytes of a block; a multiple of every id width.
BLOCK_BYTES = 4 << 20
#: A file is closed beyond this many bytes, so no window over a file's blocks is long.
FILE_BYTES = 256 << 20


def write_flat(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", separator: int = 50256,
               dtype: str = "<u2", id_col: str = "doc_id", text_col: str = "text",
               file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """Encode documents into flat files, one or more per partition, in the order of the rows. Returns the folder
    and the names of the documents: file, ordinal (place among the file's documents), doc_id.
    Null text is empty. The separator can't come from a text."""
    spark = docs.sparkSession
    ship(spark)
    root = fresh_folder(spark, "flat")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), whole_text(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, roll, out, n = TaskContext.get().partitionId(), 0, None, 0
        enc, end = encoder(vocabulary, dtype), np.array([separator], dtype).tobytes()
        for b in batches:
            if not b.num_rows:
                continue
            files, ordinals = [], []
            for ids in enc.encode(b.column(1).to_pylist()):
                if out and out.size >= file_bytes:
                    out.close()
                    out, roll, n = None, roll + 1, 0
                name = f"ids-{part:06d}-{roll:04d}.bin"
                out = out or Output(root, name)
                out.write(ids + end)
                files.append(name)
                ordinals.append(n)
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array(files), pa.array(ordinals, pa.int64()), b.column(0)],
                                             names=["file", "ordinal", "doc_id"])
        if out:
            out.close()

    return root, cut(rows.mapInArrow(run, f"file string, ordinal long, doc_id {kind}"), "names")


def scan(root: str, files: DataFrame, separator: int = 50256, dtype: str = "<u2",
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Counts from the ids alone: file, ordinal, start (place of the first id in the file), n_tokens
    (without the separator), ended. `files` has the names in its column `file`."""
    spark = files.sparkSession
    ship(spark)
    width = np.dtype(dtype).itemsize

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [file_size(root, x) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.int64())], names=["file", "bytes"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with open_input(root, file) as f:
                    f.seek(block * block_bytes)
                    ids = np.frombuffer(f.read(block_bytes), dtype)
                first = block * block_bytes // width
                found = np.flatnonzero(ids == separator) + first
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([block]), pa.array([first + len(ids)]),
                     pa.array([found], pa.list_(pa.int64()))], names=["file", "block", "stop", "found"])

    sized = dealt(cut(files.select("file").distinct(), "file-names")).mapInArrow(sizes, "file string, bytes long").filter("bytes > 0")
    last_block = F.floor((F.col("bytes") - 1) / block_bytes)
    blocks = sized.select("file", F.explode(F.sequence(F.lit(0).cast("long"), last_block)).alias("block"))
    parts = cut(dealt(cut(blocks, "block-names")).mapInArrow(search, "file string, block long, stop long, found array<long>"), "blocks")

    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    thin = parts.select("file", "block", F.size("found").alias("n"), F.array_max("found").alias("last"))
    carried = thin.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("done"),
                          F.coalesce(F.max("last").over(before), F.lit(-1)).alias("ended_at"))
    ends = parts.join(carried, ["file", "block"])
    starts = F.concat(F.array(F.col("ended_at") + 1),
                      F.transform(F.slice("found", 1, F.greatest(F.size("found") - 1, F.lit(0))), lambda x: x + 1))
    each = ends.filter(F.size("found") > 0).select(
        "file", "done", F.posexplode(F.arrays_zip(starts.alias("start"), F.col("found"))).alias("i", "x"))
    whole = each.select("file", (F.col("done") + F.col("i")).alias("ordinal"), F.col("x.start").alias("start"),
                        (F.col("x.found") - F.col("x.start")).alias("n_tokens"), F.lit(True).alias("ended"))
    totals = parts.groupBy("file").agg(
        F.max("stop").alias("stop"), F.coalesce(F.max(F.array_max("found")), F.lit(-1)).alias("last"),
        F.sum(F.size("found")).cast("long").alias("n"))
    tails = totals.filter("stop > last + 1").select(
        "file", F.col("n").alias("ordinal"), (F.col("last") + 1).alias("start"),
        (F.col("stop") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("ended"))
    return whole.unionByName(tails)


def token_counts(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", separator: int = 50256,
                 dtype: str = "<u2", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, counted in flat files written for it."""
    root, names = write_flat(docs, vocabulary, separator, dtype, id_col, text_col)
    return names.join(scan(root, names, separator, dtype), ["file", "ordinal"], "left").select("doc_id", "n_tokens")
