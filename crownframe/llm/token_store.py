"""Token ids in flat files, with a minimal perfect hash index for keyed access.

A store is a folder. `shard-*.bin` hold nothing but ids, little-endian, one document after the other in
ascending order of doc_id; they are written by the tasks that encode a range of doc_id. The index is a
table with a row per bucket of keys: a key is hashed to its bucket, and within it a minimal perfect hash (a
pilot per small group of keys, chosen so that the bucket's keys fall on different slots 0..n-1) gives the
slot with the shard, the place and the number of ids, and a 32-bit fingerprint of the key, by which keys
that were never stored are told. A look-up reads one index row and one stretch of one file.

A key is (doc_id, copy): rows that repeat a doc_id lie next to each other, ordered by text, and count as
copies 0, 1, ... Null doc_id is a key of its own and comes first. Null text is empty and has the end id
only. An empty table makes a store without shards. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crownframe.llm.shared import Output, bounded, fresh_folder, open_input, ship, whole_text
from crownframe.llm.words import encoder
from crownframe.session import cut

#: Keys in a bucket and in a group that shares a pilot, on average; pilots tried at a time.
BUCKET, GROUP, TRIES = 2048, 4, 256
#: A shard is closed beyond this many bytes; a reader takes this many bytes at a time.
SHARD_BYTES, READ_BYTES = 256 << 20, 8 << 20


@dataclass(frozen=True)
class TokenStore:
    """Where a store is: folder of the shards, width of an id, and the tables of its index."""
    root: str
    dtype: str
    buckets: int
    index: DataFrame
    shards: DataFrame


def _encode_shards(root: str, vocabulary: str, end_id: int, dtype: str, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, roll = TaskContext.get().partitionId(), 0
        out, last, copy, end = None, object(), 0, np.array([end_id], dtype).tobytes()
        width = np.dtype(dtype).itemsize
        enc = encoder(vocabulary, dtype)
        for b in batches:
            keys, copies, shards, places, counts = b.column(0).to_pylist(), [], [], [], []
            for key, ids in zip(keys, enc.encode(b.column(1).to_pylist())):
                if out is not None and out.size >= shard_bytes:
                    out.close()
                    out, roll = None, roll + 1
                if out is None:
                    out = Output(root, f"shard-{part:06d}-{roll:04d}.bin")
                copy = copy + 1 if key == last else 0
                last = key
                copies.append(copy)
                shards.append((part << 20) + roll)
                places.append(out.size // width)
                counts.append(len(ids) // width + 1)
                out.write(ids + end)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(x, pa.int64()) for x in (copies, shards, places, counts)]],
                names=["doc_id", "copy", "shard", "place", "n"])
        if out is not None:
            out.close()
    return run


def _hashed(df: DataFrame, buckets: int) -> DataFrame:
    """With two hashes of the key and its bucket."""
    return df.withColumns({
        "h1": F.xxhash64("doc_id", "copy"),
        "h2": F.xxhash64("copy", "doc_id", F.lit(1))}).withColumn("bucket", F.pmod(
            F.xxhash64("h1", "h2"), F.lit(buckets)).cast("int"))


def _slots(h1: np.ndarray, h2: np.ndarray, pilot: np.ndarray, n: int) -> np.ndarray:
    """The slots of keys under pilots (broadcast against each other)."""
    x = h1 ^ (pilot.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x = x + h2
    return ((x ^ (x >> np.uint64(31))) % np.uint64(n)).astype(np.int64)


def _group_of(h2: np.ndarray, n: int) -> np.ndarray:
    return ((h2 >> np.uint64(8)) % np.uint64(-(-n // GROUP))).astype(np.int64)


def _print_of(h2: np.ndarray) -> np.ndarray:
    return (h2 >> np.uint64(32)).astype("<u4")


def perfect_hash(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pilots of the groups and slots of the keys: a one-to-one map onto 0..n-1. Keys are all different."""
    n = len(h1)
    group = _group_of(h2, n)
    order = np.argsort(group, kind="stable")
    size = np.bincount(group, minlength=-(-n // GROUP))
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    taken, pilots, slots = np.zeros(n, bool), np.zeros(len(size), np.uint32), np.empty(n, np.int64)
    for g in np.argsort(-size, kind="stable"):
        if not size[g]:
            break
        keys = order[first[g]:first[g] + size[g]]
        base = 0
        while True:
            tried = np.arange(base, base + TRIES)
            at = _slots(h1[keys][None, :], h2[keys][None, :], tried[:, None], n)
            good = ~taken[at].any(1)
            if len(keys) > 1:
                ordered = np.sort(at, 1)
                good &= (ordered[:, 1:] != ordered[:, :-1]).all(1)
            if good.any():
                k = int(good.argmax())
                pilots[g], slots[keys] = base + k, at[k]
                taken[at[k]] = True
                break
            base += TRIES
    return pilots, slots


def _build(group: pa.Table) -> pa.Table:
    h1, h2 = (np.asarray(group[c]).view(np.uint64) for c in ("h1", "h2"))
    pilots, slots = perfect_hash(h1, h2)
    def at_slots(x: np.ndarray, dtype: str) -> bytes:
        out = np.empty(len(x), dtype)
        out[slots] = x
        return out.tobytes()
    columns = {"bucket": group["bucket"][0].as_py(), "keys": len(h1),
               "pilots": pilots.astype("<u4").tobytes(), "prints": at_slots(_print_of(h2), "<u4"),
               "shards": at_slots(np.asarray(group["shard"]), "<i8"),
               "places": at_slots(np.asarray(group["place"]), "<i8"),
               "counts": at_slots(np.asarray(group["n"]), "<i8")}
    return pa.table({k: [v] for k, v in columns.items()},
                    schema=pa.schema([("bucket", pa.int32()), ("keys", pa.int32()),
                                      *[(k, pa.binary()) for k in list(columns)[2:]]]))


INDEX = "bucket int, keys int, pilots binary, prints binary, shards binary, places binary, counts binary"


def write_store(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end_id: int = 2, dtype: str = "<u2",
                id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> TokenStore:
    """Encode the documents into a new store in the shared folder."""
    spark = docs.sparkSession
    ship(spark)
    root = fresh_folder(spark, "tokens")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), whole_text(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    near = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    entries = cut(near.mapInArrow(_encode_shards(root, vocabulary, end_id, dtype, shard_bytes),
                                  f"doc_id {kind}, copy long, shard long, place long, n long"), "entries")
    buckets = max(1, -(-entries.count() // BUCKET))
    keyed = _hashed(entries, buckets).drop("doc_id", "copy")
    index = cut(keyed.groupBy("bucket").applyInArrow(_build, INDEX), "index")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)   # a row per shard
    shards = cut(entries.groupBy("shard").agg(F.sum("n").alias("ids")).select(
        "shard", "ids", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base")), "shards")
    return TokenStore(root, dtype, buckets, index, shards)


def _look_up(keys: pa.Table, index: pa.Table) -> pa.Table:
    """Shard, place and number of ids of each key; null for keys that aren't in the index."""
    h1, h2 = (np.asarray(keys[c]).view(np.uint64) for c in ("h1", "h2"))
    found = {c: np.zeros(len(h1), np.int64) for c in ("shard", "place", "n")}
    missing = np.ones(len(h1), bool)
    if index.num_rows:
        row = index.slice(0, 1).to_pylist()[0]
        n = row["keys"]
        pilots = np.frombuffer(row["pilots"], "<u4")[_group_of(h2, n)]
        slot = _slots(h1, h2, pilots, n)
        missing = np.frombuffer(row["prints"], "<u4")[slot] != _print_of(h2)
        for name, source in (("shard", "shards"), ("place", "places"), ("n", "counts")):
            found[name] = np.frombuffer(row[source], "<i8")[slot]
    return pa.table({"doc_id": keys["doc_id"], "copy": keys["copy"],
                     **{k: pa.array(v, mask=missing) for k, v in found.items()}})


def look_up(store: TokenStore, keys: DataFrame) -> DataFrame:
    """(doc_id, copy) with shard, place and n, found by the perfect hash of each key's bucket."""
    kind = keys.schema["doc_id"].dataType.simpleString()
    hashed = _hashed(keys.select("doc_id", F.col("copy").cast("long").alias("copy")), store.buckets)
    return hashed.groupBy("bucket").cogroup(store.index.groupBy("bucket")).applyInArrow(
        _look_up, f"doc_id {kind}, copy long, shard long, place long, n long")


def _crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _read(root: str, dtype: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, name, stream, low, data = np.dtype(dtype).itemsize, None, None, 0, b""
        for b in batches:
            shards, places, counts = (b.column(i).to_pylist() for i in (2, 3, 4))
            ids, crcs = [], []
            for shard, place, n in zip(shards, places, counts):
                file = f"shard-{shard >> 20:06d}-{shard & 0xFFFFF:04d}.bin"
                if file != name:
                    name, stream, low, data = file, open_input(root, file), 0, b""
                start, length = place * width, n * width
                if start < low or start + length > low + len(data):    # rows come in the order of the file
                    stream.seek(start)
                    low, data = start, stream.read(max(length, READ_BYTES))
                if len(data) < start - low + length:
                    raise OSError(f"{file} is shorter than its index says")
                x = np.frombuffer(data, dtype, n, start - low)
                crcs.append(_crc_of(x))
                if with_ids:
                    ids.append(x.astype(np.int32))
            arrays = [*b.columns, pa.array(crcs, pa.int64())]
            names = ["doc_id", "copy", "shard", "place", "n", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def read_ids(store: TokenStore, keys: DataFrame, with_ids: bool = True) -> DataFrame:
    """For the keys that are stored: doc_id, copy, start (ids of all documents before), n_tokens,
    ids_crc32 of the ids as unsigned 32-bit numbers, and the ids themselves."""
    ship(keys.sparkSession)
    kind = keys.schema["doc_id"].dataType.simpleString()
    found = look_up(store, keys).filter("shard is not null")
    near = found.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place")
    read = near.mapInArrow(_read(store.root, store.dtype, with_ids),
                           f"doc_id {kind}, copy long, shard long, place long, n long, ids_crc32 long"
                           + ", ids array<int>" * with_ids)
    return read.join(bounded(store.shards.select("shard", "base"), 32), "shard").select(
        "doc_id", "copy", (F.col("base") + F.col("place")).alias("start"), F.col("n").alias("n_tokens"),
        "ids_crc32", *["ids"] * with_ids)


def all_keys(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A key for every row of the documents."""
    counted = docs.groupBy(F.col(f"`{id_col}`").alias("doc_id")).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select("doc_id", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("copy"))
