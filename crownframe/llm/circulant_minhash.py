"""MinHash near-duplicates with signatures from two permutations.

A signature has one coordinate per shift: the first permutation scatters a document's shingles over the numbers
below 2**32, the second orders these numbers, and coordinate k is the smallest number of the second permutation over the
scattered shingles, each shifted round the circle by k. So two permutations do the work of as many as there are
coordinates. Coordinates are cut into bands; documents with an equal band are candidates, and links are made by the
exact Jaccard similarity of the whole sets (`jaccard_groups`), never by the signature.

With 32 bands of 4 coordinates, two sets at similarity s have no band in common with probability (1 - s**4)**32: 6e-11
at 0.85. That is the only way to lose a link. Equal sets are one from the start.

Defined results: A-Z are lower-cased, words are runs without ASCII spaces; a text of fewer words than a
shingle has one shingle of them all; null and wordless texts have an empty set and are linked with nothing; a
component's id is its smallest non-null doc_id, null if it has none, and a null doc_id is kept only in such a
component; repeated rows are linked like other copies; other columns play no part; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from crownframe.llm.jaccard_groups import STEP_BYTES, Rule, grouped, node_of
from crownframe.llm.shared import FILE, ROW, located, ship, whole_text
from crownframe.llm.simhash_trees import fingerprint_of, shingle_hashes
from crownframe.session import cut, release

BANDS, WIDTH = 32, 4
#: Shingles whose coordinates are worked out at a time.
BLOCK = 2048
#: Odd factors of the two permutations and of the keys.
FIRST, SECOND, KEYS = (0x7FEB352D, 0x846CA68B), (0x85EBCA6B, 0xC2B2AE35), 0x9E3779B97F4A7C15


def permuted(x: np.ndarray, factors: tuple[int, int]) -> np.ndarray:
    """A permutation of the numbers below 2**32, in place: steps that can each be undone."""
    part = x >> np.uint32(16)
    x ^= part
    x *= np.uint32(factors[0])
    np.right_shift(x, np.uint32(15), out=part)
    x ^= part
    x *= np.uint32(factors[1])
    return x


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """The coordinates of a set of 64-bit hashes that isn't empty."""
    h = shingles.view(np.uint64)
    scattered = permuted((h ^ (h >> np.uint64(32))).astype(np.uint32), FIRST)
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(scattered), BLOCK):
        np.minimum(least, permuted(scattered[None, i:i + BLOCK] - shifts, SECOND).min(1), out=least)
    return least


def band_keys(least: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """One number per band, made of the band's place and coordinates."""
    rows = least.reshape(-1, width).astype(np.uint64)
    key = np.arange(len(rows), dtype=np.uint64)
    for column in rows.T:
        key = (key ^ column) * np.uint64(KEYS)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def listings(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int = BANDS, width: int = WIDTH,
             prints: bool = False) -> DataFrame:
    """Per document of a located table: __id, its place, node (of its set; null if the set is empty), n, keys and, with
    `prints`, the SimHash fingerprint fp of the same shingles, repeats included."""
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), FILE, ROW, whole_text(f"`{text_col}`").alias("__text"))
    schema = StructType([rows.schema["__id"], StructField(FILE, StringType()), StructField(ROW, LongType()),
                         StructField("node", LongType()), StructField("n", IntegerType()),
                         StructField("keys", ArrayType(LongType())), StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, start = [], 0
            for i, text in enumerate(b.column(3).to_pylist()):
                hashes = shingle_hashes(text, words)
                s = np.unique(hashes).view(np.int64)
                fp = fingerprint_of(hashes) if prints else 0
                keys = band_keys(signature(s, bands * width), width) if len(s) else np.empty(0, np.int64)
                out.append((node_of(s) if len(s) else None, len(s), keys, fp))
                if 8 * bands * len(out) >= STEP_BYTES or i == b.num_rows - 1:
                    node, n, keys, fp = zip(*out)
                    ends = np.cumsum([0, *map(len, keys)], dtype=np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [*b.slice(start, len(out)).columns[:3], pa.array(node, pa.int64()), pa.array(n, pa.int32()),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys))), pa.array(fp, pa.int64())],
                        names=schema.names)
                    out, start = [], i + 1

    return rows.mapInArrow(run, schema)


def different_sets(lists: DataFrame) -> DataFrame:
    """A row per different set that isn't empty: node, n, keys, fp and the place of its first document."""
    one = F.min(F.struct(FILE, ROW, "n", "keys", "fp")).alias("one")
    return lists.filter("node is not null").groupBy("node").agg(one).select("node", "one.*")


def near_dups(docs: DataFrame, words: int = 3, percent: int = 85, bands: int = BANDS, width: int = WIDTH,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    ship(docs.sparkSession)
    at = located(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")))
    lists = cut(listings(at, "doc_id", "text", words, bands, width), "listings")
    nodes = cut(different_sets(lists), "nodes")
    roots = cut(grouped(at, nodes, "text", Rule(words, percent)), "roots")
    release(nodes)
    least = lists.filter("node is not null").groupBy("node").agg(F.min("__id").alias("least"))
    named = roots.join(least, "node").groupBy("root").agg(F.min("least").alias("component"))
    of_node = roots.join(named, "root").select("node", "component")
    rows = lists.select("__id", "node", "n").join(of_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("__id")).otherwise(F.col("component"))
    return rows.select(F.col("__id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                       component.alias("component_id"), F.col("__id").eqNullSafe(component).alias("kept"))
