"""Near copies for the pipeline: SimHash groups first, then every link at a Jaccard similarity of 0.8.

Fingerprints of five-word shingles are grouped by the BK-trees of `simhash_trees`, and each document is compared
with one of its group. That settles the closest copies. It can't find them all: at a similarity of 0.8 fingerprints differ
in about ten of 64 bits, a radius at which neither trees nor parts of the bits tell documents apart. So documents that share
a band of their MinHash signatures are compared too (`jaccard_groups`), with 40 bands of 4: a pair at 0.8 shares
none with probability 7e-10. Links are made by exact similarity alone, so no document goes for its fingerprint.

Defined results: words are those of `simhash_trees`; fewer words than a shingle make one shingle of them all;
null and wordless texts are copies of each other; repeated rows are copies; columns of any name pass through; an empty
table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownframe.llm import simhash_trees
from crownframe.llm.circulant_minhash import different_sets, listings
from crownframe.llm.jaccard_groups import Rule, grouped
from crownframe.llm.shared import located, ship
from crownframe.session import cut, release

RULE, BANDS = Rule(5, 80), 40
#: Stands for the set of wordless texts.
EMPTY = 0


def fingerprint_pairs(nodes: DataFrame, radius: int) -> DataFrame:
    """(a, b): each node with the first of its fingerprint's group."""
    roots = simhash_trees.grouped(nodes.select("fp"), radius)
    of = nodes.select("node", "fp").join(roots, "fp").select("node", "root")
    first = of.groupBy("root").agg(F.min("node").alias("pivot"))
    return of.join(first, "root").filter("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))


def keep_one(docs: DataFrame, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one row of each component: that of the smallest doc_id (nulls last), then of
    the first file and position."""
    ship(docs.sparkSession)
    at = located(docs)
    lists = cut(listings(at, id_col, text_col, RULE.words, BANDS, prints=True), "listings")
    nodes = cut(different_sets(lists), "nodes")
    also = cut(fingerprint_pairs(nodes, radius), "fingerprint-pairs")
    roots = grouped(at, nodes, text_col, RULE, also)
    if not lists.filter("node is null").isEmpty():
        roots = roots.unionByName(lists.select(F.lit(EMPTY).cast("long").alias("node"),
                                               F.lit(EMPTY).cast("long").alias("root")).limit(1))
    roots = cut(roots, "roots")
    release(nodes, also)
    prints = lists.withColumn("fp", F.coalesce("node", F.lit(EMPTY).cast("long"))).drop("node", "n", "keys")
    return simhash_trees.one_of_each(at, prints, roots.withColumnRenamed("node", "fp"))
