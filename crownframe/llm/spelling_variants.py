"""Spelling variants by permuterm rotations.

Words are counted over all documents. A word is near another that differs by one inserted, deleted or replaced
code point; its form is the near word of largest count if that is at least `ratio` times its own, and its root is
where a walk from form to form ends.

Each word is marked with a terminator and turned so that each of its characters stands last once. Leaving that
character out leaves a prefix that says where the edit is: rotations that share it belong to words that differ by
one replacement there, and the rotation that is the prefix and nothing more belongs to the word without that
character. So all rotations are sorted by prefix, and each run of one prefix is scanned once. A run holds at most
one rotation per letter of the alphabet and one whole one, and a word's near words in it are counted and its best
one chosen without writing pairs. A pair of neighbours meets in one run only: replacements differ at one place, and
of equal characters in a row only the first counts as the inserted one.

Defined results: null text has no words; a null doc_id hashes as the empty text; repeated rows count again; long
texts are read whole; other columns play no part; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crownframe.llm.shared import ship, whole_text
from crownframe.session import cut, release

#: Runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8 whose A-Z are lower-cased.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
END = "$"
#: Different words a task counts before it hands them on; one in so many words is misspelt.
HELD, ODDS = 200_000, 97


def misspelt(run: bytes, start: int) -> bytes:
    """The run, or, where the hash says so, the run less one code point. `start` is the crc32 of `<doc_id>:`."""
    h = zlib.crc32(run, start)
    if h % ODDS:
        return run
    word = run.decode()
    k = h % len(word)
    return (word[:k] + word[k + 1:]).encode()


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 5,
            least_n: int = 3) -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
                       whole_text(f"`{text_col}`").cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for b in batches:
            for i, text in zip(b.column(0), b.column(1)):
                start = zlib.crc32(f"{i}:".encode())
                for word, n in Counter(RUN.findall(text.as_py().lower())).items():
                    total[misspelt(word, start)] += n
                if len(total) >= HELD:
                    yield batch(total)
                    total = Counter()
        yield batch(total)

    def batch(total: Counter[bytes]) -> pa.RecordBatch:
        words = pa.array(total.keys(), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], names=["word", "n"])

    return (rows.mapInArrow(run, "word string, n long").filter(F.char_length("word") >= least_chars)
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n))


def rotations(words: DataFrame) -> DataFrame:
    """Rows (prefix, word, n, whole, first): per word each rotation as it is (`whole`), and each without its last
    character; `first` says that the character left out doesn't follow its like."""
    marked = words.select("word", "n", F.concat("word", F.lit(END)).alias("m"), F.char_length("word").alias("size"))
    each = marked.select("*", F.posexplode(F.sequence(F.lit(0), F.col("size"))).alias("at", "_"))
    tail, head = F.expr("substring(m, at + 2)"), F.expr("substring(m, 1, at)")
    turned = F.concat(tail, head)                           # without the character at `at`, which would stand last
    here, before = F.expr("substring(m, at + 1, 1)"), F.expr("substring(m, at, 1)")
    kinds = F.array(
        F.struct(F.concat(turned, here).alias("prefix"), F.lit(True).alias("whole"), F.lit(True).alias("first")),
        F.struct(turned.alias("prefix"), F.lit(False).alias("whole"), ((F.col("at") == 0) | (here != before)).alias("first")))
    return (each.select("word", "n", "at", "size", F.explode(kinds).alias("r"))
            .filter(F.col("r.whole") | (F.col("at") < F.col("size")))     # the terminator is never edited
            .select("r.prefix", "word", "n", "r.whole", "r.first"))


def _runs(words: DataFrame) -> DataFrame:
    """Rotations in runs of one prefix, with what a scan of the run tells."""
    by = Window.partitionBy("prefix")
    best = by.orderBy(F.desc("n"), "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    this = F.struct((-F.col("n")).alias("d"), F.col("word").alias("w"))   # the smallest is the best

    def nth(k, of):
        return F.nth_value(F.when(of, this), k, ignoreNulls=True).over(best)

    part = ~F.col("whole")
    return rotations(words).select(
        "prefix", "word", "n", "whole", "first", nth(1, part).alias("one"), nth(2, part).alias("two"),
        nth(1, part & F.col("first")).alias("longer"), nth(1, F.col("whole")).alias("shorter"),
        F.count_if(part).over(best).alias("parts"), F.count_if(part & F.col("first")).over(best).alias("firsts"))


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best): the number of near words and (-n, word) of the most frequent, for words with any."""
    short = F.when(F.col("first"), F.col("shorter"))
    other = F.when(F.col("one.w") == F.col("word"), F.col("two")).otherwise(F.col("one"))
    seen = _runs(words).select(
        "word",
        F.when(F.col("whole"), F.col("firsts")).otherwise(F.col("parts") - 1 + short.isNotNull().cast("long")).alias("near"),
        F.when(F.col("whole"), F.col("longer")).otherwise(F.least(other, short)).alias("best"))
    return seen.filter(F.col("near") > 0).groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of near words, each once; a word has at most a few per place and letter."""
    r = rotations(words).select("prefix", "word", "whole", "first")
    a, b = r.alias("a"), r.filter("not whole").alias("b")
    meet = a.join(b.hint("merge"), F.col("a.prefix") == F.col("b.prefix"))
    replaced = ~F.col("a.whole") & (F.col("a.word") < F.col("b.word"))
    longer = F.col("a.whole") & F.col("b.first")
    return meet.filter(replaced | longer).select(F.least("a.word", "b.word").alias("a"), F.greatest("a.word", "b.word").alias("b"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): where the walk ends. Each round doubles the steps behind a row; a form has at
    least twice its word's count, so walks are short."""
    now = cut(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                        F.col("next").isNotNull().alias("moved")), "roots")
        release(now)
        now = moved
        if now.filter("moved").isEmpty():
            return now.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 5, least_n: int = 3,
             ratio: int = 2) -> DataFrame:
    """Per word: word, n, n_near, form, form_n, root."""
    if ratio < 2:
        raise ValueError("a form needs at least twice the count, or walks need not end")
    words = cut(counted(docs, id_col, text_col, least_chars, least_n), "words")
    near = neighbours(words)
    chosen = -F.col("best.d") >= ratio * F.col("n")
    formed = cut(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(chosen, F.col("best.w")).alias("form"),
        F.when(chosen, -F.col("best.d")).alias("form_n")), "forms")
    ends = roots(formed.filter("form is not null"))
    return formed.join(ends, "word", "left").select(
        "word", F.coalesce("root", "word").alias("root"), "form", "n", "n_near", "form_n")
