"""Language identification by multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; everything that isn't a letter is a blank, runs of blanks are one. All n-grams of one
to three characters within a text are hashed to `FEATURES` numbers. Fitting counts them by label in the
tasks, which add up their counts before the shuffle. The matrix of log probabilities (labels x
features) goes to the tasks with the function; `CELLS` bounds it, so more labels have fewer features. A batch is
scored in numpy from the features that occur, one gather and segment sum per label.

Fitting takes all labelled rows up to `fit_rows`; beyond that about so many, by a hash of the id, but of each label
`FLOOR` rows at least or all it has. The share of a label is counted on all labelled rows. A label whose rows have no
letter is not learned.

Defined results: null text or text without a letter is `und` with score 0, and so is everything if no label
was learned (the filter then keeps what has a letter); the score is the posterior probability of the label; equal posteriors go to the label first in
order. Rows with a null id are never fitted on. Text, label and id are all that is looked at, and only
the text when predicting.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownframe.llm.shared import ship, whole_text

FEATURES, ORDERS = 1 << 16, 3
#: Numbers of the matrix, and labels, at most.
CELLS, MOST_LABELS = 1 << 24, 1 << 16
#: Labelled rows that are fitted on, about, and of each label at least; smoothing; characters handled at a time.
FIT_ROWS, FLOOR, ALPHA, STEP = 200_000, 1000, 0.5, 1 << 18
UNKNOWN = "und"
#: Odd numbers for the hash of the first, second and third character.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@functools.lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-grams of all texts, text by text, and where each text's end in that array."""
    lowered = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    points = np.where(_is_letter()[points], points, 32)
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32) | (owner[1:] != owner[:-1])
    points, owner = points[keep].astype(np.uint64), owner[keep]
    hashed, whose = [], []
    total = np.zeros(len(points), np.uint64)
    for n in range(ORDERS):
        rows = len(points) - n
        if rows <= 0:
            break
        total = total[:rows] + (points[n:] + np.uint64(1)) * np.uint64(FACTORS[n])
        good = owner[n:] == owner[:rows] if n else points != 32
        mixed = (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        hashed.append((mixed[good] >> np.uint64(48)).astype(np.int32))
        whose.append(owner[:rows][good])
    if not hashed:
        return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    whose_all, all_hashed = np.concatenate(whose), np.concatenate(hashed)
    order = np.argsort(whose_all, kind="stable")
    return all_hashed[order], np.cumsum(np.bincount(whose_all, minlength=len(texts)))


def has_letter(texts: list[str]) -> np.ndarray:
    out = np.zeros(len(texts), bool)
    for first, some in _blocks(texts):
        _, ends = features(some)
        out[first:first + len(some)] = np.diff(ends, prepend=0) > 0
    return out


def _blocks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= STEP:
            yield first, texts[first:i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


@dataclass(frozen=True)
class Model:
    labels: list[str]
    log_prior: np.ndarray          # per label
    log_prob: np.ndarray           # labels x features, a power of two

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        labels, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.labels:
            return labels, scores
        for first, some in _blocks(texts):
            found, ends = features(some)
            found &= self.log_prob.shape[1] - 1
            starts = np.concatenate(([0], ends[:-1]))
            real = np.flatnonzero(ends > starts)
            if not len(real):
                continue
            sums = np.stack([np.add.reduceat(row[found], starts[real]) for row in self.log_prob])
            sums += self.log_prior[:, None]
            best = sums.argmax(0)
            odds = np.exp(sums - sums.max(0)).sum(0)
            for i, b, o in zip(real.tolist(), best.tolist(), odds.tolist()):
                labels[first + i], scores[first + i] = self.labels[b], 1 / o
        return labels, scores


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "lang") -> Model:
    """Learn from the labelled rows that aren't held out."""
    ship(docs.sparkSession)
    ours = docs.filter(~held_out(id_col)).select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
        whole_text(f"`{text_col}`").alias("text")).filter("label is not null and id is not null")
    rows = ours.groupBy("label").count().orderBy("label").limit(MOST_LABELS + 1).collect()
    if len(rows) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    labels, each = [r["label"] for r in rows], np.array([r["count"] for r in rows], float)
    width = FEATURES
    while width * len(labels) > CELLS:
        width //= 2
    if each.sum() > fit_rows:
        shares = np.minimum(1, np.maximum(fit_rows / each.sum(), FLOOR / each)) * (1 << 30)
        table = docs.sparkSession.createDataFrame(list(zip(labels, map(int, shares))), ["label", "share"])
        ours = ours.join(F.broadcast(table), "label").filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.col("share"))
    index = {label: i for i, label in enumerate(labels)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(index), width), np.int64)
        for b in batches:
            of, texts = [index[x] for x in b.column(0).to_pylist()], b.column(1).to_pylist()
            for first, some in _blocks(texts):
                found, ends = features(some)
                label = np.repeat(of[first:first + len(some)], np.diff(ends, prepend=0))
                total += np.bincount(label * width + (found & (width - 1)), minlength=total.size).reshape(total.shape)
        label, feature = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (label, feature, total[label, feature])],
                                         names=["label", "feature", "n"])

    sums = (ours.select("label", "text").mapInArrow(count, "label long, feature long, n long")
            .groupBy("label", "feature").agg(F.sum("n").alias("n"))).toArrow()   # labels x features at most
    label, feature, n = (np.asarray(sums[c]) for c in ("label", "feature", "n"))
    counts = np.zeros((len(labels), width))
    counts[label, feature] = n
    learned = counts.sum(1) > 0
    smoothed, each = counts[learned] + ALPHA, each[learned]
    return Model([x for x, known in zip(labels, learned) if known], np.log(each / max(1.0, each.sum())),
                 np.log(smoothed / smoothed.sum(1, keepdims=True)))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), held_out(id_col).alias("held_out"),
                       whole_text(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)          # CELLS numbers at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels, scores = sent.value.predict(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(labels, pa.string()),
                                              pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    return predict(docs, fit(docs, fit_rows))


def keep_identified(docs: DataFrame, least_score: float = 0.5, fit_rows: int = FIT_ROWS,
                    text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, whose language is known with at least this score; where no label could be
    learned, those with a letter."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, fit_rows, text_col=text_col))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            if sent.value.labels:
                labels, scores = sent.value.predict(texts)
                stays = np.array([x != UNKNOWN for x in labels], bool) & (scores >= least_score)
            else:
                stays = has_letter(texts)
            yield b.filter(pa.array(stays))

    return docs.mapInArrow(run, docs.schema)
