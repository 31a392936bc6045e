"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are 64-bit hashes of words, neighbouring word pairs, pairs with one word between
them, and four-letter word stems; each counts once a text.  The model is fitted with per-coordinate
rates and L1, which leaves weights only for features that keep recurring in one class.  Those
few thousand (hash, weight) pairs are broadcast, and every text is scored where it lies.

The fit uses a bounded sample: at most ``class_rows`` labelled documents of each class, those with the
smallest hashed ids, and at most ``max_features`` features of theirs.  Where the bound thins one class more than the other, the intercept is
corrected by the two classes' known sizes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, only_cache, ship, slices

WORD = re.compile(r"[^\W_]+")
STEM = 4
#: Words whose hashes a task remembers.
WORD_CACHE = 1 << 16
#: Size of the table that sorts out most features without a weight before the exact look-up.
SIEVE = 1 << 20
#: A text is toxic from this score on.
THRESHOLD = 0.3


class _Hashes(dict):
    """Hash of a word and of its stem, remembered."""

    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = pair = (xxhash.xxh64_intdigest(word, 1), xxhash.xxh64_intdigest(word[:STEM], 2))
        return pair


_HASHES = _Hashes()


def _use_cache() -> None:
    """A module's function, so that tasks mean the worker's own cache and not a copy in their closure."""
    only_cache("toxicity", _HASHES.clear)


def features(text: str | None) -> np.ndarray:
    """Hashed features of a text, with repeats; none for a null or wordless text."""
    words = WORD.findall((text or "").lower())
    if not words:
        return np.zeros(0, np.uint64)
    pairs = np.array(list(map(_HASHES.__getitem__, words)), np.uint64)
    word, stem = pairs[:, 0], pairs[:, 1]
    a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    every = np.concatenate((word, stem, word[:-1] * a + word[1:], word[:-2] * b + word[2:]))
    return every ^ (every >> np.uint64(32))


@dataclass(frozen=True)
class Model:
    """Sorted feature hashes with a weight, their weights, and the intercept."""

    hashes: np.ndarray
    weights: np.ndarray
    intercept: float

    def sieve(self) -> np.ndarray:
        marks = np.zeros(SIEVE, bool)
        marks[self.hashes & np.uint64(SIEVE - 1)] = True
        return marks

    def score(self, text: str | None, sieve: np.ndarray) -> float:
        """Probability that the text is toxic; the intercept alone decides on an empty one."""
        total = self.intercept
        found = features(text)
        found = found[sieve[found & np.uint64(SIEVE - 1)]]
        if len(found) and len(self.hashes):
            found = np.unique(found)
            at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
            total += float(self.weights[at][self.hashes[at] == found].sum())
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def frequent(rows: list[np.ndarray], min_rows: int) -> np.ndarray:
    """Sorted features that are in at least ``min_rows`` of the rows (each of distinct features); drops others in place."""
    counts, low = np.zeros(1 << 22, np.int32), np.uint64((1 << 22) - 1)
    for r in rows:
        counts[r & low] += 1
    for i, r in enumerate(rows):  # a place's count is no less than its features'
        rows[i] = r[counts[r & low] >= min_rows]
    found = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    hashes, counts = np.unique(found, return_counts=True)
    return hashes[counts >= min_rows]


def ftrl(rows: list[np.ndarray], labels: np.ndarray, alpha: float = 2.0, beta: float = 1.0, l1: float = 4.0,
         l2: float = 1.0, epochs: int = 4, min_rows: int = 3, seed: int = 0) -> Model:
    """FTRL-proximal over rows of distinct feature hashes; features in under ``min_rows`` rows are left out.

    ``rows`` is used up: its arrays become the features' numbers.
    """
    hashes = frequent(rows, min_rows)
    for i, r in enumerate(rows):
        at = np.searchsorted(hashes, r)
        rows[i] = at[hashes[np.minimum(at, len(hashes) - 1)] == r].astype(np.int32) if len(hashes) else at[:0]
    z, n = np.zeros(len(hashes) + 1), np.zeros(len(hashes) + 1)  # the last is the intercept, without L1
    order, draw = np.arange(len(rows)), np.random.RandomState(seed)

    def weights(at):
        zi, ni = z[at], n[at]
        bound = np.full(len(at), l1)
        bound[-1] = 0.0
        return np.where(np.abs(zi) <= bound, 0.0,
                        -(zi - np.sign(zi) * bound) / ((beta + np.sqrt(ni)) / alpha + l2))

    last = np.array([len(hashes)])
    for _ in range(epochs):
        draw.shuffle(order)
        for i in order:
            at = np.concatenate((rows[i], last))
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30)))
            g = p - labels[i]
            root = np.sqrt(n[at])
            z[at] += g - (np.sqrt(n[at] + g * g) - root) / alpha * w
            n[at] += g * g
    every = weights(np.arange(len(hashes) + 1))
    kept = np.flatnonzero(every[:-1])
    return Model(hashes[kept], every[:-1][kept], float(every[-1]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", class_rows: int = 4096, max_features: int = 1 << 25) -> Model:
    """Fit on at most ``class_rows`` labelled documents of each class, and ``max_features`` features of theirs.

    Labels join on the id; null ids and labels take no part, and an id labelled both ways counts
    as toxic.  Of several rows with one id the text of smallest hash counts.  Features are made where the texts lie; the fit takes
    the sample's documents in the order of their ids' hashes until one would pass ``max_features``.  Without rows of
    both classes the model has no weights, and its intercept is the share of
    toxic labels (one half without labels).
    """
    marked = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
              .where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y")))
    known = marked.join(docs.select(F.col(id_col).cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sizes = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return _without_weights(sizes)
    # The ids with the smallest hashes: about twice as many pass the bound as are taken, whatever the labels' number.
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    chosen = None
    for y, n in sizes.items():
        near = known.where((F.col("y") == y) & (place <= int((1 << 63) * min(1.0, 2 * class_rows / n)) - 1))
        first = near.orderBy(place, "doc_id").limit(class_rows)
        chosen = first if chosen is None else chosen.unionByName(first)  # at most 2 * class_rows ids
    sample = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
              .join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y")
              .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")))

    def distinct_features(batch):
        _use_cache()
        found = [np.unique(features(text)).view(np.int64) for text in batch.column("text").to_pylist()]
        yield {"doc_id": batch.column("doc_id"), "y": batch.column("y"), "features": found}

    made = (map_arrow(sample, distinct_features, "doc_id long, y int, features array<long>")
            .repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").select("y", "features"))

    def train(batches):
        rows, labels_of, held = [], [], 0
        for batch in batches:
            for part in slices(batch):
                found = part.column(1)
                ends = found.offsets.to_numpy()
                values = found.values.to_numpy()
                for y, a, b in zip(part.column(0).to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
                    if held is not None and held + b - a <= max_features:
                        held += b - a
                        rows.append(values[a:b].view(np.uint64).copy())
                        labels_of.append(y)
                    else:
                        held = None
        taken = [labels_of.count(y) for y in (0, 1)]
        m = ftrl(rows, np.array(labels_of, float))
        yield pa.RecordBatch.from_pydict({"hashes": pa.array([m.hashes.view(np.int64)], pa.list_(pa.int64())),
                                          "weights": pa.array([m.weights], pa.list_(pa.float64())),
                                          "intercept": pa.array([m.intercept], pa.float64()),
                                          "taken": pa.array([taken], pa.list_(pa.int32()))})

    got = made.mapInArrow(train, "hashes array<long>, weights array<double>, intercept double, taken array<int>").first()
    if min(got.taken) == 0:
        return _without_weights(sizes)
    shift = np.log(sizes[1] / sizes[0]) - np.log(got.taken[1] / got.taken[0])
    return Model(np.array(got.hashes, np.int64).view(np.uint64), np.array(got.weights, float),
                 got.intercept + float(shift))


def _without_weights(sizes: dict[int, int]) -> Model:
    share = (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
    return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))


def scorer(df: DataFrame, model: Model):
    """A column function from a text column to its score, with the model broadcast."""
    ship(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        _use_cache()
        m = sent.value
        sieve = m.sieve()
        return pd.Series([m.score(t, sieve) for t in texts], dtype="float64")

    return score


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", class_rows: int = 4096, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Fitted on labelled rows that aren't held out; only the text enters a score.  Null and empty texts
    score by the intercept.  Repeated rows stay repeated, other columns are ignored, and an empty
    table gives no rows.
    """
    model = fit(docs.where(~held_out(id_col)), labels, id_col, text_col, label_col, class_rows)
    score = scorer(docs, model)
    return (docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                        score(F.col(text_col).cast("string")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               label_col: str = "toxic", class_rows: int = 4096, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score under the threshold."""
    model = fit(docs.where(~held_out(id_col)), labels, id_col, text_col, label_col, class_rows)
    return docs.where(scorer(docs, model)(F.col(text_col).cast("string")) < threshold)


__all__ = ["Model", "features", "fit", "ftrl", "held_out", "keep_clean", "score_documents", "scorer"]
