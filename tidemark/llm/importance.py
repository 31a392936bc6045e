"""Importance resampling towards a target distribution.

Texts are runs of one or two words hashed into buckets.  How much more often the target has a bucket
than the corpus is that bucket's gain; an array of gains, one for each bucket, scores every text by one look-up a
feature.  Gumbel noise from a hash of the id turns the weights into a draw without replacement: the
highest scores win.

The k-th best is found by distributed quickselect: random rows become pivots, one pass counts the rows below,
at and above every pivot exactly, and the next round looks only between the two pivots around the k-th place.
Winners alone are then sorted and ranked.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .common import as_bytes, map_arrow, ship, slices, stage
from .ranking import numbered

BUCKETS = 10_000
#: Fewer words than these aren't drawn.
MIN_WORDS = 20
#: Pivots of a round.
PIVOTS = 31

#: Bytes of words in lower case, all others as spaces.
_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                    for b in range(256))


def buckets(text: bytes, n_buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every word and of every two neighbours, repeats included."""
    words = text.translate(_WORD_BYTES).split(b" ")
    words = [w for w in words if w]
    n = len(words)
    single = list(map(zlib.crc32, words))
    # A CRC goes on from that of the word and the space before it.
    double = map(zlib.crc32, words[1:], map(zlib.crc32, repeat(b" "), single))
    found = np.empty(max(2 * n - 1, 0), np.int64)
    found[:n] = single
    found[n:] = np.fromiter(double, np.int64, max(n - 1, 0))
    return n, found % n_buckets


def bucket_counts(docs: DataFrame, text_col: str = "text", n_buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket.  Tasks send one sum a bucket; the array's length is its bound."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for part in slices(batch):
                for text in part.column(0).to_pylist():
                    counts += np.bincount(buckets(text, n_buckets)[1], minlength=n_buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], ["bucket", "n"])

    ship(docs.sparkSession)
    parts = docs.select(as_bytes(text_col).alias("text")).mapInArrow(run, "bucket int, n long")
    total = np.zeros(n_buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[r.bucket] = r.n
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket: a thousand times the log of the smoothed ratio of its shares, rounded down."""
    n, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (s_all + n) / ((float(s) + 1) * (t_all + n))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight (the floored mean gain of a text's features) of rows of doc_id and text."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batch):
        gain = sent.value
        out = {"n_words": [], "n_features": [], "weight": []}
        for text in batch.column("text").to_pylist():
            n, found = buckets(text, len(gain))
            out["n_words"].append(n)
            out["n_features"].append(len(found))
            out["weight"].append(int(gain[found].sum()) // len(found) if len(found) else 0)
        yield out | {"doc_id": batch.column("doc_id")}

    return map_arrow(docs, run, "doc_id long, n_words long, n_features long, weight long")


def noise(id_col: str, seed: int) -> Column:
    """Gumbel noise of a row in thousandths, from the SHA-256 of the seed and the id; a null id counts as no digits."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def kth(rows: DataFrame, key: str, k: int, pivots: int = PIVOTS, seed: int = 0) -> Row:
    """The k-th smallest (from 1) value of a struct column that has no equal values.

    A round takes the ``pivots`` rows of smallest hash between the bounds as pivots, and counts in one pass
    the rows between and at them.  Only pivots and counts reach the driver; every round leaves one gap, and ends
    when the k-th row is a pivot itself.
    """
    left, turn = rows.select(key), seed
    low = high = None
    while True:
        between = left
        if low is not None:
            between = between.where(F.col(key) > _literal(low, rows, key))
        if high is not None:
            between = between.where(F.col(key) < _literal(high, rows, key))
        drawn = between.orderBy(F.xxhash64(key, F.lit(turn)), key).limit(pivots)
        order = drawn.select(F.array_sort(F.collect_list(key)).alias("k")).head()["k"]
        points = F.array(*[_literal(p, rows, key) for p in order])
        # Twice the pivots below, and one more at a pivot: even numbers are gaps, odd ones the pivots.
        place = F.aggregate(points, F.lit(0), lambda n, p: n + F.when(p < F.col(key), 2).when(p == F.col(key), 1).otherwise(0))
        counts = {r["place"]: r["n"] for r in between.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("n")).collect()}
        for at in range(2 * len(order) + 1):
            n = counts.get(at, 0)
            if k <= n:
                break
            k -= n
        if at % 2:
            return order[at // 2]
        low = order[at // 2 - 1] if at else low
        high = order[at // 2] if at < 2 * len(order) else high
        turn += 1


def _literal(value: Row, rows: DataFrame, key: str) -> Column:
    kinds = rows.schema[key].dataType
    return F.struct(*[F.lit(value[f.name]).cast(f.dataType).alias(f.name) for f in kinds])


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, seed: int = 7, id_col: str = "doc_id",
             text_col: str = "text", target_text_col: str = "text", min_words: int = MIN_WORDS,
             n_buckets: int = BUCKETS) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_features``, ``weight``, ``score``, ``rank`` (1, 2, ... of the drawn; null for others).

    Of the rows with ``min_words`` words or more, ``percent`` of a hundred, rounded down, are drawn: the highest
    scores, ties to the smaller id, null ids last.  Rows equal in score and id are drawn in the order of
    features and then in any.  Null and empty texts have no features and weight 0.  Repeated rows take part
    each on their own, other columns are ignored, and an empty table gives no rows.
    """
    corpus = bucket_counts(docs, text_col, n_buckets)
    wanted = bucket_counts(target, target_text_col, n_buckets)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), as_bytes(text_col).alias("text"))
    scored = weigh(rows, gains(corpus, wanted))
    order = F.struct((-F.col("score")).alias("worse"), F.col("doc_id").isNull().alias("none"), "doc_id", "n_features",
                     F.monotonically_increasing_id().alias("row"))
    scored = stage(scored.withColumn("score", F.col("weight") + noise("doc_id", seed)).withColumn("key", order), "importance")
    eligible = scored.where(F.col("n_words") >= min_words)
    k = eligible.count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if k == 0:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    last = _literal(kth(eligible, "key", k), scored, "key")
    drawn = (F.col("n_words") >= min_words) & (F.col("key") <= last)
    winners, _ = numbered(scored.where(drawn), ["key"], "importance-winners")
    return (winners.select(*columns, (F.col("idx") + 1).alias("rank"))
            .unionByName(scored.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank"))))


__all__ = ["bucket_counts", "buckets", "gains", "kth", "noise", "resample", "weigh"]
