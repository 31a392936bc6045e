"""Quality rules: base measures of a text, and the frequency of its lines across the documents of a host.

1. *Measure* (no shuffle): words, symbols, repeated lines and repeated runs of words of each whole text, and
   the 64-bit hashes of its normalised lines with the words under each.
2. *Count*: in how many distinct documents of the host a line stands.  Equal texts are one document, so a
   group of copies doesn't make its own lines common.  The count is combined before each shuffle and
   goes by (host, line, text) first, so neither a hot host nor a hot line meets in one task.
3. *Remove and reject*: lines over both limits, more than ``min_docs`` documents and more than a
   ``share`` of the host's, go out; a document that loses more than ``depleted`` of its words is rejected.

A line is normalised to its words joined by one space with A-Z lower-cased; lines without a word don't count.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, map_arrow, stage

#: Symbols that the base measures count.
SYMBOLS = b"#*$%&|<>"
#: Fewer words than these fail the base rule.
MIN_WORDS = 20
#: Length of the windows whose repeats are counted, and the percentage of words under them that is too many.
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
#: A line goes if it is in more documents of its host than both limits.
LINE_DOCS = 20
LINE_SHARE = 0.01
#: Share of words whose loss rejects a document.
DEPLETED = 0.5

_NOT_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)
_CONTINUATION = bytes(range(0x80, 0xC0))


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words under windows of ``window`` words whose sequence stands twice or more, overlaps included."""
    n = len(words)
    if n <= window:
        return 0
    number: dict[bytes, int] = {}
    runs = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    # Numbers of ever longer runs: two equal runs have equal numbers, exactly.
    length = 1
    while length < window:
        step = min(length, window - length)  # the second run may overlap the first
        pairs = runs[:len(runs) - step] * (n + 1) + runs[step:]
        runs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        length += step
    twice = np.bincount(runs) > 1
    depth = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice[runs])
    depth[at] += 1
    depth[at + window] -= 1
    return int((np.cumsum(depth)[:n] > 0).sum())


def line_hash(line: list[bytes]) -> int:
    """Signed 64-bit hash of a normalised line."""
    return xxhash.xxh64_intdigest(b" ".join(line).lower(), 11) - (1 << 63)


def measure(docs: DataFrame, window: int = REPEAT_WINDOW) -> DataFrame:
    """Base measures and lines of each row: uid, doc_id, host, th, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words and lines (array of hash and words, one entry for each distinct line)."""
    def run(batch):
        out = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines")}
        for text in batch.column("text").to_pylist():
            seen: set[bytes] = set()
            repeats, words, under = 0, [], {}
            for line in text.split(b"\n"):
                own = line.split()
                if not own:
                    continue
                words += own
                if line in seen:
                    repeats += 1
                seen.add(line)
                h = line_hash(own)
                under[h] = under.get(h, 0) + len(own)
            out["n_words"].append(len(words))
            # Characters of words: all bytes that don't continue one.
            out["word_chars"].append(sum(map(len, map(bytes.translate, words, repeat(None), repeat(_CONTINUATION)))))
            out["n_symbols"].append(len(text.translate(None, _NOT_SYMBOLS)))
            out["n_dup_lines"].append(repeats)
            out["n_repeat_words"].append(repeated_words(words, window))
            out["lines"].append([{"h": h, "words": n} for h, n in under.items()])
        yield out | {k: batch.column(k) for k in ("uid", "doc_id", "host", "th")}

    return map_arrow(docs, run, "uid long, doc_id long, host string, th long, n_words long, word_chars long, n_symbols long, "
                                "n_dup_lines long, n_repeat_words long, lines array<struct<h: long, words: long>>")


def common_lines(measured: DataFrame, min_docs: int = LINE_DOCS, share: float = LINE_SHARE) -> DataFrame:
    """``host``, ``h`` of the lines in more than ``min_docs`` documents and more than ``share`` of their host's."""
    lines = measured.select("host", "th", F.explode("lines.h").alias("h"))
    counts = lines.groupBy("host", "h").agg(F.count_distinct("th").alias("n")).where(F.col("n") > min_docs)
    hosts = measured.groupBy("host").agg(F.count_distinct("th").alias("docs"))
    return counts.join(hosts, "host").where(F.col("n") > share * F.col("docs")).select("host", "h")


def _judged(docs: DataFrame, id_col: str, text_col: str, host_col: str, min_docs: int, share: float,
            depleted: float) -> DataFrame:
    host: Column = F.coalesce(F.concat(F.lit("v"), F.col(host_col).cast("string")), F.lit("n"))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"),
                       host.alias("host"), as_bytes(text_col).alias("text"))
    measured = stage(measure(rows.withColumn("th", F.xxhash64("text"))), "lines")
    common = stage(common_lines(measured, min_docs, share), "lines-common")
    gone = (measured.select("uid", "host", F.inline("lines")).join(common, ["host", "h"])
            .groupBy("uid").agg(F.sum("words").alias("n_removed"), F.collect_list("h").alias("removed")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return (measured.drop("lines").join(gone, "uid", "left")
            .withColumn("n_removed", F.coalesce("n_removed", F.lit(0)))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("n_removed") <= depleted * F.col("n_words"))))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          min_docs: int = LINE_DOCS, share: float = LINE_SHARE, depleted: float = DEPLETED) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``n_removed`` (words on common lines) and ``kept``.

    Words are split at ASCII white space.  A null text has no words and fails the base rule, as an empty one; a null
    host is a host of its own; null ids are kept as they are.  Repeated rows stay repeated and
    count as one document in a line's frequency.  A line exactly at a limit stays.  Other columns are ignored; an empty
    table gives no rows.
    """
    found = _judged(docs, id_col, text_col, host_col, min_docs, share, depleted)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        "n_removed", "kept")


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          min_docs: int = LINE_DOCS, share: float = LINE_SHARE, depleted: float = DEPLETED) -> DataFrame:
    """``doc_id``, ``text``: the kept documents without their hosts' common lines.

    Nulls, ties and repeated rows are treated as by ``judge``; a line goes with the line feed behind it.
    """
    found = _judged(docs, id_col, text_col, host_col, min_docs, share, depleted)
    decided = stage(found.where("kept").groupBy("host", "th").agg(F.first("removed").alias("removed")), "lines-removed")
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), as_bytes(text_col).alias("text"),
                       F.coalesce(F.concat(F.lit("v"), F.col(host_col).cast("string")), F.lit("n")).alias("host"))
    kept = kept.withColumn("th", F.xxhash64("text")).join(decided, ["host", "th"])

    def run(batch):
        texts = []
        for text, removed in zip(batch.column("text").to_pylist(), batch.column("removed").to_pylist()):
            gone = set(removed or ())
            lines = text.split(b"\n") if gone else [text]
            texts.append(b"\n".join([x for x in lines if not gone or not (own := x.split()) or line_hash(own) not in gone])
                         .decode("utf-8", "replace"))
        yield {"doc_id": batch.column("doc_id"), "text": texts}

    return map_arrow(kept.select("doc_id", "text", "removed"), run, "doc_id long, text string")


__all__ = ["clean", "common_lines", "judge", "line_hash", "measure", "repeated_words"]
