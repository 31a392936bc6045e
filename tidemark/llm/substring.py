"""Substring dedup by repeated-phrase automata.

A window of ``window`` words is removed where its word sequence also starts in a
document with a smaller id.  Comparing all windows would shuffle one row per word, so
the operator finds recurring passages first:

1. *Scan*: every window has an anchor, its phrase of ``phrase`` words with the smallest hash.  Equal
   windows have equal anchors, and neighbouring windows mostly share one, so only one
   phrase in about twenty is an anchor.  Documents of equal words are one class.
2. *Confirm*: anchors in two or more documents recur (one aggregate, combined before the
   shuffle).  The phrases themselves, as 32-bit numbers of their words, go on.
3. *Locate*: all documents that have such phrases are streamed in bounded groups; each
   group compiles an Aho-Corasick automaton over words of the recurring phrases its documents carry, and
   the automaton finds every occurrence in them, whether it is an anchor there or not.  The automata are thus sharded with the
   documents: none grows with the corpus, and a very common phrase is one pattern of each.  A document without a recurring phrase has no
   window that recurs.
4. *Compare*: a window belongs to the occurrence inside it with the smallest phrase hash; where the window recurs that is its
   anchor, wherever it stands.  Windows without an occurrence are left alone.  Windows under one occurrence form a run.  Equal runs are settled by one row
   per run; only runs of anchors that occur with several different surroundings
   are compared window by window.

Runs and windows are compared by (anchor, 64-bit hash) under two independent hashes, 128 bits in all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import ahocorasick
import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, free_name, map_arrow, only_cache, stage, unstage

#: Odd base of the polynomial hashes (mod 2**64) and its inverse.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
#: Distinct words whose hashes a task remembers.
WORD_CACHE = 1 << 17


class WordHashes(dict):
    """64-bit hashes of words, remembered up to ``WORD_CACHE`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word, 7)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_HASHES = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Hashes of words by the worker's own cache (a task's closure would hold a copy of it)."""
    only_cache("substring", _HASHES.clear)
    return _HASHES.of(words)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A second, well spread hash of 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def span_hashes(values: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of every run of ``length`` values, the same wherever it stands."""
    n = len(values)
    if n < length:
        return np.zeros(0, np.uint64)
    power = np.full(n + 1, BASE, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    back = np.full(n - length + 1, BASE_INVERSE, np.uint64)
    back[0] = 1
    back = np.multiply.accumulate(back)
    prefix = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate(values * power[:n])))
    return (prefix[length:] - prefix[:n - length + 1]) * back


def anchor_positions(values: np.ndarray, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window the start of its anchor, and the hash of every phrase.

    The anchor is the leftmost phrase of the window with the smallest (remixed) hash.
    """
    grams = _mixed(span_hashes(values, phrase))
    width = window - phrase + 1
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), grams
    # Sliding minimum: running minima from the left and from the right of blocks of one width.
    order = np.argsort(grams, kind="stable")
    rank = np.empty(len(grams), np.int64)
    rank[order] = np.arange(len(grams))  # equal hashes: the leftmost ranks first
    padded = np.full(-(-len(grams) // width) * width, len(grams), np.int64)
    padded[:len(grams)] = rank
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    best = np.minimum(right[:n], left[width - 1:width - 1 + n])
    return order[best], grams


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def scan(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """Per row: its id, text hash, number of words, SHA-256 of the words, distinct anchor phrases (32 bits a word)."""
    def run(batch):
        counts, shas, anchors = [], [], []
        for text in batch.column("text").to_pylist():
            words = text.split()
            counts.append(len(words))
            shas.append(hashlib.sha256(b" ".join(words)).hexdigest())
            anchors.append(anchor_phrases(word_hashes(words), window, phrase) if len(words) >= window else [])
        yield {"doc_id": batch.column("doc_id"), "th": batch.column("th"), "n_words": counts, "sha": shas,
               "anchors": anchors}

    return map_arrow(docs, run, "doc_id long, th long, n_words long, sha string, anchors array<binary>")


def anchor_phrases(values: np.ndarray, window: int, phrase: int) -> list[bytes]:
    """The distinct anchors of a text's windows, as the words' 32-bit numbers one after the other."""
    at, _ = anchor_positions(values, window, phrase)
    words = np.lib.stride_tricks.sliding_window_view(values.astype("<u4"), phrase)[np.unique(at)]
    return sorted({w.tobytes() for w in words})


def automaton_of(phrases: Iterable[bytes]) -> ahocorasick.Automaton:
    """An automaton that finds every occurrence of the phrases; its characters are the bytes of the words' numbers."""
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k, p in enumerate(phrases):
        found.add_word(p.decode("latin-1"), k)
    found.make_automaton()
    return found


def occurrences(automaton: ahocorasick.Automaton, values: np.ndarray, phrase: int) -> np.ndarray:
    """Sorted places in a text (of word hashes) where a phrase of the automaton begins."""
    if not len(automaton):
        return np.zeros(0, np.int64)
    numbers = values.astype("<u4").tobytes().decode("latin-1")
    behind = np.fromiter((end for end, _ in automaton.iter(numbers)), np.int64) + 1
    return behind[behind % 4 == 0] // 4 - phrase  # others begin within a word


def chosen_occurrences(hits: np.ndarray, grams: np.ndarray, windows: int, width: int) -> np.ndarray:
    """For each window the place of the occurrence inside with the smallest phrase hash (the leftmost of equal ones); -1 without any.

    ``width`` is the number of phrases in a window.  Of a window that recurs this is its anchor, as every
    anchor of its text that recurs is a phrase of the automaton.
    """
    order = hits[np.lexsort((hits, grams[hits]))]
    rank = np.full(len(grams), len(order), np.int64)
    rank[order] = np.arange(len(order))
    padded = np.full(-(-len(grams) // width) * width, len(order), np.int64)
    padded[:len(grams)] = rank
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    best = np.minimum(right[:windows], left[width - 1:width - 1 + windows])
    return np.append(order, -1)[best]


def runs(values: np.ndarray, automaton: ahocorasick.Automaton, window: int, phrase: int) -> list[tuple]:
    """(anchor, run hash, first window, hashes of its windows) of each run of windows under one occurrence."""
    n = len(values) - window + 1
    hits = occurrences(automaton, values, phrase) if n > 0 else np.zeros(0, np.int64)
    if not len(hits):
        return []
    grams = _mixed(span_hashes(values, phrase))
    at = chosen_occurrences(hits, grams, n, window - phrase + 1)
    hashes = span_hashes(_mixed(values), window)
    edges = np.flatnonzero(np.diff(at)) + 1
    found = []
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), n]):
        if at[a] >= 0:
            own = hashes[a:b]
            found.append((int(_signed(grams[at[a]:at[a] + 1])[0]),
                          xxhash.xxh64_intdigest(own.tobytes(), 1) - (1 << 63), a, _signed(own)))
    return found


def locate(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """Runs of windows under an occurrence of a recurring phrase, of texts with the ``recurring`` phrases of theirs.

    Each group of texts (a slice of a batch) has an automaton of all its recurring phrases: a shard whose size
    the slice bounds.  It is run over every text of the group, and its occurrences decide.
    """
    def run(batch):
        automaton = automaton_of({p for own in batch.column("recurring").to_pylist() for p in own})
        cols = {k: [] for k in ("doc_id", "th", "anchor", "run", "start", "windows")}
        ids, ths = batch.column("doc_id").to_pylist(), batch.column("th").to_pylist()
        for k, text in enumerate(batch.column("text").to_pylist()):
            for anchor, own, start, windows in runs(word_hashes(text.split()), automaton, window, phrase):
                for name, value in zip(cols, (ids[k], ths[k], anchor, own, start, windows)):
                    cols[name].append(value)
        yield cols

    return map_arrow(docs, run, "doc_id long, th long, anchor long, run long, start int, windows array<long>")


def removed_ranges(docs: DataFrame, window: int, phrase: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scan rows, texts with recurring phrases, and the word ranges to remove of the latter (each staged)."""
    scanned = stage(scan(docs, window, phrase), "substring-scan")
    long_enough = scanned.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    firsts = long_enough.groupBy("sha").agg(F.min("doc_id").alias("first"))
    base = stage(scanned.drop("anchors").join(firsts, "sha", "left")
                 .withColumn("copy", F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))).drop("first"),
                 "substring-base")
    # One row per class and anchor: copies of a whole document need no automaton.
    kinds = (long_enough.groupBy("sha").agg(F.min(F.struct("doc_id", "th", "anchors")).alias("k"))
             .select("k.doc_id", "k.th", F.explode("k.anchors").alias("phrase")))
    anchors = stage(kinds, "substring-anchors")
    unstage(scanned)
    recurring = (anchors.groupBy("phrase").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
                 .where("a < b").select("phrase"))
    # Staged apart from the texts' and the windows' joins: no job holds the shuffles of both on disk.
    wanted = stage(anchors.join(recurring, "phrase").groupBy("doc_id", "th").agg(F.collect_list("phrase").alias("recurring")),
                   "substring-wanted")
    unstage(anchors)
    texts = stage(docs.join(wanted, ["doc_id", "th"]).dropDuplicates(["doc_id", "th"]), "substring-texts")
    unstage(wanted)

    runs = stage(locate(texts, window, phrase), "substring-runs")
    kinds = runs.groupBy("anchor", "run").agg(F.min("doc_id").alias("first"))
    kinds = stage(kinds, "substring-kinds")
    whole = (runs.select("doc_id", "th", "anchor", "run", "start", F.size("windows").alias("n"))
             .join(kinds, ["anchor", "run"]).where(F.col("first") < F.col("doc_id"))
             .select("doc_id", "th", "start", (F.col("start") + F.col("n") + window - 1).alias("end")))
    # Anchors with several different runs: the first document of each run, window by window.
    several = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    open_runs = (runs.join(kinds.join(several, "anchor"), ["anchor", "run"])
                 .where(F.col("first") == F.col("doc_id"))
                 .select("doc_id", "th", "anchor", "start", F.posexplode("windows").alias("i", "w")))
    open_runs = stage(open_runs, "substring-windows")
    heads = stage(open_runs.groupBy("anchor", "w").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
                  .where("a < b").select("anchor", "w", "a"), "substring-heads")
    single = (open_runs.join(heads, ["anchor", "w"]).where(F.col("a") < F.col("doc_id"))
              .select("doc_id", "th", (F.col("start") + F.col("i")).alias("start"),
                      (F.col("start") + F.col("i") + window).alias("end")))
    ranges = stage(whole.unionByName(single).groupBy("doc_id", "th")
                   .agg(F.collect_list(F.struct("start", "end")).alias("ranges")), "substring-ranges")
    unstage(runs, kinds, open_runs, heads)
    return base, texts, ranges


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                window: int = 50, phrase: int = 8) -> DataFrame:
    """One row per input row: ``doc_id``, ``th`` (xxhash64 of the text), ``n_words``, ``n_removed``,
    ``kept_sha256`` and ``kept`` (the kept words joined by one space; null if nothing goes).

    A word goes if a window covers it whose word sequence also starts in a document
    with a smaller id.  Words are split at ASCII white space.  Null texts have no words; a
    row with a null id neither loses words nor takes any; rows of one id don't
    take words from each other, and repeated rows stay repeated.  Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), as_bytes(text_col).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("th"), "text")
    base, texts, ranges = removed_ranges(rows, window, phrase)

    def cut(batch):
        out = {k: [] for k in ("n_removed", "new_sha", "kept")}
        starts, ends = ([[r[k] for r in row] for row in batch.column("ranges").to_pylist()] for k in ("start", "end"))
        for text, a, b in zip(batch.column("text").to_pylist(), starts, ends):
            words = text.split()
            depth = np.zeros(len(words) + 1, np.int64)
            np.add.at(depth, a, 1)
            np.add.at(depth, b, -1)
            kept = np.flatnonzero(np.cumsum(depth)[:-1] == 0)
            rest = b" ".join([words[i] for i in kept.tolist()])
            out["n_removed"].append(len(words) - len(kept))
            out["new_sha"].append(hashlib.sha256(rest).hexdigest())
            out["kept"].append(rest.decode("utf-8", "replace"))
        yield out | {k: batch.column(k) for k in ("doc_id", "th")}

    changed = map_arrow(texts.select("doc_id", "th", "text").join(ranges, ["doc_id", "th"]), cut,
                        "doc_id long, th long, n_removed long, new_sha string, kept string")
    changed = stage(changed, "substring-changed")
    unstage(texts, ranges)
    empty = hashlib.sha256(b"").hexdigest()
    gone = F.col("copy")
    return (base.join(changed, ["doc_id", "th"], "left")
            .select("doc_id", "th", "n_words",
                    F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                    F.when(gone, F.lit(empty)).otherwise(F.coalesce("new_sha", "sha")).alias("kept_sha256"),
                    F.when(gone, F.lit("")).otherwise(F.col("kept")).alias("kept")))


def cut_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = "n_chars",
              window: int = 50, phrase: int = 8) -> DataFrame:
    """All rows of ``docs``, all columns; a text that loses words becomes its kept words joined by one space.

    ``size_col``, where there is such a column, is set to the new length.  Texts that lose nothing stay as they are,
    and a row that loses all its words stays with an empty text.
    """
    found = deduplicate(docs, id_col, text_col, window, phrase)
    changed = (found.where("kept is not null").select(F.struct("doc_id", "th").alias("changed_key"), "kept")
               .dropDuplicates(["changed_key"]).select("changed_key", F.struct("kept").alias("new")))
    row, key = free_name("row", docs.columns), free_name("key", docs.columns)
    key_of = F.struct(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(as_bytes(text_col)).alias("th"))
    # The documents' own columns stay in one struct, so that no name of theirs meets one of the join's.
    rows = docs.select(key_of.alias(key), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row))
    joined = rows.join(changed, F.col(key) == F.col("changed_key"), "left")
    columns = []
    for c in docs.columns:
        own, kept = F.col(row)[c], F.col("new")["kept"]
        if c == text_col:
            own = F.coalesce(kept, own)
        elif size_col is not None and c == size_col:
            own = F.when(kept.isNull(), own).otherwise(F.length(kept)).cast(docs.schema[c].dataType)
        columns.append(own.alias(c))
    return joined.select(*columns)
