"""SimHash near-duplicates: pigeonhole blocks, join on blocks, verify the bit distance.

A fingerprint is cut into ``max_distance + 2`` blocks.  Two fingerprints at most
``max_distance`` bits apart agree on at least two blocks, so every pair of blocks
is a join key (about 32 bits for two bits of distance).  Equal fingerprints
are one class before any join.  A bucket of more than ``PAIR_BUCKET`` classes (a large
group of near copies) isn't joined pairwise: its classes go through pivots
instead.  Two fingerprints are at most 2r bits apart exactly if some pivot is within
r bits of both, so linking all classes of a pivot to the smallest of them
loses no link and makes no pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, free_name, map_arrow, stage
from .components import components

#: Classes in a bucket up to which its pairs are compared; larger ones take the exact pivot way.
PAIR_BUCKET = 32
#: Shingle hashes whose bits are counted at once (64 bytes each).
COUNT_CHUNK = 1 << 15


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text, as a signed integer.

    A-Z are lower-cased; words are split at ASCII white space.  A text of fewer words than
    a shingle is one shingle of them all; a text without words has fingerprint 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return int(np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64).view(np.int64)[0])
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:len(words) - shingle + 1].tolist(),
                                                                   ends[shingle - 1:].tolist())),
                         np.uint64, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), COUNT_CHUNK):
        part = hashes[i:i + COUNT_CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes))
    return int(bits.view(">u8").astype(np.uint64).view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id``, ``th`` (xxhash64 of the text), ``fp`` (signed long) of every row; a null text counts as empty."""
    def run(batch):
        yield {"doc_id": batch.column("doc_id"), "th": batch.column("th"),
               "fp": [fingerprint(t, shingle, seed) for t in batch.column("text").to_pylist()]}

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), as_bytes(text_col).alias("text"))
    return map_arrow(rows.select("doc_id", F.xxhash64("text").alias("th"), "text"), run, "doc_id long, th long, fp long")


def block_keys(fp, max_distance: int = 2):
    """Array of ``struct(table, key)``: the fingerprint's bits in each pair of its blocks."""
    n = max_distance + 2
    edge = [64 * i // n for i in range(n + 1)]
    keys = []
    for t, (i, j) in enumerate(combinations(range(n), 2)):
        mask = sum(((1 << (edge[k + 1] - edge[k])) - 1) << edge[k] for k in (i, j))
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(t).alias("table"), fp.bitwiseAND(F.lit(signed)).alias("key")))
    return F.array(*keys)


def links(classes: DataFrame, max_distance: int = 2) -> DataFrame:
    """Links ``u``, ``v`` that connect exactly the fingerprints at most ``max_distance`` bits apart.

    ``classes`` has one row per fingerprint ``fp``.  Pairs in small buckets are given
    themselves; in large ones each fingerprint is linked to the smallest of a pivot's, which
    gives the same components.  Large buckets need a distance of 2 (or 0).
    """
    if max_distance not in (0, 2):
        raise ValueError("max_distance is 0 or 2")
    blocks = classes.select("fp", F.inline(block_keys(F.col("fp"), max_distance)))
    sizes = blocks.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stage(blocks.join(sizes, ["table", "key"]), "simhash-members")

    small = members.where(F.col("n") <= PAIR_BUCKET)
    other = small.select("table", "key", F.col("fp").alias("v"))
    pairs = (small.select("table", "key", F.col("fp").alias("u")).join(other, ["table", "key"])
             .where((F.col("v") < F.col("u")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_distance))
             .select("u", "v"))

    # All fingerprints of large buckets meet at the pivots one flipped bit (or none) away.
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << b) - ((1 << 64) if b == 63 else 0)).cast("long")
                                             for b in range(64)])
    crowd = members.where(F.col("n") > PAIR_BUCKET).select("fp").distinct()
    pivots = stage(crowd.select("fp", F.explode(flips).alias("flip"))
                   .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("pivot")), "simhash-pivots")
    heads = pivots.groupBy("pivot").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = (pivots.join(heads.select("pivot", "v"), "pivot")
             .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("v"))).between(1, max_distance))
             .select(F.col("fp").alias("u"), "v"))
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_distance: int = 2, seed: int = 42) -> DataFrame:
    """One row per input row: ``doc_id``, ``th``, ``fp``, ``component_id``, ``root`` (a fingerprint that names the component).

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``max_distance`` differing bits, itself included; it is null where all reachable ids are
    null.  Null and empty texts have fingerprint 0 and are linked like any other.  Repeated
    rows stay repeated.  Other columns are ignored; an empty table gives no rows.
    """
    marked = stage(fingerprints(docs, id_col, text_col, shingle, seed), "simhash")
    classes = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    roots = components(links(classes, max_distance))
    rooted = (classes.join(roots, F.col("fp") == F.col("node"), "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    found = stage(rooted.join(ids, "root").select("fp", "component_id", "root"), "simhash-components")
    return marked.join(found, "fp").select("doc_id", "th", "fp", "component_id", "root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 3, max_distance: int = 2, seed: int = 42) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their component: one of each.

    That is the row with the smallest id (rows without id come last, and equal ids are ordered by text hash);
    of rows equal in id and text any one.
    """
    found = stage(near_duplicates(docs, id_col, text_col, shingle, max_distance, seed).select("doc_id", "th", "root"),
                  "simhash-found")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    chosen = found.groupBy("root").agg(F.min(order).alias("r")).select("r.doc_id", "r.th")
    repeated = not found.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    row, key = free_name("row", docs.columns), free_name("key", docs.columns)
    key_of = F.struct(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(as_bytes(text_col)).alias("th"))
    # The documents' own columns stay in one struct, so that no name of theirs meets one of the join's.
    rows = docs.select(key_of.alias(key), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row))
    keys = chosen.select(F.struct("doc_id", "th").alias("chosen_key"))
    kept = rows.join(keys, F.col(key).eqNullSafe(F.col("chosen_key")), "left_semi")
    return (kept.dropDuplicates([key]) if repeated else kept).select(f"{row}.*")
