"""Exact top-k inner-product search by distributed histogram selection.

Queries and candidates are packed into blocks of vectors, and each query block meets each
candidate block once (the query set is stated by the caller and grows with the table,
so it's never broadcast).  Rounds of counting then narrow, for every query at
once, the range that holds its kth score: a task scores its block pair and counts scores in
256 bins of the query's range, the counts are added up, and the bin of the kth score is
the next range.  When ranges are one integer wide, a last pass keeps the scores above the kth
and, of equal ones, the smallest ids.  Tasks send only bins at or above their own kth score: the
global kth is never below it, so the sums that matter are complete.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, ship, stage

#: Candidate vectors and query vectors in a block at most; there are ``MIN_BLOCKS`` candidate blocks or more.
BLOCK_ROWS, QUERY_ROWS, MIN_BLOCKS = 16384, 4096, 16
#: Scores computed at once, 2 to 8 bytes each.
TILE_SCORES = 1 << 21
BINS_LOG2 = 8


def quantise(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """``id``, ``v``: floor(scale * x) of each component, computed in doubles.

    Rows with a null id or vector, or a null or non-finite component, are left out.
    """
    x = F.col("v")
    return (df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & x.isNotNull()
                   & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
            .select("id", F.transform(x, lambda c: F.floor(F.lit(scale) * c).cast("long")).alias("v")))


def _blocks(rows: DataFrame, blocks: int, dims: int, dtype: str) -> DataFrame:
    """``block``, ``ids``, ``m``: all rows of each of ``blocks`` even parts, ordered by id, as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts = [], []
        for b in batches:
            ids.append(b.column(0).to_numpy(zero_copy_only=False))
            vectors = b.column(1)
            part = np.zeros((b.num_rows, dims), dtype)
            sizes = np.diff(vectors.offsets.to_numpy())
            part[np.arange(dims) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
            parts.append(part)
        if not ids:
            return
        every = np.concatenate(ids)
        order = np.argsort(every, kind="stable")
        yield pa.RecordBatch.from_pydict({
            "block": pa.array([TaskContext.get().partitionId()], pa.int32()),
            "ids": pa.array([every[order].astype(np.int64).tobytes()], pa.binary()),
            "m": pa.array([np.concatenate(parts)[order].tobytes()], pa.binary())})

    ship(rows.sparkSession)
    return rows.repartition(blocks).mapInArrow(run, "block int, ids binary, m binary")


def _scores(ids_q: np.ndarray, q: np.ndarray, ids_c: np.ndarray, c: np.ndarray):
    """Tiles (first query, scores as integers, whether a candidate is the query's own)."""
    step = max(1, TILE_SCORES // max(1, len(ids_c)))
    for i in range(0, len(ids_q), step):
        s = q[i:i + step] @ c.T
        yield i, s.astype(np.int64), ids_q[i:i + step, None] == ids_c[None, :]


def _unpack(row: dict, dims: int, dtype: str):
    return (np.frombuffer(row["ids"], np.int64), np.frombuffer(row["m"], dtype).reshape(-1, dims),
            np.frombuffer(row["c_ids"], np.int64), np.frombuffer(row["c_m"], dtype).reshape(-1, dims))


def _starts(row: dict, n: int, low: int) -> np.ndarray:
    """The range starts of a block's queries; ``low`` for those that have no candidate."""
    starts = np.full(n, low, np.int64)
    known = row.get("starts") or []
    starts[:len(known)] = known
    return starts


def top_k(df: DataFrame, k: int = 20, is_query: Column | None = None, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """Each query's ``k`` best rows: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Queries are the rows where ``is_query`` (on column ``id``; by default ids divisible by 20) holds;
    candidates are all rows but those with the query's own id.  Scores are inner products of the
    quantised vectors, a shorter vector counting as zero where it has no component, and must fit a long.
    Ties go to the smaller id.  Rows with a null id or vector, or a null or non-finite component,
    take no part; an id that repeats is a query and a candidate as often as it stands there.  Other
    columns are ignored; an empty table gives no rows.
    """
    spark = df.sparkSession
    is_query = F.col("id") % 20 == 0 if is_query is None else is_query
    rows = stage(quantise(df, id_col, vector_col, scale), "topk-vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, n_q, dims, reach = rows.agg(F.count(F.lit(1)), F.count_if(is_query), F.max(F.size("v")), F.max(norm)).head()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n_q:
        return empty
    bound = int(reach) + 1  # no inner product is larger than the largest square sum
    dims = max(1, dims)
    dtype = "f4" if bound < 1 << 24 else "f8" if bound < 1 << 53 else "i8"
    parts = max(-(-n // BLOCK_ROWS), min(MIN_BLOCKS, -(-n // 256)))
    candidates = stage(_blocks(rows, parts, dims, dtype), "topk-candidates")
    queries = stage(_blocks(rows.where(is_query), -(-n_q // QUERY_ROWS), dims, dtype), "topk-queries")
    met = (candidates.select(F.col("block").alias("part"), F.col("ids").alias("c_ids"), F.col("m").alias("c_m"))
           .repartition(parts, "part"))
    sent = queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def with_ranges(ranges: DataFrame | None) -> DataFrame:
        """Every block pair; the query's range starts, ordered as the queries, beside it."""
        left = sent if ranges is None else sent.join(ranges, "block")
        return left.repartition(parts, "part").join(met, "part")

    width, low, ranges = (2 * bound + 1).bit_length(), -bound, None  # of the ranges, as a power of two
    while width:
        shift = max(0, width - BINS_LOG2)
        counted = stage(map_arrow(with_ranges(ranges), _counter(k, dims, dtype, 1 << (width - shift), shift, low),
                                  "block int, pos int, bin int, n long"), "topk-counts")
        ranges, width = stage(_narrow(counted, ranges, k, shift, low), "topk-ranges"), shift
    found = map_arrow(with_ranges(ranges), _collector(k, dims, dtype, low),
                      "block int, pos int, query_id long, vec_id long, score long")
    order = Window.partitionBy("block", "pos").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _counter(k: int, dims: int, dtype: str, bins: int, shift: int, low: int):
    def run(batch):
        out = {name: [] for name in ("block", "pos", "bin", "n")}
        for row in batch.to_pylist():
            ids_q, q, ids_c, c = _unpack(row, dims, dtype)
            starts = _starts(row, len(ids_q), low)
            for i, s, own in _scores(ids_q, q, ids_c, c):
                b = (s - starts[i:i + len(s), None]) >> shift
                over = ((b >= bins) & ~own).sum(axis=1)
                valid = (b >= 0) & (b < bins) & ~own
                flat = (b + np.arange(len(s))[:, None] * bins)[valid]
                h = np.bincount(flat, minlength=len(s) * bins).reshape(len(s), bins)
                before = over[:, None] + np.cumsum(h[:, ::-1], axis=1)[:, ::-1] - h  # scores in higher bins
                pos, at = np.nonzero((h > 0) & (before < k))
                out["block"].append(np.full(len(pos), row["block"]))
                out["pos"].append(pos + i)
                out["bin"].append(at)
                out["n"].append(h[pos, at])
        yield {name: np.concatenate(v) if v else [] for name, v in out.items()}

    return run


def _narrow(counted: DataFrame, ranges: DataFrame | None, k: int, shift: int, low: int) -> DataFrame:
    """Per query block: each query's new range start, and how many scores it has above that range."""
    # A query with fewer scores than k ends at its lowest one.
    sums = counted.groupBy("block", "pos", "bin").agg(F.sum("n").alias("n"))
    if ranges is None:
        sums = sums.select("*", F.lit(low).cast("long").alias("start"), F.lit(0).cast("long").alias("above"))
    else:
        old = ranges.select("block", F.posexplode(F.arrays_zip("starts", "aboves")).alias("pos", "r"))
        sums = sums.join(old.select("block", "pos", F.col("r.starts").alias("start"), F.col("r.aboves").alias("above")),
                         ["block", "pos"])
    down = Window.partitionBy("block", "pos").orderBy(F.desc("bin"))
    before = F.col("above") + F.sum("n").over(down) - F.col("n")
    chosen = (sums.withColumn("before", before).where(F.col("before") < k).groupBy("block", "pos")
              .agg(F.min_by(F.struct(F.col("start").alias("from"), "bin", "before"), "bin").alias("b"))
              .select("block", "pos", (F.col("b.from") + F.col("b.bin").cast("long") * (1 << shift)).alias("starts"),
                      F.col("b.before").alias("aboves")))
    # Queries without any candidate keep their place: a map by position fills the array.
    packed = chosen.groupBy("block").agg(F.map_from_entries(F.collect_list(
        F.struct("pos", F.struct("starts", "aboves")))).alias("at"), F.max("pos").alias("last"))
    get = F.transform(F.sequence(F.lit(0), F.col("last")), lambda p: F.col("at")[p])
    return packed.select("block", get.alias("all")).select(
        "block", F.transform("all", lambda r: F.coalesce(r["starts"], F.lit(low).cast("long"))).alias("starts"),
        F.transform("all", lambda r: F.coalesce(r["aboves"], F.lit(0).cast("long"))).alias("aboves"))


def _collector(k: int, dims: int, dtype: str, low: int):
    def run(batch):
        out = {name: [] for name in ("block", "pos", "query_id", "vec_id", "score")}
        for row in batch.to_pylist():
            ids_q, q, ids_c, c = _unpack(row, dims, dtype)
            starts = _starts(row, len(ids_q), low)
            for i, s, own in _scores(ids_q, q, ids_c, c):
                for j in range(len(s)):
                    kth = starts[i + j]
                    # Candidates are ordered by id, so the first ties are those that can win.
                    above = np.flatnonzero((s[j] > kth) & ~own[j])
                    ties = np.flatnonzero((s[j] == kth) & ~own[j])[:max(0, k - len(above))]
                    at = np.concatenate((above, ties))
                    out["block"].append(np.full(len(at), row["block"]))
                    out["pos"].append(np.full(len(at), i + j))
                    out["query_id"].append(np.full(len(at), ids_q[i + j]))
                    out["vec_id"].append(ids_c[at])
                    out["score"].append(s[j][at])
        yield {name: np.concatenate(v) if v else [] for name, v in out.items()}

    return run
