"""Bound-certified best-fit packing of tokenised documents into fixed-length sequences.

Pieces are dealt to buckets of bounded size and each bucket is packed by best-fit decreasing.
Dual-feasible functions give a lower bound on the bins a bucket needs: a bucket that uses no
more is certified.  Buckets with a gap give out the documents of their bins that aren't full, and
certified ones the documents of their emptiest bin (rounding slack, as the bounds of parts
add up to more than the bound of the whole); these are dealt anew to larger buckets and packed
again.  That ends when the total meets the bound over all pieces, or when a round saves no bin with one bucket of all that
was given out or, where that is too much for a task, with buckets of ``MAX_BUCKET_ROWS``.
Only lengths and ids move; every piece's tokens stay where they are until sequences are built.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, only_cache, ship, stage

#: Pieces in a bucket, about.
BUCKET_ROWS = 2048
#: Buckets of the exchange are twice as large each round, up to this.
MAX_BUCKET_ROWS = 1 << 18
#: Bytes of chunks and their ids that a task remembers, about, and bytes that a chunk takes besides its text's.
CACHE_BYTES = 256 << 20
CHUNK_BYTES = 170
#: Chunks that are encoded at once, and new ones that wait for it at most (of one text's group).
ENCODE_CHUNKS = 1 << 13
GROUP_CHUNKS = 1 << 16

#: One space between two characters that aren't white space: the tokenizer never joins what
#: stands before it to what follows, so a text may be encoded in these pieces.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_PAIRS = ("  ", "\n\n", " \n", "\n ")
_OTHER_SPACE = tuple(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")


class _Chunks(dict):
    """Numbers of chunks; a new one gets the next, and waits to be encoded."""

    def __init__(self):
        self.waiting: list = []
        self.bytes = 0

    def __missing__(self, chunk):
        self[chunk] = k = len(self)
        self.waiting.append(chunk)
        self.bytes += CHUNK_BYTES + (4 * len(chunk[0]) if isinstance(chunk, tuple) else 4 * len(chunk))
        return k


class _Grown:
    """An array that grows at its end, in place while there is room."""

    def __init__(self, kind):
        self.room, self.n = np.empty(1 << 10, kind), 0

    def add(self, values: np.ndarray) -> int:
        """Append; returns where the values begin."""
        at, self.n = self.n, self.n + len(values)
        if self.n > len(self.room):
            more = np.empty(max(self.n, len(self.room) * 3 // 2), self.room.dtype)
            more[:at] = self.room[:at]
            self.room = more
        self.room[at:self.n] = values
        return at

    @property
    def all(self) -> np.ndarray:
        return self.room[:self.n]


class ChunkTokenizer:
    """Token ids of texts by a byte-level BPE file, remembering the ids of chunks between spaces.

    The tokenizer splits a text before it merges, and never across the places used here: before a single
    space, on both sides of a single line feed, and between a letter or digit and a comma or full stop.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # in a text their strings are ordinary text
        self.feed = self._ids("\n")[0]
        self.marks = {c: ids[0] for c in ",." if len(ids := self._ids(c)) == 1}
        self._forget()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _forget(self) -> None:
        self.at = _Chunks()
        self.ids, self.first, self.size = _Grown(np.uint32), _Grown(np.int64), _Grown(np.int32)

    @staticmethod
    def _cut(text: str) -> list:
        """Chunks of a text: a tuple for one that stands behind no space, and a line feed in front of one behind it."""
        if not text:
            return []
        plain = not (text[0].isspace() or text[-1].isspace() or any(pair in text for pair in _PAIRS)
                     or any(c in text for c in _OTHER_SPACE))
        # Otherwise there is white space that isn't one space or line feed at a time.
        chunks = text.replace("\n", " \n").split(" ") if plain else _CUT.split(text)
        chunks[0] = (chunks[0],)
        return chunks

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        numbered: list[tuple[int, np.ndarray]] = []

        def give_ids() -> None:
            self._encode_waiting()
            for i, k in numbered:
                first, size = self.first.all[k], self.size.all[k]
                place = np.cumsum(size) - size
                out[i].append(self.ids.all[np.repeat(first - place, size) + np.arange(size.sum())])
            numbered.clear()

        for i, text in enumerate(texts):
            chunks = self._cut(text)
            for a in range(0, len(chunks), GROUP_CHUNKS):
                if self.at.bytes + 4 * self.ids.n > CACHE_BYTES:
                    give_ids()
                    self._forget()
                part = chunks[a:a + GROUP_CHUNKS]
                numbered.append((i, np.fromiter(map(self.at.__getitem__, part), np.int64, len(part))))
                if len(self.at.waiting) > GROUP_CHUNKS:
                    give_ids()
        give_ids()
        return [np.concatenate(x) if len(x) > 1 else x[0] if x else np.zeros(0, np.uint32) for x in out]

    def _encode_waiting(self) -> None:
        """Give ids to the chunks that wait: encoded many at once, a line each, or put together from parts."""
        known, done = self.first.n, 0
        lines, line_of, apart = [], [], []
        made_of: list[tuple] = []  # chunks that are a part and a mark behind it, or a line feed and a part
        while done < len(self.at.waiting):
            chunk = self.at.waiting[done]
            k, done = known + done, done + 1
            text = chunk[0] if isinstance(chunk, tuple) else chunk
            if len(text) > 1 and text[-1] in self.marks and text[-2].isalnum():
                rest = text[:-1]
                made_of.append((k, self.at[(rest,) if isinstance(chunk, tuple) else rest], self.marks[text[-1]]))
            elif text[:1] == "\n" and not isinstance(chunk, tuple) and text[1:] and not text[1:2].isspace():
                made_of.append((k, self.at[(text[1:],)], -1))
            elif "\n" in text or text[:1].isspace() or not text:
                apart.append((k, text if isinstance(chunk, tuple) else " " + text))
            else:
                lines.append(text if isinstance(chunk, tuple) else " " + text)
                line_of.append(k)
        self.at.waiting = []
        self.first.add(np.zeros(done, np.int64))
        self.size.add(np.full(done, -1, np.int32))
        first, size = self.first.all, self.size.all
        for a in range(0, len(lines), ENCODE_CHUNKS):
            ids = np.array(self._ids("\n".join(lines[a:a + ENCODE_CHUNKS])), np.uint32)
            ends = np.append(np.flatnonzero(ids == self.feed), len(ids))
            starts = np.append(0, ends[:-1] + 1)
            k = line_of[a:a + ENCODE_CHUNKS]
            first[k], size[k] = self.ids.add(ids) + starts, ends - starts
        for k, text in apart:
            ids = np.array(self._ids(text), np.uint32)
            first[k], size[k] = self.ids.add(ids), len(ids)
        while len(made_of):
            k, part, mark = np.array(made_of, np.int64).T
            ready = size[part] >= 0
            self._put_together(k[ready], part[ready], mark[ready])
            made_of = [m for m, r in zip(made_of, ready.tolist()) if not r]

    def _put_together(self, k: np.ndarray, part: np.ndarray, mark: np.ndarray) -> None:
        """Ids of chunks ``k``: those of ``part`` with a mark's id behind, or a line feed's (mark -1) in front."""
        first, size = self.first.all, self.size.all
        n = size[part].astype(np.int64)
        at = np.cumsum(n + 1) - n - 1
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ids = np.empty(len(within) + len(k), np.uint32)
        front = mark < 0
        ids[np.repeat(at + front, n) + within] = self.ids.all[np.repeat(first[part], n) + within]
        ids[np.where(front, at, at + n)] = np.where(front, self.feed, mark)
        first[k], size[k] = self.ids.add(ids) + at, n + 1


_TOKENIZERS: dict[str, ChunkTokenizer] = {}


def tokenizer(path: str) -> ChunkTokenizer:
    """The task's tokenizer for a file."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ChunkTokenizer(path)
    only_cache(("packing", path), _TOKENIZERS[path]._forget)
    return _TOKENIZERS[path]


def pieces(docs: DataFrame, path: str, length: int = 2048, end_id: int = 0, keep_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's ids and ``end_id`` in pieces of at most ``length``; only a first piece is shorter.

    Columns: doc_id, piece, start, length, ids_crc32, and ids where ``keep_ids``.  A null text is empty.
    """
    def run(batch):
        out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
        texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
        for doc, ids in zip(batch.column(0).to_pylist(), tokenizer(path).encode(texts)):
            ids = np.append(ids, np.uint32(end_id)).astype("<u4")
            first = len(ids) % length or length
            edges = [0, *range(first, len(ids) + 1, length)]
            for k, (a, b) in enumerate(zip(edges, edges[1:])):
                out["doc_id"].append(doc)
                out["piece"].append(k)
                out["start"].append(a)
                out["length"].append(b - a)
                out["ids_crc32"].append(zlib.crc32(ids[a:b].tobytes()))
                if keep_ids:
                    out["ids"].append(ids[a:b].astype(np.int32))
        yield out

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return map_arrow(rows, run, schema + (", ids array<int>" if keep_ids else ""))


def lower_bound(counts: np.ndarray) -> int:
    """Bins needed at least by ``counts[x]`` items of size x, capacity ``len(counts) - 1``.

    The largest of three families of dual-feasible functions: sizes rounded by a threshold, sizes
    rounded to parts of the capacity, and large sizes by the small ones that still fit beside them.
    """
    c = len(counts) - 1
    x = np.flatnonzero(counts)
    if not len(x):
        return 0
    n = counts[x].astype(np.int64)
    best = -(-int((x * n).sum()) // c)
    for e in x[2 * x <= c].tolist():
        rounded = np.where(x > c - e, c, np.where(x < e, 0, x))
        best = max(best, -(-int((rounded * n).sum()) // c))
        # In units of half an e-part: large sizes by the parts that no longer fit beside them.
        fits = c // e
        parts = np.where(2 * x > c, 2 * (fits - (c - x) // e), np.where(2 * x == c, fits, 2 * (x // e)))
        best = max(best, -(-int((parts * n).sum()) // (2 * fits)))
    for k in range(1, 40):
        whole = (k + 1) * x % c == 0
        # In units of 1 / (k * c): exact parts keep their size, others round down to k-ths.
        rounded = np.where(whole, k * x, (k + 1) * x // c * c)
        best = max(best, -(-int((rounded * n).sum()) // (k * c)))
    return best


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], int]:
    """Bin and offset of each size, best-fit in the given (decreasing) order; the number of bins."""
    at_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, bins, where, offset = 0, 0, [], []
    for s in sizes:
        fitting = open_rooms >> s
        if fitting:
            room = s + (fitting & -fitting).bit_length() - 1
            b = at_room[room].pop()
            if not at_room[room]:
                open_rooms &= ~(1 << room)
        else:
            room, b, bins = capacity, bins, bins + 1
        where.append(b)
        offset.append(capacity - room)
        if room > s:
            at_room[room - s].append(b)
            open_rooms |= 1 << (room - s)
    return where, offset, bins


def _pack(rows: DataFrame, capacity: int, buckets: int, turn: int) -> DataFrame:
    """Deal rows to buckets and pack each; adds sequence_id, offset, fill, bins, bound of its bucket."""
    dealt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id(), F.lit(turn)),
                   F.lit(buckets))

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by([("length", "descending"), ("doc_id", "ascending"),
                                              ("piece", "ascending"), ("ids_crc32", "ascending")])
        sizes = rows["length"].to_pylist()
        where, offset, bins = best_fit(sizes, capacity)
        fill = np.bincount(where, weights=sizes, minlength=bins).astype(np.int64)
        bound = lower_bound(np.bincount(sizes, minlength=capacity + 1))
        gives = fill < capacity if bins > bound else np.arange(bins) == np.argmin(fill)
        ids = (turn << 53) + (rows["bucket"][0].as_py() << 22) + np.array(where, np.int64)
        return (rows.drop_columns(["bucket"]).append_column("sequence_id", pa.array(ids))
                .append_column("offset", pa.array(offset, pa.int64()))
                .append_column("gives", pa.array(gives[where])))

    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, "
              "gives boolean")
    ship(rows.sparkSession)
    return rows.withColumn("bucket", dealt).groupBy("bucket").applyInArrow(run, schema)


def pack(rows: DataFrame, capacity: int = 2048) -> DataFrame:
    """Place every row of ``pieces`` in a sequence: adds sequence_id and offset.

    Offsets are gapless from 0 in each sequence.  Equal rows are placed each on their own;
    an empty table gives no rows.  Lengths are 1 to ``capacity``.
    """
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    sizes = {r.length: r.n for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return rows.select(*columns[:5], F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    counts = np.zeros(capacity + 1, np.int64)  # at most one entry for each length
    for s, n in sizes.items():
        counts[s] = n
    bound = lower_bound(counts)
    buckets = -(-int(counts.sum()) // BUCKET_ROWS)
    done, pool = [], stage(_pack(rows, capacity, buckets, 0), "packing")
    total = pool.agg(F.count_if(F.col("offset") == 0)).head()[0]
    turn, bucket_rows = 0, BUCKET_ROWS
    while total > bound:
        turn, bucket_rows = turn + 1, min(2 * bucket_rows, MAX_BUCKET_ROWS)
        given = pool.where("gives")
        n, used = given.agg(F.count(F.lit(1)), F.count_if(F.col("offset") == 0)).head()
        if not n:
            break
        buckets = -(-n // bucket_rows)
        again = stage(_pack(given.select(*columns[:5]), capacity, buckets, turn), "packing")
        saved = used - again.agg(F.count_if(F.col("offset") == 0)).head()[0]
        if saved > 0:
            done.append(pool.where("not gives"))
            pool, total = again, total - saved
        elif buckets == 1 or bucket_rows == MAX_BUCKET_ROWS:
            break
    for part in done:
        pool = pool.unionByName(part)
    return pool.select(*columns)


def pack_documents(docs: DataFrame, path: str, length: int = 2048, end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise and pack: one row per piece with doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the single end token; null ids are kept; repeated rows are packed
    each on their own; pieces of equal length are placed in the order of id, piece and checksum; other
    columns are ignored; an empty table gives no rows.
    """
    return pack(stage(pieces(docs, path, length, end_id, False, id_col, text_col), "pieces"), length)


def sequences(placed: DataFrame, with_ids: DataFrame) -> DataFrame:
    """``sequence_id``, ``ids``: the packed sequences, from placed pieces and ``pieces(keep_ids=True)``.

    A group is one sequence, so at most its length in tokens.  Repeated rows share their tokens.
    """
    key = ["doc_id", "piece", "ids_crc32"]
    tokens = with_ids.select(*key, "ids").dropDuplicates(key)
    same = [placed[k].eqNullSafe(tokens[k]) for k in key]
    return (placed.join(tokens, same).groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.flatten("parts.ids").alias("ids")))
