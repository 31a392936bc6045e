"""Large multi-line CSV files read by many tasks (operator A1).

A multi-line file can't be split at any line break, as it may stand inside quotes.  Whether it does is
decided by composing states: a range of the file takes each state at its start (between records, inside
quotes) to a state at its end.  One pass over the ranges gives these small functions, a fold per file over them
gives the exact state at every range's start, and a second pass writes each range's whole records to part files.
A record that goes over range edges is put together from its pieces.  Spark's own multi-line reader then
reads the parts, so a field is parsed by the same code as in a whole file.

The states cover what the exporter writes: CRLF row ends, quotes around whole fields, doubled inside.  Where a
file leaves that (a bare line feed outside quotes, text behind a closing quote, a byte order mark, an end inside quotes),
what the reader makes of it depends on the place in its buffer; such a file has no exact cut and stays whole.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path, ship_code

#: Line end of the export format; ranges are read as lines between these.
LINE_END = "\r\n"
#: Ranges whose states are sent to all tasks at once (some 150 bytes each); more files are cut in further passes.
PASS_RANGES = 1 << 16
#: Bytes of whole records that a row of a part holds, about.
CHUNK_BYTES = 1 << 20

BETWEEN, INSIDE, UNKNOWN = 0, 1, 2
#: Folder number of the pieces of records that go over range edges.
EDGES = -1
#: Partition column of the parts, the number of their landing folder; no model has such a name.
PART_FOLDER = "part__folder"
_ROWS = pa.schema([("folder_no", pa.int32()), ("k", pa.int32()), ("value", pa.binary())])

_TEXT = rb'[^"]*+(?:""[^"]*+)*+'  # inside quotes
_FIELD = rb'(?:"' + _TEXT + rb'"[ \t]*+|[^",\n][^,\n]*+)?'
_WHOLE = rb"(?:" + _FIELD + rb",)*+" + _FIELD + rb"\Z"
_CLEAN = rb'(?:"' + _TEXT + rb'"[ \t]*+|[^",\n]++)?'  # behind a quote within a plain field it isn't sure that the next one opens
_OPEN = rb"(?:" + _CLEAN + rb',)*+"' + _TEXT + rb"\Z"
#: Of a line by the state at its start: what ends it between records, and what ends it inside quotes.
_LINES = ((re.compile(_WHOLE), re.compile(_OPEN)),
          (re.compile(_TEXT + rb'"[ \t]*+(?:\Z|,' + _WHOLE + rb")"),
           re.compile(_TEXT + rb'(?:\Z|"[ \t]*+,' + _OPEN + rb")")))


def state_after(state: int, line: bytes) -> int:
    """The state behind a line (without its end) that begins in ``state``."""
    if state == UNKNOWN:
        return UNKNOWN
    whole, is_open = _LINES[state]
    return INSIDE if is_open.match(line) else BETWEEN if whole.match(line) else UNKNOWN


def _lines(spark: SparkSession, files: Sequence[str], range_bytes: int) -> DataFrame:
    """The files' lines in ranges of ``range_bytes`` at most: path, size, start (of the range), line."""
    own = spark.newSession()  # its own scan settings; the caller's stay
    own.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    at = "_metadata"
    return own.read.option("lineSep", LINE_END).text(list(files)).select(
        F.col(f"{at}.file_path").alias("path"), F.col(f"{at}.file_size").alias("size"),
        F.col(f"{at}.file_block_start").alias("start"), F.col("value").cast("binary").alias("line"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, list[bytes]]]:
    """A batch's lines by range: the other columns' values, the lines.  A range's rows stand together."""
    others = [batch.column(k).to_pylist() for k in range(batch.num_columns - 1)]
    lines = batch.column(batch.num_columns - 1).to_pylist()
    begin = 0
    for k in range(1, len(lines) + 1):
        if k == len(lines) or any(o[k] != o[begin] for o in others):
            yield tuple(o[begin] for o in others), lines[begin:k]
            begin = k


def range_functions(lines: DataFrame) -> DataFrame:
    """One row per range: path, size, start, lines, bytes, the state behind it by the state before it
    (from_between, from_inside), and whether a record ends in it that began before it (closes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "size", "start", "lines", "bytes", "from_between", "from_inside", "closes"]
        now, rest = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({n: [v] for n, v in zip(names, (*now, *rest))}, schema=schema)

        for batch in batches:
            for key, own in _runs(batch):
                if key != now:
                    if now is not None:
                        yield row()
                    now, rest = key, [0, 0, BETWEEN, INSIDE, False]
                for line in own:
                    rest[0] += 1
                    rest[1] += len(line)
                    one, other = rest[2], rest[3]
                    rest[2] = state_after(one, line)
                    rest[3] = rest[2] if other == one else state_after(other, line)
                    rest[4] = rest[4] or rest[3] == BETWEEN
        if now is not None:
            yield row()

    schema = pa.schema([("path", pa.string()), ("size", pa.int64()), ("start", pa.int64()), ("lines", pa.int64()),
                        ("bytes", pa.int64()), ("from_between", pa.int32()), ("from_inside", pa.int32()),
                        ("closes", pa.bool_())])
    return lines.mapInArrow(run, "path string, size long, start long, lines long, bytes long, from_between int, "
                                 "from_inside int, closes boolean")


def exact_states(functions: DataFrame) -> DataFrame:
    """Per range: path, start, state before it, owner (the range where the record open there began), and exact
    (whether its whole file can be cut)."""
    ranges = F.array_sort(F.collect_list(F.struct("start", "from_between", "from_inside", "closes")))
    files = functions.groupBy("path", "size").agg(ranges.alias("ranges"), F.sum("bytes").alias("bytes"),
                                                  F.sum("lines").alias("lines"))
    begin = F.expr("named_struct('state', 0, 'owner', -1L, 'seen', cast(array() as array<struct<start: bigint, "
                   "state: int, owner: bigint>>))")

    def step(acc, r):
        state = (F.when(acc["state"] == BETWEEN, r["from_between"]).when(acc["state"] == INSIDE, r["from_inside"])
                 .otherwise(F.lit(UNKNOWN)))
        began = (acc["state"] == BETWEEN) | r["closes"]
        return F.struct(state.alias("state"), F.when(began, r["start"]).otherwise(acc["owner"]).alias("owner"),
                        F.concat(acc["seen"], F.array(F.struct(r["start"].alias("start"), acc["state"].alias("state"),
                                                               acc["owner"].alias("owner")))).alias("seen"))

    folded = files.select("path", "size", "bytes", "lines", F.aggregate("ranges", begin, step).alias("all"))
    # Every byte is a line's or a line end's; a byte order mark, which the line reader skips, shows here.
    ends = F.col("size") - F.col("bytes") - 2 * F.col("lines")
    exact = (F.col("all.state") == BETWEEN) & ends.isin(0, -2)
    return folded.select("path", exact.alias("exact"), F.inline("all.seen"))


def _whole_records(lines: DataFrame, columns: int) -> DataFrame:
    """Rows of (folder_no, k, value): chunks of whole records, with a heading (k = 0) first for each folder of a
    task; and under ``EDGES`` the pieces of records that go over range edges.

    ``lines`` has path, folder_no, start, state, owner and line, in the files' order.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        headed: set[int] = set()
        out: list[tuple] = []
        now, state, owner, joined, held = None, BETWEEN, -1, False, 0
        record: list[bytes] = []  # lines of the record that is open
        body: list[bytes] = []  # lines of whole records

        def end_body() -> None:
            if body:
                if now[1] not in headed:
                    headed.add(now[1])
                    out.append((now[1], 0, _heading(columns)))
                out.append((now[1], 1, b"\r\n".join(body)))
                body.clear()

        def end_piece() -> None:
            if record:
                text = base64.b64encode(b"\r\n".join(record)).decode()
                out.append((EDGES, 1, f"{now[1]}\t{owner}\t{now[2]}\t{now[0]}\t{text}".encode()))
                record.clear()

        def rows() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ROWS)], schema=_ROWS)
            out.clear()
            return batch

        for batch in batches:
            for key, own in _runs(batch):
                if key != now:
                    if now is not None:
                        end_body()
                        end_piece()
                    now, state, held = key, key[3], 0
                    joined = state == INSIDE  # the record that is open here began in another range
                    owner = key[4] if joined else key[2]
                for line in own:
                    record.append(line)
                    state = state_after(state, line)
                    if state != BETWEEN:
                        continue
                    if joined:
                        end_piece()
                        joined, owner = False, now[2]
                        continue
                    body += record
                    held += sum(map(len, record))
                    record.clear()
                    if held > CHUNK_BYTES:
                        end_body()
                        held = 0
            if out:
                yield rows()
        if now is not None:
            end_body()
            end_piece()
        if out:
            yield rows()

    return lines.mapInArrow(run, "folder_no int, k int, value binary")


def _headed(rows: DataFrame, columns: int) -> DataFrame:
    """Rows of folder_no and value with a heading first for each folder of a task (k = 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        headed: set[int] = set()
        for batch in batches:
            folders = batch.column(0).to_pylist()
            new = sorted(set(folders) - headed)
            headed.update(new)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*new, *folders], pa.int32()), pa.array([0] * len(new) + [1] * len(folders), pa.int32()),
                 pa.array([_heading(columns)] * len(new) + batch.column(1).to_pylist(), pa.binary())], schema=_ROWS)

    return rows.mapInArrow(run, "folder_no int, k int, value binary")


def _heading(columns: int) -> bytes:
    return ",".join(["h"] * columns).encode()


def _write(rows: DataFrame, path: str) -> None:
    """One file for each task and folder, headings first."""
    (rows.withColumnRenamed("folder_no", PART_FOLDER).sortWithinPartitions(PART_FOLDER, "k")
     .select(PART_FOLDER, F.col("value").cast("string").alias("value"))
     .write.mode("append").partitionBy(PART_FOLDER).option("lineSep", LINE_END).text(path))


def _passes(files: Sequence[tuple[str, int]], range_bytes: int) -> Iterator[list[str]]:
    """The files in groups of at most ``PASS_RANGES`` ranges; one file of more is a group of its own."""
    group, room = [], PASS_RANGES
    for path, size in files:
        need = -(-size // range_bytes) + 1
        if group and need > room:
            yield group
            group, room = [], PASS_RANGES
        group.append(path)
        room -= need
    if group:
        yield group


@dataclass
class Cut:
    """Part files of large files: their folders, the files they stand for, and the landing folders by number."""

    parts: list[str] = field(default_factory=list)
    files: list[str] = field(default_factory=list)
    folders: list[str] = field(default_factory=list)


def cut_files(spark: SparkSession, files: Sequence[tuple[str, int]], columns: int, range_bytes: int) -> Cut:
    """Write the whole records of large files (paths and sizes) to part files that tasks can share out.

    Files without an exact cut are left out of ``Cut.files``.  Parts lie below ``part__folder=<number>`` and
    begin with a heading of ``columns`` names, as the reader may fail on an odd first record.
    """
    ship_code(spark)
    done = Cut()
    for group in _passes(files, range_bytes):
        # A row per range, at most PASS_RANGES of them.
        states = exact_states(range_functions(_lines(spark, group, range_bytes))).where("exact").drop("exact").collect()
        found = sorted({r.path for r in states})
        if not found:
            continue
        folder = {p: p.split("/")[-3] for p in found}
        done.folders += sorted(set(folder.values()) - set(done.folders))
        lines = _lines(spark, group, range_bytes).drop("size")
        begins = lines.sparkSession.createDataFrame([(*r, done.folders.index(folder[r.path])) for r in states],
                                                    "path string, start long, state int, owner long, folder_no int")
        lines = (lines.join(F.broadcast(begins), ["path", "start"])
                 .select("path", "folder_no", "start", "state", "owner", "line"))
        target = scratch_path(spark, "csv-parts")
        done.parts.append(target)
        _write(_whole_records(lines, columns), target)
        if any(r.state == INSIDE for r in states):
            piece = F.split("value", "\t")
            pieces = spark.read.schema(f"value string, {PART_FOLDER} int").text(target).where(F.col(PART_FOLDER) == EDGES).select(
                F.get(piece, 0).cast("int").alias("folder_no"), F.get(piece, 1).alias("owner"), F.get(piece, 3).alias("path"),
                F.struct(F.get(piece, 2).cast("long").alias("start"), F.unbase64(F.get(piece, 4)).alias("text")).alias("piece"))
            records = (pieces.groupBy("path", "folder_no", "owner").agg(F.array_sort(F.collect_list("piece")).alias("p"))
                       .select("folder_no", F.array_join(F.transform("p.text", lambda t: t.cast("string")), LINE_END)
                               .cast("binary").alias("value")))
            _write(_headed(records, columns), target)
        done.files += found
    return done


__all__ = ["Cut", "PART_FOLDER", "cut_files", "exact_states", "range_functions", "state_after"]
