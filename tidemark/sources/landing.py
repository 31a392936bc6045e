"""Landing-folder planning (operators A4, A5, A8-A11).

The landing root holds timestamp-named export folders, each with one
sub-folder per table holding CSV files.  The load job reads the root's folder
names once.  Few tables and folders past their marks are looked into directly; for many,
each folder is listed once, in parallel, and the rules are filters and joins over the
listed files (``plan_loads``).  The CSV reader then gets table folders, not files.
Folder names compare as strings; both bounds are strict: a folder equal to the
high-water mark was loaded, and the folder named by the changelog is still
being written.
"""

from __future__ import annotations

import concurrent.futures as cf
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import SYSTEM_FOLDERS
from tidemark.sources.csvscan import CSV_GLOB


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified form of ``path`` (as file listings report it)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return str(fs.makeQualified(p)).rstrip("/")


def list_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the entries directly below ``root`` (one metadata call)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def landing_files(spark: SparkSession, root: str, folders: list[str] | None = None,
                  glob: str | None = None) -> DataFrame:
    """Every file below ``root`` (or below the given top-level ``folders``), or those whose name fits ``glob``:
    ``path, folder, table, file_name, depth, length``.

    ``folder`` is the first path level below the root, ``table`` the second
    (NULL for files directly inside a folder).  Only file metadata is read;
    with many paths Spark lists them in parallel.
    """
    base = qualify(spark, root)
    paths = [root] if folders is None else [f"{root.rstrip('/')}/{f}" for f in folders]
    if not paths:
        return spark.createDataFrame([], "path STRING, folder STRING, table STRING, file_name STRING, depth INT, length BIGINT")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return files_from_paths(reader.load(paths).select("path", "length"), base)


def name_is_open(folder: str, mark: str | None, latest: str | None) -> bool:
    """``folder_is_open`` of one name."""
    return folder not in SYSTEM_FOLDERS and (mark is None or folder > mark) and (latest is None or folder < latest)


#: (table, folder) pairs up to which each is looked into directly; more are found by listing the folders.
PROBES = 64
#: Folders whose files are listed together; the driver holds the names of that many folders' CSV files.
LISTED_FOLDERS = 1024


def loadable_folders(spark: SparkSession, root: str, marks: Mapping[str, str | None],
                     latest: str | None, threads: int = 16) -> dict[str, list[str]]:
    """A8-A10 for the load job: ``{table: [folder, ...]}`` in folder order.

    A daily load of a few tables looks into ``<folder>/<table>`` past each table's own mark, and only until a
    CSV file shows up.  Where that would be many requests (many tables, or a long history to
    load), every folder past the lowest mark is listed once instead, by Spark's parallel
    listing, and the (table, folder) pairs are found by the rules over that listing.  The requests then follow
    the folders and what lies in them, not tables times folders.
    """
    names = list_folders(spark, root)
    pairs = [(t, f) for t, mark in marks.items() for f in names if name_is_open(f, mark, latest)]
    found = _probed(spark, root, pairs, threads) if len(pairs) <= PROBES else _listed(spark, root, marks, latest, names)
    out: dict[str, list[str]] = {t: [] for t in marks}
    for table, folder in sorted(found):
        out[table].append(folder)
    return out


def _probed(spark: SparkSession, root: str, pairs: list[tuple[str, str]], threads: int) -> set[tuple[str, str]]:
    """The (table, folder) pairs with a CSV file, one or two metadata requests of the driver each."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def has_csv(pair: tuple[str, str]) -> bool:
        path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{pair[1]}/{pair[0]}")
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            return False
        entries = fs.listStatusIterator(path)
        while entries.hasNext():
            entry = entries.next()
            if entry.isFile() and entry.getPath().getName().lower().endswith(".csv"):
                return True
        return False

    with cf.ThreadPoolExecutor(max_workers=threads) as pool:
        return {pair for pair, found in zip(pairs, pool.map(has_csv, pairs)) if found}


def _listed(spark: SparkSession, root: str, marks: Mapping[str, str | None], latest: str | None,
            names: list[str]) -> set[tuple[str, str]]:
    """The same pairs from a listing of every folder past the lowest mark."""
    lowest = None if None in marks.values() else min(marks.values())
    open_names = [f for f in names if name_is_open(f, lowest, latest)]
    table_marks = spark.createDataFrame(list(marks.items()), "table STRING, lastload STRING")
    found: set[tuple[str, str]] = set()
    for k in range(0, len(open_names), LISTED_FOLDERS):
        files = landing_files(spark, root, open_names[k:k + LISTED_FOLDERS], glob=CSV_GLOB)
        planned = (files.filter(F.col("table").isNotNull() & (F.col("depth") == 3)).join(table_marks, "table")
                   .filter(folder_is_open(F.col("folder"), F.col("lastload"), latest)))
        found |= {(r["table"], r["folder"]) for r in planned.select("table", "folder").distinct().collect()}
    return found


def files_from_paths(files: DataFrame, base: str) -> DataFrame:
    """Split listed paths below ``base`` into folder / table / file name."""
    rel = F.substring(F.col("path"), len(base) + 2, 1 << 20)
    parts = F.split(rel, "/")
    depth = F.size(parts)
    return files.select(
        "path",
        F.element_at(parts, 1).alias("folder"),
        F.when(depth >= 3, F.element_at(parts, 2)).alias("table"),
        F.element_at(parts, -1).alias("file_name"),
        depth.alias("depth"),
        *[c for c in files.columns if c not in ("path",)])


def folder_is_open(folder: Column, watermark: Column | str | None, latest: str | None) -> Column:
    """A8 rule: strictly after the mark, strictly before the open folder,
    and not a system entry."""
    cond = ~folder.isin(*SYSTEM_FOLDERS)
    if watermark is not None:
        wm = F.lit(watermark) if isinstance(watermark, str) else watermark
        cond = cond & (wm.isNull() | (folder > wm))
    if latest is not None:
        cond = cond & (folder < F.lit(latest))
    return cond


def closed_folders(files: DataFrame, watermark: str | None, latest: str | None) -> DataFrame:
    """Distinct loadable folder names."""
    return (files.filter(folder_is_open(F.col("folder"), watermark, latest))
            .select("folder").distinct())


def is_csv(name: Column) -> Column:
    return F.lower(name).endswith(".csv")


def table_folders(files: DataFrame) -> DataFrame:
    """(table, folder) pairs whose table folder holds at least one CSV file
    (extension compared case-insensitively)."""
    return (files.filter(F.col("table").isNotNull() & is_csv(F.col("file_name")))
            .select("table", "folder").distinct())


def plan_loads(files: DataFrame, marks: DataFrame | Mapping[str, str | None] | None,
               latest: str | None, tables: list[str] | None = None) -> DataFrame:
    """CSV files to load per table: ``table, folder, path``.

    ``marks`` gives each table's high-water mark (a ``tableName, lastload``
    DataFrame or a dict); tables without a mark load every closed folder.
    """
    f = files.filter(F.col("table").isNotNull() & is_csv(F.col("file_name")))
    if tables is not None:
        f = f.filter(F.col("table").isin(*tables))
    if marks is None:
        f = f.withColumn("lastload", F.lit(None).cast("string"))
    elif isinstance(marks, DataFrame):
        f = f.join(marks.select(F.col("tableName").alias("table"), "lastload"), "table", "left")
    else:
        rows = [(k, v) for k, v in marks.items()]
        m = files.sparkSession.createDataFrame(rows, "table STRING, lastload STRING")
        f = f.join(F.broadcast(m), "table", "left")
    return (f.filter(folder_is_open(F.col("folder"), F.col("lastload"), latest))
            .select("table", "folder", "path", *(["length"] if "length" in files.columns else [])))


def changelog_head(spark: SparkSession, path: str) -> str | None:
    """A4: first line of the changelog (the folder still being written).
    None for an empty file; a missing file raises."""
    rows = spark.read.text(path).head(1)
    return rows[0][0] if rows else None


def changelog_folders(text: DataFrame) -> DataFrame:
    """Comma-separated folder names of every line, one per row."""
    return text.select(F.explode(F.split(F.col("value"), ",")).alias("folder_name"))


def changelog_latest(spark: SparkSession, path: str) -> str | None:
    """Greatest folder name listed in the changelog; None if none
    (blank names, e.g. an empty line, are not folder names)."""
    names = changelog_folders(spark.read.text(path).coalesce(1)).filter(F.trim("folder_name") != "")  # one small file
    row = names.agg(F.max("folder_name").alias("m")).head()
    return row["m"] if row else None
