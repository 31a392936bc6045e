"""I-Match fingerprints with randomised lexicons, in DataFrame functions only.

Terms (runs of letters and digits, lower-cased, as 64-bit hashes) whose inverse document
frequency lies in a band form the lexicon.  Frequencies are over distinct texts, so copies don't push their own terms out.  Each of several random subsets of it, drawn by hash
at falling rates, gives one part of a fingerprint: the hash of the document's sorted distinct terms
in that subset.  Short documents find their terms in the dense subsets, and long ones keep some of
the thin ones through an edit.  Likeness is the share of equal parts among those not empty in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Inverse document frequencies (natural logarithm) that a lexicon term may have.
IDF_BAND = (2.0, 7.0)
#: A subset holds one in so many terms (powers of two); there are ``PER_RATE`` subsets of each rate.
RATES, PER_RATE = tuple(1 << k for k in range(3, 14)), 5
#: Lexicon terms that are broadcast at most; a larger lexicon is joined by a shuffle.
BROADCAST_TERMS = 1_000_000
#: Hexadecimal digits of a part.
_DIGITS = 6
_EMPTY = "-" * _DIGITS


def terms(text: Column, tag: int = 0) -> Column:
    """Distinct hashed terms of a text; the lowest bit of each is ``tag``."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(F.lit(-2)).bitwiseOR(F.lit(tag))))


def subset_mask(term: Column) -> Column:
    """Bits of the subsets that a hashed term belongs to.

    A subset of rate 2**b holds the terms that have b zero bits at the subset's place in a further hash of
    theirs; a hash of 64 bits serves as many subsets as it has places for.
    """
    mask, bit, used, seed = F.lit(0).cast("long"), 0, 64, 0
    for rate in RATES:
        width = rate.bit_length() - 1
        for _ in range(PER_RATE):
            if used + width > 64:
                seed, used = seed + 1, 0
            place = F.lit(((1 << width) - 1 << used) - (1 << 64 if used + width == 64 else 0)).cast("long")
            chosen = F.xxhash64(term, F.lit(seed)).bitwiseAND(place) == 0
            mask = mask.bitwiseOR(F.when(chosen, F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long")))
            bit, used = bit + 1, used + width
    return mask


def distinct_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``th``, ``text``: one row per text hash.

    Hashes are counted first; only texts that recur are then sorted and reduced, before and after the shuffle.
    """
    rows = docs.select(F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    copied = stage(rows.groupBy("th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("th"), "imatch-copied")
    return rows.join(copied, "th", "left_anti").unionByName(rows.join(copied, "th", "left_semi").dropDuplicates(["th"]))


def lexicon(docs: DataFrame, text_col: str = "text", band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """``term``, ``mask`` of the terms in the band that belong to some subset.

    A term in the band is in e**-band[1] of all distinct texts or more, so there are at most e**band[1] times
    the mean number of distinct terms such a text has, however many there are.
    """
    n = docs.select(F.xxhash64(text_col).alias("th")).distinct().count()
    counted = (distinct_texts(docs, text_col).select(F.explode(terms(F.col("text"))).alias("term"))
               .withColumn("mask", subset_mask(F.col("term"))).where("mask != 0")
               .groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.first("mask").alias("mask")))
    idf = F.log(F.lit(float(max(n, 1))) / F.col("df"))
    return stage(counted.where(idf.between(*band)).select("term", "mask"), "imatch-lexicon")


def with_parts(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Replaces each named array of (term, mask) by its fingerprint parts; by the given column alone where it is empty.

    Terms are sorted once; each rate's are then sorted out before its subsets are hashed.
    """
    bits = {rate: range(i * PER_RATE, (i + 1) * PER_RATE) for i, rate in enumerate(RATES)}

    def within(array: Column, wanted) -> Column:
        mask = F.lit(sum(1 << k for k in wanted)).cast("long")
        return F.filter(array, lambda t: t["mask"].bitwiseAND(mask) != 0)

    df = df.withColumns({c: F.sort_array(c) for c in columns})
    df = df.withColumns({f"{c}_{rate}": within(F.col(c), wanted) for c in columns for rate, wanted in bits.items()})
    none = F.xxhash64(F.array().cast("array<struct<term:bigint,mask:bigint>>"))  # the hash of no terms
    for c, otherwise in columns.items():
        hashes = F.array(*[F.xxhash64(within(F.col(f"{c}_{rate}"), [k])) for rate, wanted in bits.items() for k in wanted])
        shown = F.transform(hashes, lambda h: F.when(h == none, F.lit(_EMPTY)).otherwise(
            F.substring(F.lpad(F.hex(h), 16, "0"), 1, _DIGITS)))
        df = df.withColumn(c, F.when(F.size(c) == 0, F.array(otherwise)).otherwise(shown))
    return df.drop(*[f"{c}_{rate}" for c in columns for rate in RATES])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal parts among those not empty in both fingerprints; 1 for equal ones."""
    pairs = F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: (p["a"] != _EMPTY) | (p["b"] != _EMPTY))
    same = F.size(F.filter(pairs, lambda p: p["a"] == p["b"]))
    return (F.when(a == b, F.lit(1.0)).when(F.size(a) != F.size(b), F.lit(0.0))
            .otherwise(same / F.size(pairs)).cast("double"))


def successors(rows: DataFrame) -> DataFrame:
    """Each row of (key, th, ...) with the key of the next in order, ``next_key``, ``next_th``; the last one's is the first.

    Rows are range-partitioned; the order inside a partition is a window, and only the first row
    of each partition is compared with other partitions'.
    """
    placed = stage(rows.repartitionByRange("key", "th").withColumn("place", F.spark_partition_id()), "imatch-order")
    inside = Window.partitionBy("place").orderBy("key", "th")
    own = F.struct("key", "th")
    firsts = placed.groupBy("place").agg(F.min(own).alias("first"))
    across = Window.orderBy("place")  # one row per partition
    firsts = firsts.select("place", F.coalesce(
        F.lead("first").over(across),
        F.first("first").over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    return (placed.withColumn("next", F.lead(own).over(inside)).join(F.broadcast(firsts), "place")
            .withColumn("next", F.coalesce("next", "after"))
            .select(*rows.columns, F.col("next.key").alias("next_key"), F.col("next.th").alias("next_th")))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """One row per input row with its fingerprint, and that of its text with the last quarter exchanged.

    The last floor(n/4) code points give way to as many of the next document's first (or all), in ascending id
    order; the next of the last is the first.  Null texts are empty; null ids come first; rows of one id are
    ordered by text hash and repeated rows stay repeated.  A text without lexicon terms has the hash of
    the whole text as its fingerprint.  Columns: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint (arrays of parts), near_edited, near_next.  An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
            .withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("th", F.xxhash64("text")))
    words = lexicon(rows, "text", band)
    order = successors(rows.select("doc_id", "key", "th", F.length("text").alias("n_chars")))
    order = stage(order.withColumn("row", F.monotonically_increasing_id()), "imatch-next")

    texts = rows.select("key", "th", "text")
    unique = order.groupBy("key", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    texts = texts if unique else texts.dropDuplicates(["key", "th"])
    # Both joins meet the texts by the same columns, so Spark shuffles the texts once for the two.
    wanted = order.select(F.col("key").alias("own_key"), F.col("th").alias("own_th"), "row", "n_chars",
                          F.col("next_key").alias("key"), F.col("next_th").alias("th"))
    filled = (wanted.join(texts, ["key", "th"])
              .select(F.col("own_key").alias("key"), F.col("own_th").alias("th"), "row", "n_chars",
                      F.expr("left(text, cast(floor(n_chars / 4) as int))").alias("insert")))
    edited = F.concat(F.expr("left(text, n_chars - cast(floor(n_chars / 4) as int))"), F.col("insert"))
    both = (texts.join(filled, ["key", "th"]).withColumn("edited", edited)
            .withColumn("edited_th", F.xxhash64("edited")).withColumn("sha", F.unhex(F.sha2("edited", 256))))

    # Terms of the text have tag 0, those of the edited text tag 1; a null keeps a document without lexicon terms.
    every = F.concat(terms(F.col("text"), 0), terms(F.col("edited"), 1), F.array(F.lit(None).cast("long")))
    keys, carried = ["key", "th", "row"], ["edited_th", "sha"]
    term = F.col("tagged").bitwiseAND(F.lit(-2))
    if words.count() <= BROADCAST_TERMS:
        words = F.broadcast(words)
    else:  # nulls would meet in one task: each gets an odd number, which no term is
        term = F.coalesce(term, F.xxhash64(*keys).bitwiseOR(F.lit(1)))
    found = (both.select(*keys, *carried, F.explode(every).alias("tagged"))
             .select("*", term.alias("term"), F.col("tagged").bitwiseAND(F.lit(1)).alias("tag"))
             .join(words, "term", "left").where("tagged is null or mask is not null"))
    pair = F.struct("term", "mask")
    marked = found.groupBy(*keys).agg(*[F.first(c).alias(c) for c in carried],
                                      F.collect_list(F.when(F.col("tag") == 0, pair)).alias("own"),
                                      F.collect_list(F.when(F.col("tag") == 1, pair)).alias("other"))
    marked = with_parts(marked, {"own": F.hex("th"), "other": F.hex("edited_th")}).select(
        *keys, F.lower(F.hex("sha")).alias("edited_sha256"), F.col("own").alias("fingerprint"),
        F.col("other").alias("edited_fingerprint"))
    marked = stage(marked.join(order, keys), "imatch")
    nexts = (marked.select(F.col("key").alias("next_key"), F.col("th").alias("next_th"),
                           F.col("fingerprint").alias("next_fingerprint")))
    nexts = nexts if unique else nexts.dropDuplicates(["next_key", "next_th"])
    return marked.join(nexts, ["next_key", "next_th"]).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
