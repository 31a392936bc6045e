"""URL filters: allow and block rules, and gradient-boosted trees on lexical features for the rest.

The trees learn from labelled URLs: those that a rule decides, unless the caller brings labels of their own.  Features
are lengths, depth, digit ratio, entropy, parameter counts and the block rate of the
host's suffixes among labelled URLs of other hosts.  They are columns of built-in functions; the trees are Spark ML's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

#: (rule, verdict): a host, for itself and its subdomains, and the start of a path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
FEATURES = ("length", "host_length", "path_length", "query_length", "depth", "labels", "digits", "host_digits", "hyphens",
            "marks", "parameters", "fragment", "scheme_length", "entropy", "host_entropy", "suffix_rate", "name_rate")
#: Features that come from other urls' labels; all others are lexical.
RATES = ("suffix_rate", "name_rate")
#: Labelled URLs of each verdict in the fit, at most; weight of the overall rate in a suffix's; and folds of hosts.
CLASS_ROWS, PRIOR_ROWS, FOLDS = 20_000, 20.0, 5


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path of a url; both empty without ``://``."""
    def part(group: int) -> Column:
        return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(part(1), upper, upper.lower()), part(2)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, as ``struct(rule, verdict)``; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    """Entropy in bits of the characters of a short text."""
    chars = F.split(text, "")
    n = F.length(text)
    shares = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / n)
    return F.when(n == 0, 0.0).otherwise(F.aggregate(shares, F.lit(0.0), lambda a, p: a - p * F.log2(p)))


def _count(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("double")


def suffixes(host: Column) -> tuple[Column, Column]:
    """The last label of a host, and its last three."""
    host = F.regexp_replace(host, r":\d*$", "")
    return F.substring_index(host, ".", -1), F.substring_index(host, ".", -3)


def lexical(rows: DataFrame) -> DataFrame:
    """Adds the lexical features to rows of url, host and path."""
    url, host, path = F.coalesce(F.col("url"), F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    n = F.greatest(F.length(url), F.lit(1))
    return rows.withColumns({
        "length": F.length(url).cast("double"), "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"), "query_length": F.length(query).cast("double"),
        "depth": F.size(F.filter(F.split(path, "/"), lambda s: s != "")).cast("double"),
        "labels": F.size(F.split(host, r"\.")).cast("double"), "digits": _count(url, "[0-9]") / n,
        "host_digits": _count(host, "[0-9]"), "hyphens": _count(host, "-"), "marks": _count(url, "[%@_~=&+]"),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda s: s != "")).cast("double"),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
        "scheme_length": F.length(F.substring_index(url, "://", 1)).cast("double"),
        "entropy": _entropy(url), "host_entropy": _entropy(host),
        "suffix": suffixes(host)[0], "name": suffixes(host)[1]})


def with_rates(rows: DataFrame) -> DataFrame:
    """Adds the smoothed share of blocked among the labelled urls of a row's suffix and name.

    A labelled row's share is that of other hosts' folds: hosts are dealt to ``FOLDS`` folds by hash, and the row's own fold is
    left out, so its label isn't in its features.
    """
    labelled = rows.where("label is not null")
    base = F.lit(labelled.agg(F.avg("label")).head()[0] or 0.0)
    rows = rows.withColumn("fold", F.when(F.col("label").isNotNull(), F.pmod(F.xxhash64("host"), F.lit(FOLDS))))
    for key, out in (("suffix", "suffix_rate"), ("name", "name_rate")):
        parts = (rows.where("label is not null").groupBy(key, "fold")
                 .agg(F.sum("label").alias("own_blocked"), F.count(F.lit(1)).alias("own_n")))
        sums = parts.groupBy(key).agg(F.sum("own_blocked").alias("blocked"), F.sum("own_n").alias("n"))
        counted = {c: F.coalesce(c, F.lit(0)) for c in ("blocked", "n", "own_blocked", "own_n")}
        rate = ((counted["blocked"] - counted["own_blocked"] + PRIOR_ROWS * base)
                / (counted["n"] - counted["own_n"] + PRIOR_ROWS))
        rows = rows.join(sums, key, "left").join(parts, [key, "fold"], "left").withColumn(out, rate).drop(*counted)
    return rows


def sample_rows(rated: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """At most ``CLASS_ROWS`` labelled rows of each verdict: those of smallest hash, found without a window over all."""
    place = F.shiftrightunsigned(F.xxhash64("url", "page_id"), 1)
    chosen = None
    for label, n in sizes.items():
        # About twice as many pass the bound as are taken, whatever their number.
        near = place <= int((1 << 63) * min(1.0, 2 * CLASS_ROWS / n)) - 1
        own = rated.where((F.col("label") == label) & near).orderBy(place, "url", "page_id").limit(CLASS_ROWS)
        chosen = own if chosen is None else chosen.unionByName(own)
    return chosen


def fit_trees(sample: DataFrame, trees: int = 20, depth: int = 4, features: Sequence[str] = FEATURES):
    """Boosted trees on labelled rows; a model that adds ``probability`` to rows of ``vectors``."""
    return GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, cacheNodeIds=False).fit(
        vectors(features).transform(stage(sample.select("label", *features), "url-sample")))


def vectors(features: Sequence[str] = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


def featured(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id",
             url_col: str = "url") -> DataFrame:
    """Rows of page_id, url, host, path, match (the rule's), label (1: a rule blocks, 0: one allows) and all features."""
    host, path = split_url(F.col("url"))
    rows = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
            .withColumn("host", host).withColumn("path", path)
            .withColumn("match", matching_rule(F.col("host"), F.col("path"), rules)))
    rows = stage(lexical(rows).withColumn("label", (F.col("match.verdict") == "block").cast("double")), "url-features")
    return with_rates(rows)


def class_sizes(rated: DataFrame) -> dict[int, int]:
    labelled = rated.where("label is not null")
    return {int(r.label): r.n for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url",
          trees: int = 20, depth: int = 4, threshold: float = 0.5) -> DataFrame:
    """One row per input row: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``score``.

    The longest rule that fits decides; other urls are blocked from a score of ``threshold`` on, the trees'
    probability of "block".  Trees are fitted on at most ``CLASS_ROWS`` urls of each verdict (smallest hashes first).
    Without urls of both verdicts to learn from, the score is the share of blocked ones among them (0
    without any).  A null url has empty host and path.  Repeated rows stay repeated, other columns are
    ignored, and an empty table gives no rows.
    """
    rated = featured(pages, rules, id_col, url_col)
    sizes = class_sizes(rated)
    if len(sizes) < 2:
        scored = rated.withColumn("score", F.lit(float(sizes.get(1, 0) > 0)))
    else:
        model = fit_trees(sample_rows(rated, sizes), trees, depth)
        scored = (model.transform(vectors().transform(rated))
                  .withColumn("score", vector_to_array("probability")[1]))
    by_trees = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", F.col("match.rule").alias("rule"),
                         F.coalesce("match.verdict", by_trees).alias("verdict"), "score")


def held_out_accuracy(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
                      features: Sequence[str] = FEATURES) -> tuple[float, float]:
    """Share of right verdicts on labelled urls whose hosts (one fold) the trees haven't seen, and that of the commoner verdict."""
    rated = featured(pages, rules)
    held = F.col("fold") == 0
    learn = rated.where(~held)
    model = fit_trees(sample_rows(learn, class_sizes(learn)), features=features)
    judged = model.transform(vectors(features).transform(rated.where(held)))
    right, blocked = judged.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")), F.avg("label")).head()
    return right, max(blocked, 1 - blocked)
