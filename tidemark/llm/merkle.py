"""Merkle manifest of a table: a tree of digests per language, a root over them, and a proof for each row.

Only every ``LEVELS``-th level of a tree is kept.  A kept node stands for an aligned subtree of at most
2**LEVELS stored descendants; where a proof needs the levels between, they are computed again from these
descendants, one subtree at a time, and dropped after their siblings have been handed out.  So the
stored nodes add a 64th to the leaves, and a proof's upper part is shared by a whole subtree.

H is SHA-256 as lower-case hex; a node is H of its children's hex digests one after the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage
from .ranking import numbered

#: Levels between two stored ones.
LEVELS = 6
#: Nodes that a task takes at least, so that the few nodes of upper levels don't lie in many small files.
TASK_NODES = 50_000
#: Columns that a leaf digests, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def _digest(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def _field(c: Column) -> Column:
    """A value as its UTF-8 length, a colon and itself; a dash for null."""
    text = c.cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: list[Column]) -> Column:
    """The digest of a row's values."""
    return _digest(F.concat(*map(_field, values)))


def _few(df: DataFrame, nodes: int) -> DataFrame:
    """``df``, made from ``nodes`` nodes, in as many tasks as these are worth."""
    return df.coalesce(nodes // TASK_NODES + 1)


def _above(row: Column) -> Column:
    """The level above a row of nodes: digests of every two, the last alone where their number is odd."""
    return F.transform(F.sequence(F.lit(0), F.expr("0") + ((F.size(row) - 1) / 2).cast("int")),
                       lambda i: _digest(F.concat(F.get(row, 2 * i), F.coalesce(F.get(row, 2 * i + 1), F.lit("")))))


def _subtrees(nodes: DataFrame, level: int) -> DataFrame:
    """Aligned subtrees of a stored level: g, up (the place of its top), height, members by place, row (their digests)."""
    grouped = (nodes.where(F.col("height") > level)
               .groupBy("g", "height", F.shiftright("idx", LEVELS).alias("up"))
               .agg(F.array_sort(F.collect_list(F.struct("idx", "digest", "payload"))).alias("members")))
    return grouped.withColumn("steps", F.least(F.lit(LEVELS), F.col("height") - level))


def build(nodes: DataFrame, n: int, height: int, label: str) -> list[DataFrame]:
    """The stored levels of every tree, lowest first.

    ``nodes`` has g (the tree), idx (place from 0), digest, payload (any struct that stays with it) and
    height (levels above the leaves: 0 for a lone leaf); ``n`` is their number, ``height`` the largest.
    """
    stored = [nodes]
    for level in range(0, height, LEVELS):
        trees = _subtrees(stored[-1].select("g", "idx", "digest", "height", F.lit(None).cast("string").alias("payload")),
                          level)
        risen = F.aggregate(F.sequence(F.lit(1), F.col("steps")), F.col("members.digest"), lambda row, _: _above(row))
        risen = trees.select("g", F.col("up").alias("idx"), F.get(risen, 0).alias("digest"), "height",
                             F.lit(None).cast("string").alias("payload"))
        stored.append(stage(_few(risen, n >> level), f"{label}-{level + LEVELS}"))
    return stored


def tops(stored: list[DataFrame]) -> DataFrame:
    """g, digest: what remains of each tree."""
    found = None
    for k, nodes in enumerate(stored):
        ended = nodes.where((F.col("height") <= k * LEVELS) & (F.col("height") > (k - 1) * LEVELS)).select("g", "digest")
        found = ended if found is None else found.unionByName(ended)
    return found


def proofs(stored: list[DataFrame], n: int, above: DataFrame, label: str) -> DataFrame:
    """payload, digest, path and note of every leaf: path has its siblings and the side they stand on, lowest first.

    ``above`` has g, path (the part of the proofs over each tree's top) and a note that all
    leaves of the tree get.  A step without a sibling has a null in its place.
    """
    start = None
    for k in range(len(stored) - 1, -1, -1):
        level = k * LEVELS
        # Over a tree's top stands the tree's own path; over a subtree the path of its top, one stored level up.
        paths = (stored[k].where((F.col("height") <= level) & (F.col("height") > level - LEVELS))
                 .join(above, "g").select("g", "idx", "digest", "payload", "path", "note"))
        if start is not None:
            over = start.select("g", F.col("idx").alias("up"), F.col("path").alias("rest"), "note")
            trees = _subtrees(stored[k], level).join(over, ["g", "up"])
            rows = F.aggregate(F.sequence(F.lit(1), F.col("steps")), F.array(F.col("members.digest")),
                               lambda rows, _: F.concat(rows, F.array(_above(F.element_at(rows, -1)))))
            # Generated, so that the rows are computed once a subtree and not once a member.
            trees = trees.withColumn("rows", F.explode(F.array(rows)))
            member = trees.select("g", "steps", "rest", "note", "rows", F.posexplode("members").alias("at", "m"))

            def step(up: Column) -> Column:
                place = F.call_function("shiftright", F.col("at"), up)
                return F.struct(F.get(F.get(F.col("rows"), up), place.bitwiseXOR(F.lit(1))).alias("sibling"),
                                (place.bitwiseAND(F.lit(1)) == 1).alias("left"))

            own = F.transform(F.sequence(F.lit(0), F.col("steps") - 1), step)
            paths = paths.unionByName(member.select("g", "m.idx", "m.digest", "m.payload",
                                                    F.concat(own, "rest").alias("path"), "note"))
        start = stage(_few(paths, n >> level), f"{label}-paths-{level}") if k else paths
    return start.select("payload", "digest", "path", "note")


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.aggregate(path, digest, lambda d, s: _digest(
        F.when(s["sibling"].isNull(), d).when(s["left"], F.concat(s["sibling"], d)).otherwise(F.concat(d, s["sibling"]))))


def proof_digest(path: Column) -> Column:
    """H of a path's siblings."""
    return _digest(F.array_join(F.transform(path, lambda s: s["sibling"]), ""))


def _height(n: Column) -> Column:
    """Levels over ``n`` leaves: the binary digits of n - 1."""
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1))).cast("int")


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", columns: tuple[str, ...] = LEAF_COLUMNS,
             changed: dict[str, Column] | None = None, suspect: Column | None = None) -> DataFrame:
    """One row per input row: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    A leaf digests ``columns``.  The leaves of one ``group_col`` value ascend by ``id_col`` (null first, equal ids by
    their leaf), and every two consecutive nodes become one until one remains; those of the groups, null
    first and then by their UTF-8 bytes, likewise give the root.  ``changed`` has the values of columns after
    tampering with the rows for which ``suspect`` holds; ``folded_root`` is what these rows' changed leaves, and all
    others' own, lead to by the proof.  Repeated rows have leaves of their own; null values are
    dashes, empty texts have length 0; other columns are ignored; an empty table gives no rows.
    """
    own = [F.col(c) for c in columns]
    other = [(changed or {}).get(c, F.col(c)) for c in columns]
    bad = F.lit(False) if suspect is None else F.coalesce(suspect, F.lit(False))
    group = F.coalesce(F.concat(F.lit("v"), F.col(group_col).cast("string")), F.lit("n"))  # null sorts first
    leaves = stage(docs.select(group.alias("g"), F.col(id_col).alias("doc_id"), leaf(own).alias("digest"),
                               F.when(bad, leaf(other)).alias("tampered"),
                               F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    placed, sizes = numbered(leaves, ["doc_id", "digest", "row"], "merkle-order", "g")
    placed = (placed.join(sizes.select("g", _height(F.col("n")).alias("height")), "g")
              .select("g", "idx", "digest", "height", F.struct("doc_id", "tampered").alias("payload")))
    placed = stage(placed, "merkle-placed")
    n, n_groups, height = placed.agg(F.count(F.lit(1)), F.count_if(F.col("idx") == 0), F.max("height")).head()
    stored = build(placed, n, height or 0, "merkle")

    # The groups' tops are the leaves of one more tree.
    groups, _ = numbered(stage(_few(tops(stored), n_groups), "merkle-tops"), ["g"], "merkle-groups")
    height = (max(n_groups, 1) - 1).bit_length()
    groups = groups.select(F.lit("").alias("g"), "idx", "digest", F.lit(height).alias("height"), F.struct("g").alias("payload"))
    trunk = build(stage(_few(groups, n_groups), "merkle-trunk"), n_groups, height, "merkle-trunk")
    root = tops(trunk).select(F.lit("").alias("g"), F.col("digest").alias("note"),
                              F.expr("cast(array() as array<struct<sibling: string, left: boolean>>)").alias("path"))
    over = proofs(trunk, n_groups, root, "merkle-trunk").select(
        "payload.g", "path", F.struct(F.col("digest").alias("subroot"), F.col("note").alias("root")).alias("note"))
    over = stage(_few(over, n_groups), "merkle-over")

    folded = fold(F.coalesce("payload.tampered", "digest"), F.col("path"))
    return (proofs(stored, n, over, "merkle")
            .select("payload.doc_id", F.col("digest").alias("leaf"), "note.subroot", "note.root",
                    proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def tampered_manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang") -> DataFrame:
    """``manifest`` after adding 1 to ``n_chars`` (nulls stay) where 7 divides the crc32 of the id's decimal digits.

    A row with a null id isn't tampered with.
    """
    one_more = F.col("n_chars").cast("decimal(38,0)") + F.lit(1)
    return manifest(docs, id_col, group_col, changed={"n_chars": one_more},
                    suspect=F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 0)


__all__ = ["LEAF_COLUMNS", "LEVELS", "build", "fold", "leaf", "manifest", "proof_digest", "proofs", "tampered_manifest",
           "tops"]
