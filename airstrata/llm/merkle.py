"""A Merkle manifest of a table, with a proof for every row.

Rows are leaves, in the order of their key within each group; up to ``arity`` consecutive
nodes become one node of the level above until one is left, and the groups' last nodes become
the root in the same way. Every level is built by a self-join: a node looks for its siblings at
indices computed from its own, XOR with one in binary trees and offsets within the run of
its slot otherwise, and the rows at slot zero then emit the parents. Going down again, parents hand
their own path to their children, so no join is on a group alone.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.rows import quoted
from .common import stored
from .order import numbered

ARITY = 8
LEAF = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before: string, after: string>>"


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 of the values in a row: ``-`` if NULL, else UTF-8 byte count, colon, value."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def linked(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes whose group has several, with the digests of their run ``before`` and ``after`` them."""
    slot = F.col("position") % arity
    shift = F.explode(F.sequence(F.lit(0), F.lit(arity - 1))).alias("shift")
    if arity == 2:
        sibling = F.col("position").bitwiseXOR(F.col("shift"))
    else:
        sibling = F.col("position") - slot + (slot + F.col("shift")) % arity
    asked = nodes.where("size > 1").select("*", shift)
    asked = asked.select(
        "group", "position", "size", sibling.alias("sibling"), F.when(F.col("shift") == 0, F.col("row")).alias("row")
    ).where("sibling < size")
    held = nodes.select("group", F.col("position").alias("sibling"), "digest")
    runs = asked.join(held, ["group", "sibling"]).groupBy("group", "position").agg(
        F.first("size").alias("size"),
        F.first("row", ignorenulls=True).alias("row"),
        F.sort_array(F.collect_list(F.struct("sibling", "digest"))).alias("run"),
    )

    def side(keep) -> Column:
        return joined(F.transform(F.filter("run", keep), lambda m: m["digest"]))

    return runs.select(
        "group",
        "position",
        "size",
        "row",
        joined(F.transform(F.filter("run", lambda m: m["sibling"] == F.col("position")), lambda m: m["digest"])).alias("digest"),
        side(lambda m: m["sibling"] < F.col("position")).alias("before"),
        side(lambda m: m["sibling"] > F.col("position")).alias("after"),
    )


def parents(nodes: DataFrame, arity: int) -> DataFrame:
    """The level above, from the linked nodes at slot zero; they see their whole run."""
    return nodes.where(F.col("position") % arity == 0).select(
        "group",
        F.floor(F.col("position") / arity).alias("position"),
        F.ceil(F.col("size") / arity).alias("size"),
        F.lit(None).cast(nodes.schema["row"].dataType).alias("row"),
        F.sha2(F.concat("digest", "after").cast("binary"), 256).alias("digest"),
    )


def levels_of(leaves: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """The linked nodes of every level, and each group's last node (with ``height``, its level).

    ``leaves``: group, position, size (of the group), row (what to carry), digest.
    """
    levels, tops, level = [], leaves.where("size = 1").select("*", F.lit(0).alias("height")), leaves
    most = leaves.agg(F.max("size")).first()[0] or 0
    while most > 1:
        levels.append(stored(linked(level, arity), "level"))
        level = parents(levels[-1], arity)
        tops = tops.unionByName(level.where("size = 1").select("*", F.lit(len(levels)).alias("height")))
        most = -(-most // arity)
    return levels, tops


def handed_down(levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """group, position, row, digest, subroot and path of every leaf.

    ``tops``: group, height, row, digest (of the group's last node), path (from there on).
    """
    below = None
    for height in range(len(levels), -1, -1):
        found = tops.where(F.col("height") == height).select(
            "group", F.lit(0).cast("long").alias("position"), "row", "digest", F.col("digest").alias("subroot"), "path"
        )
        if below is not None:
            above = below.select("group", F.col("position").alias("above"), "subroot", "path")
            nodes = levels[height].withColumn("above", F.floor(F.col("position") / arity))
            path = F.concat(F.array(F.struct("before", "after")), "path").alias("path")
            found = found.unionByName(
                nodes.join(above, ["group", "above"]).select("group", "position", "row", "digest", "subroot", path)
            )
        below = found
    return below


def manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = LEAF,
    key: str = "doc_id",
    group: str = "lang",
    arity: int = ARITY,
    carried: dict[str, Column] | None = None,
) -> DataFrame:
    """Per row: ``key``, leaf, subroot, root, path, and the ``carried`` expressions by name.

    A leaf is the ``leaf_digest`` of ``columns``. Leaves of a group ascend by key (NULL first; rows
    of one key by their leaf, and rows that repeat are leaves of their own). Groups ascend, NULL
    first, by UTF-8 bytes. ``path`` lists, level by level up to the root, the digests that
    come before and after the node in its run, joined. An empty table has no rows and no root.
    NULL and empty texts differ (``-`` against ``0:``). Only digests, keys and carried values
    leave the first scan.
    """
    if arity < 2:
        raise ValueError("a node has at least two children")
    carried = carried or {}
    label = quoted(group).cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("+"), label), F.lit("!")).alias("group"),  # "!" comes first
        F.struct(quoted(key).alias("key"), *[c.alias(f"carried {n}") for n, c in carried.items()]).alias("row"),
        leaf_digest([quoted(c) for c in columns]).alias("digest"),
    )
    leaves = stored(numbered(leaves, [F.col("row.key").asc_nulls_first(), F.col("digest")], "group"), "leaves")
    levels, tops = levels_of(leaves, arity)
    tops = stored(tops, "subroots")

    groups = numbered(tops.select("digest", F.col("group").alias("row")), [F.col("row")])
    upper, ends = levels_of(stored(groups.withColumn("group", F.lit("")), "groups"), arity)
    ends = stored(ends.withColumn("path", F.array().cast(PATH)), "root")
    root = ends.first()
    paths = handed_down(upper, ends, arity).select(F.col("row").alias("group"), "path")
    rows = handed_down(levels, tops.join(paths, "group"), arity)
    return rows.select(
        F.col("row.key").alias(key),
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root["digest"] if root else None).cast("string").alias("root"),
        "path",
        *[F.col(f"row.`carried {n}`").alias(n) for n in carried],
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(
        path, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]).cast("binary"), 256)
    )


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path in order."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "").cast("binary"), 256)


def tampering(docs: DataFrame) -> DataFrame:
    """The manifest's digests, and what becomes of the root if some rows are altered.

    Rows whose id's CRC-32 three divides have A to Z in their text lower-cased (never those
    without an id or text); their altered leaf is folded along the original path.
    """
    altered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    values = [F.when(altered, lower).otherwise(F.col(c)) if c == "text" else quoted(c) for c in LEAF]
    rows = manifest(docs, carried={"claimed": leaf_digest(values)})
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.col("claimed"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
