"""Merkle manifest: a hash tree over the rows of a table, and a proof for every row.

A node's place in its tree is its rank. The low digits of the rank (base two) name the
places within a bounded block; they are grouped away one after the other, each step
hashing its runs of children and nesting their structs. What remains of a block is one
row, which holds its whole subtree, and the hash of its root is a leaf of the next
tier. Transforms over the nested structs hand each child the siblings beside it, and one
explode gives the proofs; between tiers one row per block is met with its own path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.functions.ordering import global_position
from siftworks.sources.shared import materialize

# Digits of a rank within a block: a block has at most 2 ** DIGITS leaves.
DIGITS = 10

# A step of a path: what is hashed before and after the node's own hash.
PATH = "array<struct<before:string,after:string>>"

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A value as it is hashed: '-' for NULL, else the byte count, a colon and the value."""
    written = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written), F.lit("-"))


def digest(*inputs: Column) -> Column:
    return F.sha2(F.concat(*inputs), 256)


def leaf(**changed: Column) -> Column:
    """The hash of a row, with the columns of ``changed`` in place of its own."""
    return digest(*[field(changed.get(c, F.col(c))) for c in FIELDS])


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda h, step: digest(step["before"], h, step["after"]))


def proof(path: Column) -> Column:
    """One hash over all siblings of a path, from the leaf up and left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def roll_up(nodes: DataFrame, digits: int = DIGITS) -> DataFrame:
    """(grp, block, height, hash, tree): each block of ``nodes`` as one row with its nested subtree.

    ``nodes`` has grp, rank from 0 within it, height (the levels still to be hashed
    in the group's tree), hash and body. A level at or above the height hashes nothing:
    there the node is its only child.
    """
    place = [F.shiftright("rank", i).bitwiseAND(F.lit(1)).cast("tinyint").alias(f"d{i}") for i in range(digits)]
    level = nodes.select("grp", F.shiftright("rank", digits).alias("block"), "height", *place, "hash", F.col("body").alias("tree"))
    # all steps group within a block, so this exchange serves every one of them
    level = level.repartition("grp", "block")
    for i in range(digits):
        keys = ["grp", "block", "height", *[f"d{j}" for j in range(i + 1, digits)]]
        run = F.array_sort(F.collect_list(F.struct(f"d{i}", "hash", "tree")))
        level = level.groupBy(*keys).agg(run.alias("tree"))
        hashes = F.transform("tree", lambda c: c["hash"])
        hashed = F.when(F.col("height") > i, F.sha2(F.array_join(hashes, ""), 256)).otherwise(hashes[0])
        level = level.withColumn("hash", hashed)
    return level.select("grp", "block", F.greatest(F.col("height") - digits, F.lit(0)).alias("height"), F.col("height").alias("own"), "hash", "tree")


def unroll(blocks: DataFrame, digits: int = DIGITS) -> DataFrame:
    """(grp, rank, height, body, path): the leaves of ``roll_up`` with their paths; ``blocks`` has each root's own path."""

    def below(level: int, children: Column, place: Column, path: Column) -> Column:
        """An array of the leaves below a node of this level, given its children, place and path."""

        def child(c: Column, i: Column) -> Column:
            other = F.coalesce(F.get(children, 1 - i)["hash"], F.lit(""))
            nothing = F.lit("")
            step = F.struct(F.when(i == 1, other).otherwise(nothing).alias("before"), F.when(i == 0, other).otherwise(nothing).alias("after"))
            # each variable is used once, so that the expression grows by a constant per level
            own = F.concat(F.when(F.col("own") > level, F.array(step)).otherwise(F.array().cast(PATH)), path)
            at = place + c[f"d{level}"].cast("int") * F.lit(1 << level)
            if level:
                return below(level - 1, c["tree"], at, own)
            return F.array(F.struct(at.alias("place"), c["tree"].alias("body"), own.alias("path")))

        return F.flatten(F.transform(children, child))

    leaves = F.explode(below(digits - 1, F.col("tree"), F.lit(0), F.col("path"))).alias("leaf")
    rank = F.shiftleft("block", digits) + F.col("leaf.place")
    return blocks.select("grp", "block", "own", leaves).select(
        "grp", rank.cast("bigint").alias("rank"), F.col("own").alias("height"), F.col("leaf.body").alias("body"), F.col("leaf.path").alias("path")
    )


def trees(nodes: DataFrame, digits: int = DIGITS) -> tuple[DataFrame, list[DataFrame]]:
    """((grp, hash) of the root of every group, the stored tiers of blocks from the leaves up)."""
    tiers = []
    while True:
        tier = materialize(roll_up(nodes, digits), "merkle_blocks")
        tiers.append(tier)
        # by size of the stored table: a tier has one row for up to 2 ** digits of the one below
        if tier.filter("block > 0").isEmpty():
            return tier.select("grp", "hash"), tiers
        nodes = tier.select("grp", F.col("block").alias("rank"), "height", "hash", F.lit(None).cast("boolean").alias("body"))


def with_paths(tiers: list[DataFrame], tops: DataFrame, digits: int = DIGITS) -> DataFrame:
    """(grp, rank, body, path) of all leaves; ``tops`` (grp, path) has the path of each group's root."""
    above = tops.withColumn("block", F.lit(0).cast("bigint"))
    for tier in reversed(tiers):
        leaves = unroll(tier.join(above, ["grp", "block"]), digits)
        above = leaves.select("grp", F.col("rank").alias("block"), "path")
    return leaves.select("grp", "rank", "body", "path")


def _height(n: Column) -> Column:
    """Levels of a tree of n leaves: the binary digits of n - 1."""
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1))).cast("int")


def manifest(docs: DataFrame, tampered: Column | None = None, digits: int = DIGITS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, path), one row per row of ``docs``.

    A leaf is the hash of the row's columns ``FIELDS``; other columns are not read. The
    leaves of each lang, in the order of doc_id (NULL first, equal ids by their leaf), form a
    tree in which two consecutive nodes become their hash and a last single one that of
    itself; the subroots in the order of lang (NULL first, bytewise) form the tree above
    them. ``path`` is what is hashed before and after on the way from the leaf to the root;
    ``proof_sha256`` is the hash of these siblings.

    Where ``tampered``, a condition on the columns, holds, ``folded_root`` starts at the leaf
    of the row with one more in ``n_chars``, so it differs from the root unless ``n_chars`` is
    NULL. An empty table gives no rows. No text leaves its row: only hashes are
    sorted and moved. A lang may hold any share of the rows, since ranks come from
    ranges of all rows and blocks are bounded.
    """
    group = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    changed = F.when(F.lit(False) if tampered is None else tampered, leaf(n_chars=F.col("n_chars") + 1))
    hashed = docs.select(group.alias("grp"), "doc_id", leaf().alias("hash"), changed.alias("changed"))
    placed = materialize(global_position(hashed, ["grp", F.col("doc_id").asc_nulls_first(), "hash"], "at", 0), "merkle_leaves")
    sizes = materialize(placed.groupBy("grp").agg(F.min("at").alias("first"), F.count("*").alias("n")), "merkle_groups")
    body = F.struct("doc_id", "hash", "changed")
    leaves = placed.join(sizes, "grp").select("grp", (F.col("at") - F.col("first")).alias("rank"), _height(F.col("n")).alias("height"), "hash", body.alias("body"))
    subroots, tiers = trees(leaves, digits)

    # the tree over the groups, by the same steps: one more group whose leaves are the subroots
    n_groups = sizes.count()
    ordered = global_position(subroots, ["grp"], "rank", 0)
    tops = ordered.select(
        F.lit("").alias("grp"), "rank", _height(F.lit(n_groups)).alias("height"), "hash", F.struct("grp", "hash").alias("body")
    )
    root, upper = trees(tops, digits)
    crowns = with_paths(upper, root.select("grp", F.array().cast(PATH).alias("path")), digits).crossJoin(F.broadcast(root.select(F.col("hash").alias("root"))))
    crowns = materialize(crowns.select(F.col("body.grp").alias("grp"), F.col("body.hash").alias("subroot"), "path", "root"), "merkle_crowns")

    proved = with_paths(tiers, crowns.select("grp", "path"), digits)
    start = F.coalesce("body.changed", "body.hash")
    return (
        proved.join(crowns.drop("path"), "grp")
        .select(
            F.col("body.doc_id").alias("doc_id"),
            F.col("body.hash").alias("leaf"),
            "subroot",
            "root",
            proof(F.col("path")).alias("proof_sha256"),
            fold(start, F.col("path")).alias("folded_root"),
            "path",
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
