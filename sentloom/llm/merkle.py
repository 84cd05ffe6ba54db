"""A Merkle manifest of a dataset: a tree of runs of three per source, and one over the sources.

Lag and lead windows build it. The rows of a source are numbered and cut into blocks
of ``3 ** LEVELS`` positions. Inside a block, a node of level l stands at the row of its
first leaf, so its siblings are at fixed offsets of one and two times ``3 ** l`` rows;
which of them belong to its run is told by its slot and by the length of the run. The
nodes that blocks leave over are the rows of the next tier, so no window holds more
than a block, whatever the size of a source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentloom.llm.common import Scratch

ARITY = 3
# Levels inside a block: 729 leaves.
LEVELS = 6
BLOCK = ARITY ** LEVELS
# Parts among which rows that agree in source and id are spread while they are numbered.
SALTS = 1 << 20
# The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Rows up to which a table of subroots, or of blocks' proofs, is sent to every executor (some 4 KB a row at most).
SENT_ROWS = 4_000

STEP = "struct<before:string,after:string>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of strings put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; ``-`` for NULL."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(row: dict[str, Column]) -> Column:
    """The leaf of a row, given its five fields."""
    return digest(*[field(row[c]) for c in FIELDS])


def without_line_breaks(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(""))


def numbered(rows: DataFrame, group: str, order: list[str], scratch: Scratch) -> DataFrame:
    """``rows`` with ``pos`` (from 0, in their group by ``order``) and ``n`` (rows of the group); written.

    Range partitions on (group, order, salt) are written once, so that their borders hold;
    rows of a group are numbered inside their partition and moved up by the partitions
    before. Rows that agree in everything but the salt are spread, too. The group is never NULL.
    """
    keys = [group, *order, "salt"]
    ranged = scratch.write(rows.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "merkle-ranged")
    sizes = scratch.write(ranged.groupBy(group, "part").agg(F.count(F.lit(1)).alias("rows")), "merkle-sizes")
    whole = Window.partitionBy(group)
    offsets = sizes.select(
        group, "part", F.coalesce(F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"),
        F.sum("rows").over(whole).alias("n"),
    )
    inside = F.row_number().over(Window.partitionBy(group, "part").orderBy(*order, "salt"))
    out = ranged.withColumn("_inside", inside).join(offsets, [group, "part"]).withColumn("pos", F.col("_ahead") + F.col("_inside") - 1)
    out = scratch.write(out.drop("part", "salt", "_ahead", "_inside"), "merkle-numbered")
    scratch.drop(ranged)
    scratch.drop(sizes)
    return out


def _level(name: str, level: int) -> Column:
    """Where a row's node of a level is one of several of its group, its slot; else -1.

    Only rows at which a node of the level starts have one.
    """
    step = ARITY ** level
    starts = (F.col("pos") % step == 0) & (F.col("n") > step)
    return F.when(starts, F.floor(F.col("pos") / step) % ARITY).otherwise(-1).cast("int").alias(name)


def with_levels(nodes: DataFrame) -> DataFrame:
    """Add to (group, pos, n, d0) the block, and d1 to d6: the digest of the node that starts at a row.

    A level of which the group has one node in all leaves it as it is.
    """
    out = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK))
    order = Window.partitionBy("grp", "block").orderBy("pos")
    for level in range(LEVELS):
        step, own = ARITY ** level, f"d{level}"
        run = F.concat(F.col(own), *[
            # Beyond the last row of the group a lead is NULL: the run is shorter there.
            F.coalesce(F.lead(own, step * i).over(order), F.lit("")) for i in range(1, ARITY)
        ])
        first = F.col("pos") % (step * ARITY) == 0
        made = F.when(first & (F.col("n") > step), digest(run)).when(first, F.col(own))
        out = out.withColumn(f"d{level + 1}", made)
    return out


def with_proofs(levels: DataFrame, above: DataFrame | None) -> DataFrame:
    """Add ``proof``, the steps from each row's node up to the root; ``above`` has those of the blocks' nodes.

    A step is what stands before and after the node in its run. From the highest level
    down, a node's proof is its own step and its parent's proof, which stands one or two
    steps earlier, at the run's first row.
    """
    none = F.array().cast(f"array<{STEP}>")
    order = Window.partitionBy("grp", "block").orderBy("pos")
    if above is None:
        out = levels.withColumn("proof", none)
    else:
        up = above.select("grp", F.col("pos").alias("block"), F.col("proof").alias("_up"))
        out = levels.join(up, ["grp", "block"]).withColumn("proof", F.col("_up")).drop("_up")
    # The proof above the highest level belongs to the block's first row.
    for level in reversed(range(LEVELS)):
        step = ARITY ** level
        at = lambda c, i: F.lag(c, step * -i).over(order) if i < 0 else F.lead(c, step * i).over(order)
        near = {i: F.coalesce(at(f"d{level}", i), F.lit("")) for i in (-2, -1, 1, 2)}
        slot = F.col("_slot")
        out = out.withColumn("_slot", _level("_slot", level))
        mine = F.struct(
            F.when(slot == 2, F.concat(near[-2], near[-1])).when(slot == 1, near[-1]).otherwise("").alias("before"),
            F.when(slot == 0, F.concat(near[1], near[2])).when(slot == 1, near[1]).otherwise("").alias("after"),
        )
        parents = F.when(slot == 0, F.col("proof")).when(slot == 1, at("proof", -1)).otherwise(at("proof", -2))
        # One node in the group: nothing to go up to at this level. No node here: no proof yet.
        here = F.col("pos") % step == 0
        out = out.withColumn("proof", F.when(slot >= 0, F.concat(F.array(mine), parents)).when(here, F.col("proof")).otherwise(none))
    return out.drop("_slot", *[f"d{i}" for i in range(1, LEVELS + 1)])


@dataclass
class Tree:
    """Tiers of one forest: tier 0 has the leaves, each further one the nodes its blocks leave over."""

    tiers: list[DataFrame]
    roots: DataFrame


def grow(leaves: DataFrame, scratch: Scratch) -> Tree:
    """Build all tiers over (grp, pos, n, d0) and the root of each group (grp, root); written."""
    tiers, nodes = [], leaves
    while True:
        tiers.append(nodes)
        tops = with_levels(nodes).where(F.col("pos") % BLOCK == 0).select(
            "grp", "block", F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), F.col(f"d{LEVELS}").alias("d0")
        )
        nodes = scratch.write(tops.select("grp", F.col("block").alias("pos"), "n", "d0"), "merkle-tier")
        # Groups with one node are done, and go along unchanged: a lone node is not hashed again.
        if (nodes.agg(F.max("n")).first()[0] or 1) == 1:
            return Tree(tiers, nodes.select("grp", F.col("d0").alias("root")))


def proofs(tree: Tree, above: DataFrame | None, scratch: Scratch) -> DataFrame:
    """Tier 0 with the proof of each leaf; ``above`` goes on from the groups' roots (grp, pos = 0, proof)."""
    for nodes in reversed(tree.tiers):
        if above is not None and above.count() <= SENT_ROWS:
            above = F.broadcast(above)
        above = with_proofs(with_levels(nodes), above)
        if nodes is not tree.tiers[0]:
            above = scratch.write(above.select("grp", "pos", "proof"), "merkle-proofs")
    return above


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(proof, leaf, lambda acc, step: digest(step["before"], acc, step["after"]))


def merkle_manifest(docs: DataFrame, tampered: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root and proof of every row, and what a changed copy of it gives.

    ``proof`` lists, from the leaf up to the root, what stands before and after the node in
    its run, as hex digests; ``proof_sha256`` is the digest of them all, ``folded_root`` the
    root that ``tampered`` (columns in place of fields, where ``where`` holds) and the proof
    give, and ``verified`` whether that is the root. Without ``tampered`` every row verifies.

    Leaves ascend by doc_id, NULL first; rows with equal ids by their leaf, repeated rows
    follow each other and each has a proof. A NULL field is ``-``, so an empty text is not
    a NULL one. Rows without a source form one group, the first. A table with one row has
    its leaf as root and an empty proof; an empty table gives no rows. Columns other than
    the five fields are not read.
    """
    scratch = Scratch(docs.sparkSession)
    own = {c: F.col(c) for c in FIELDS}
    hold = F.coalesce(where, F.lit(False)) if where is not None else F.lit(True)
    changed = leaf_digest(own | tampered) if tampered else leaf_digest(own)
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("grp"), "doc_id", leaf_digest(own).alias("d0"),
        (F.when(hold, changed) if tampered else F.lit(None).cast("string")).alias("changed"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int").alias("salt"),
    )
    rows = scratch.write(rows, "merkle-leaves")
    leaves = numbered(rows, "grp", ["doc_id", "d0"], scratch)
    scratch.drop(rows)
    tree = grow(leaves, scratch)
    # The sources are the leaves of one more tree, ordered as their keys are: NULL has the least.
    subroots = tree.roots.select(F.lit("").alias("grp"), F.col("grp").alias("skey"), F.col("root").alias("d0"), F.lit(0).alias("salt"))
    crown = numbered(subroots, "grp", ["skey"], scratch)
    top = grow(crown, scratch)
    above = proofs(top, None, scratch)
    above = above.join(F.broadcast(top.roots), "grp").select(
        F.col("skey").alias("grp"), F.lit(0).cast("long").alias("pos"), "proof", F.col("d0").alias("subroot"), "root"
    )
    above = scratch.write(above, "merkle-subroots")
    out = proofs(tree, above.select("grp", "pos", "proof"), scratch)
    ends = above.select("grp", "subroot", "root")
    if above.count() <= SENT_ROWS:
        ends = F.broadcast(ends)
    siblings = F.array_join(F.flatten(F.transform("proof", lambda s: F.array(s["before"], s["after"]))), "")
    return out.join(ends, "grp").select(
        "doc_id", F.col("d0").alias("leaf"), "subroot", "root", "proof",
        F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
        folded(F.coalesce("changed", "d0"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
