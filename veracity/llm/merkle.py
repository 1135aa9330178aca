"""Merkle manifest of a dataset, folded from retained hash states.

Rows are leaves.  Per source, leaves in id order are joined in runs of
``FAN`` consecutive nodes, level by level, up to the source's subroot; the
subroots, in source order, likewise up to the root.  A parent keeps a copy of
its running hash state before each child slot.  To see what a changed leaf
does to the root, folding resumes the state of the leaf's slot with the
replacement and its right siblings only, then does the same at every parent
above; what lies to the left is never hashed again.

Leaf digests are built-in expressions next to the scan, so texts are neither
shuffled nor sent to Python.  Places come from a range sort and offsets per
sorted part, whatever share of the rows one source holds.  Subtrees of
``FAN ** 3`` leaves are groups of one shuffle each; the few nodes above them
climb the same way, and each subtree gets its path (the states' left parts and
right siblings of all parents above) in one join.

Digests are lower-case hexadecimal text, and so are their joins.

Defined cases: a null field is ``-``; rows with a null source form a source of
their own, which comes first; within a source null ids come first, equal ids
are ordered by leaf, and repeated rows are leaves each; for choosing edited
rows a null id counts as the empty text; an empty table gives no rows.  Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracity.session import materialize, scratch_tables

FAN, LEVELS = 16, 3
GROUP = FAN**LEVELS
_HEX = 64

_STEP = "tree string, pos long, n long, lefts array<string>, rights array<string>, top string"
_STEP_ARROW = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("lefts", pa.list_(pa.string())),
                         ("rights", pa.list_(pa.string())), ("top", pa.string())])
_LEAF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, edited boolean"
_LEAF_ARROW = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
                         ("verified", pa.bool_()), ("edited", pa.bool_())])


class Parent:
    """A node over up to ``FAN`` children, with its hash state before each slot."""

    def __init__(self, children: list[bytes]):
        self.children, self.before = b"".join(children), []
        state = hashlib.sha256()
        for child in children:
            self.before.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def left(self, slot: int) -> bytes:
        return self.children[:slot * _HEX]

    def right(self, slot: int) -> bytes:
        return self.children[(slot + 1) * _HEX:]

    def fold(self, slot: int, replacement: bytes) -> bytes:
        return resume(self.before[slot], replacement, self.right(slot))


def resume(before, replacement: bytes, right: bytes) -> bytes:
    """A parent's digest from its retained state, one replaced child and the siblings right of it."""
    state = before.copy()
    state.update(replacement)
    state.update(right)
    return state.hexdigest().encode()


def climb(nodes: list[bytes], n: int) -> list[list[Parent]]:
    """Parents above consecutive nodes of a tree of ``n``, ``LEVELS`` levels or as many as there are."""
    levels: list[list[Parent]] = []
    while n > 1 and len(levels) < LEVELS:
        levels.append([Parent(nodes[i:i + FAN]) for i in range(0, len(nodes), FAN)])
        nodes, n = [p.digest for p in levels[-1]], -(-n // FAN)
    return levels


def _sorted_rows(table: pa.Table) -> list[dict]:
    return table.sort_by("pos").to_pylist()


def _step(table: pa.Table) -> pa.Table:
    """Each node of a group with its path to the group's top node, and that node."""
    rows = _sorted_rows(table)
    levels = climb([r["digest"].encode() for r in rows], rows[0]["n"])
    top = levels[-1][0].digest if levels else rows[0]["digest"].encode()
    out = []
    for i, r in enumerate(rows):
        lefts, rights = [], []
        for parents in levels:
            i, slot = divmod(i, FAN)
            lefts.append(parents[i].left(slot).decode())
            rights.append(parents[i].right(slot).decode())
        out.append({"tree": r["tree"], "pos": r["pos"], "n": r["n"], "lefts": lefts, "rights": rights, "top": top.decode()})
    return pa.Table.from_pylist(out, schema=_STEP_ARROW)


_TOP = "tree string, pos long, n long, digest string"
_TOP_ARROW = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])


def _top(table: pa.Table) -> pa.Table:
    """The top node of a group of leaves."""
    rows = _sorted_rows(table)
    first = rows[0]
    levels = climb([r["digest"].encode() for r in rows], first["n"])
    top = levels[-1][0].digest.decode() if levels else first["digest"]
    return pa.Table.from_pylist([{"tree": first["tree"], "pos": first["pos"] // GROUP, "n": -(-first["n"] // GROUP), "digest": top}],
                                schema=_TOP_ARROW)


def _fold(leaves: pa.Table, path: pa.Table) -> pa.Table:
    """Every leaf of a subtree folded to the root, with the digest of its proof."""
    rows = _sorted_rows(leaves)
    above = path.to_pylist()[0]
    upper = [(hashlib.sha256(left.encode()), right.encode()) for left, right in zip(above["lefts"], above["rights"])]
    rest = "".join(left + right for left, right in zip(above["lefts"], above["rights"])).encode()
    levels = climb([r["digest"].encode() for r in rows], rows[0]["n"])
    out = []
    for at, r in enumerate(rows):
        value, proof = (r["replacement"] or r["digest"]).encode(), hashlib.sha256()
        for parents in levels:
            at, slot = divmod(at, FAN)
            parent = parents[at]
            proof.update(parent.left(slot))
            proof.update(parent.right(slot))
            value = parent.fold(slot, value)
        for before, right in upper:
            value = resume(before, value, right)
        proof.update(rest)
        folded = value.decode()
        out.append({"doc_id": r["doc_id"], "leaf": r["digest"], "subroot": above["subroot"], "root": above["root"],
                    "proof_sha256": proof.hexdigest(), "folded_root": folded, "verified": folded == above["root"],
                    "edited": r["replacement"] is not None})
    return pa.Table.from_pylist(out, schema=_LEAF_ARROW)


def _place(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``pos`` of each node in its ``tree`` by ``order``, and the tree's size ``n``, without collecting any tree.

    Nodes are range-sorted (equal ones too, by their row number in the written
    table), so a tree is a run of consecutive parts and a row's place is the
    count of its tree in earlier parts plus its place in its own.
    """
    line = nodes.withColumn("_line", F.monotonically_increasing_id())
    keys = ["tree", *order, "_line"]
    line = line.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_line")
    line = materialize(line.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    line = line.withColumn("_part", F.shiftright("_at", 33))
    parts = line.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_c"), F.min("_at").alias("_first"))
    tree = Window.partitionBy("tree")
    parts = parts.withColumn("n", F.sum("_c").over(tree)).withColumn(
        "_before", F.sum("_c").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
    pos = F.coalesce(F.col("_before"), F.lit(0)) + F.col("_at") - F.col("_first")
    return line.join(parts, ["tree", "_part"]).withColumn("pos", pos).drop("_part", "_at", "_c", "_first", "_before")


def _group() -> Column:
    return F.floor(F.col("pos") / GROUP).cast("long").alias("grp")


def _paths(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``tree, pos, lefts, rights`` from each of ``nodes(tree, pos, n, digest)`` up, and ``tree, digest`` of the tree roots."""
    steps = []
    while True:
        nodes = materialize(nodes, "nodes")
        if nodes.where("n > 1").isEmpty():
            break
        step = materialize(nodes.groupBy("tree", _group()).applyInArrow(_step, _STEP), "steps")
        steps.append(step)
        nodes = step.where(F.col("pos") % GROUP == 0).select(
            "tree", (F.col("pos") / GROUP).cast("long").alias("pos"), F.ceil(F.col("n") / GROUP).cast("long").alias("n"),
            F.col("top").alias("digest"))
    none = F.array().cast("array<string>")
    paths = nodes.select("tree", "pos", none.alias("lefts"), none.alias("rights"))
    for step in reversed(steps):
        up = paths.select("tree", F.col("pos").alias("grp"), F.col("lefts").alias("l"), F.col("rights").alias("r"))
        paths = step.withColumn("grp", _group()).join(up, ["tree", "grp"]).select(
            "tree", "pos", F.concat("lefts", "l").alias("lefts"), F.concat("rights", "r").alias("rights"))
    return paths, nodes.select("tree", "digest")


def _leaf(fields: list[Column]) -> Column:
    """The digest of a row: every field as its byte count, a colon and its value, or ``-``."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def dataset_manifest(docs: DataFrame, fields: list[str], edits: dict[str, Column] | None = None, edited: Column | None = None,
                     id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, edited`` per row.

    ``fields`` make up a leaf.  For rows where ``edited`` holds, the leaf is
    recomputed with the columns in ``edits`` in place of the original ones, and
    ``folded_root`` is the root that would follow; ``verified`` says whether it
    is the root.  Columns given may refer to any column of ``docs``.
    """
    edits, edited = edits or {}, F.lit(False) if edited is None else F.coalesce(edited, F.lit(False))
    source = docs[source_col].cast("string")
    leaves = docs.select(docs[id_col].cast("long").alias("doc_id"),
                         F.coalesce(F.concat(F.lit(":"), source), F.lit("-")).alias("tree"),  # "-" sorts before ":"
                         _leaf([docs[f] for f in fields]).alias("digest"),
                         F.when(edited, _leaf([edits.get(f, docs[f]) for f in fields])).alias("replacement"))
    with scratch_tables() as scratch:
        placed = materialize(_place(materialize(leaves, "leaves"), ["doc_id", "digest"]), "placed")
        tops = placed.select("tree", "pos", "n", "digest").groupBy("tree", _group()).applyInArrow(_top, _TOP)
        paths, subroots = _paths(tops)
        # The subroots form one tree more: its nodes are the sources, in their order.
        second = _place(materialize(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest"), "subroots"), ["source"])
        second = materialize(second, "subroots")
        above, root = _paths(second.select("tree", "pos", "n", "digest"))
        above = second.join(above, ["tree", "pos"]).join(root.withColumnRenamed("digest", "root"), "tree").select(
            F.col("source").alias("tree"), F.col("digest").alias("subroot"), "root", F.col("lefts").alias("l"), F.col("rights").alias("r"))
        path = paths.join(above, "tree").select("tree", F.col("pos").alias("grp"), "subroot", "root", F.concat("lefts", "l").alias("lefts"),
                                                F.concat("rights", "r").alias("rights"))
        folded = placed.groupBy("tree", _group()).cogroup(path.groupBy("tree", "grp")).applyInArrow(_fold, _LEAF)
        return scratch.keep(materialize(folded, "manifest"))
