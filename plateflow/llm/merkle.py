"""A Merkle manifest of a dataset: one tree per group, the groups' roots below one root, a proof for every row.

A group's leaves lie in a fixed order; runs of eight consecutive nodes are hashed to a parent, until
one is left. Rows are worked on in superblocks of 512 consecutive leaves, which is what three levels
below one node span. On the way up each superblock gives one node, and these few are put into
superblocks in turn, through the groups' roots up to the root. On the way down the nodes of a
superblock and what it needs from outside (the siblings above it, the two roots) are cogrouped: one
task does the local reduction again, joins proofs and folds them. No task holds more than one
superblock of any group, however large the group is, and leaves are shuffled twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from plateflow.functions.ordering import By, Want, add_orders
from plateflow.llm.frames import column
from plateflow.session import cut

RUN = 8
#: Levels of a superblock; it has RUN**LEVELS leaves.
LEVELS = 3

NODES = "key string, n long, no long, node string"
OUTER = "key string, no long, subroot string, root string, before array<string>, after array<string>"
PROOFS = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def measured(value: Column) -> Column:
    """A value as its length in UTF-8 bytes, a colon and itself; null as a dash."""
    written = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written), F.lit("-"))


def leaf_of(parts: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[measured(p) for p in parts]), 256)


def reduce(nodes: list[str], n: int, most: int = LEVELS) -> tuple[list[list[str]], str, int]:
    """Levels of a superblock below its top, the top, and how many nodes its group has at the top's level.

    ``n`` nodes of the group are on the level of ``nodes``: a run of one is hashed too unless it is all there is.
    """
    levels = []
    while n > 1 and len(levels) < most:
        levels.append(nodes)
        nodes = [digest("".join(nodes[i:i + RUN])) for i in range(0, len(nodes), RUN)]
        n = -(-n // RUN)
    return levels, nodes[0], n


def siblings(levels: list[list[str]], place: int) -> tuple[list[str], list[str]]:
    """For each level, the siblings before and after the node above ``place``, as hex."""
    before, after = [], []
    for level in levels:
        start = place - place % RUN
        before.append("".join(level[start:place]))
        after.append("".join(level[place + 1:start + RUN]))
        place //= RUN
    return before, after


def fold(node: str, before: Sequence[str], after: Sequence[str]) -> str:
    """The root that a node and its siblings lead to."""
    for left, right in zip(before, after, strict=True):
        node = digest(left + node + right)
    return node


class Superblocks:
    """Climbing and descending by superblocks of ``levels`` levels."""

    def __init__(self, levels: int) -> None:
        self.levels, self.span = levels, RUN**levels

    def _placed(self, nodes: DataFrame) -> DataFrame:
        return nodes.withColumn("block", F.call_function("div", F.col("no"), F.lit(self.span)))

    def climb(self, nodes: DataFrame) -> DataFrame:
        """One node for each superblock: key, n (nodes of the group on that level), no, node."""
        most = self.levels

        def top(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            _, node, n = reduce(rows.sort_values("no")["node"].tolist(), int(rows["n"].iloc[0]), most)
            return pd.DataFrame({"key": [key[0]], "n": [n], "no": [key[1]], "node": [node]})

        return self._placed(nodes.select("key", "n", "no", "node")).groupBy("key", "block").applyInPandas(top, NODES)

    def descend(self, nodes: DataFrame, outer: DataFrame, are_subroots: bool) -> DataFrame:
        """What the children of these nodes need from outside, from what the nodes' superblocks need."""
        most = self.levels

        def work(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
            if rows.empty or above.empty:
                return pd.DataFrame(columns=["key", "no", "subroot", "root", "before", "after"])
            rows, over = rows.sort_values("no"), above.iloc[0]
            levels, _, _ = reduce(rows["node"].tolist(), int(rows["n"].iloc[0]), most)
            paths = [siblings(levels, i) for i in range(len(rows))]
            return pd.DataFrame({
                "key": rows["child"].tolist(), "no": rows["child_no"].tolist(),
                "subroot": rows["node"].tolist() if are_subroots else [over["subroot"]] * len(rows),
                "root": [over["root"]] * len(rows),
                "before": [[*b, *over["before"]] for b, _ in paths], "after": [[*a, *over["after"]] for _, a in paths]})

        return self._cogrouped(nodes, outer, work, OUTER)

    def finish(self, leaves: DataFrame, outer: DataFrame) -> DataFrame:
        """Reduction, proofs and folding of the superblocks of leaves."""
        most, names = self.levels, [part.split()[0] for part in PROOFS.split(", ")]

        def work(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
            if rows.empty or above.empty:
                return pd.DataFrame(columns=names)
            rows, over = rows.sort_values("no"), above.iloc[0]
            leaves, root = rows["node"].tolist(), over["root"]
            levels, _, _ = reduce(leaves, int(rows["n"].iloc[0]), most)
            beyond = "".join(b + a for b, a in zip(over["before"], over["after"], strict=True))
            proofs, folded = [], []
            for i, (leaf, changed) in enumerate(zip(leaves, rows["changed"].tolist(), strict=True)):
                before, after = siblings(levels, i)
                proofs.append(digest("".join(b + a for b, a in zip(before, after, strict=True)) + beyond))
                folded.append(fold(changed or leaf, [*before, *over["before"]], [*after, *over["after"]]))
            return pd.DataFrame({
                "doc_id": rows["doc_id"], "leaf": leaves, "subroot": over["subroot"], "root": root,
                "proof_sha256": proofs, "folded_root": folded, "verified": [f == root for f in folded]})[names]

        return self._cogrouped(leaves, outer, work, PROOFS)

    def _cogrouped(self, nodes: DataFrame, outer: DataFrame, work, schema: str) -> DataFrame:
        return self._placed(nodes).groupBy("key", "block").cogroup(outer.groupBy("key", "no")).applyInPandas(work, schema)


def manifest(docs: DataFrame, doc_id: str = "doc_id", group: str = "lang", text: str = "text",
             fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), tampered_every: int = 3,
             levels: int = LEVELS) -> DataFrame:
    """Leaf, roots and proof of every document, and what a proof gives for a tampered one.

    Leaves are the SHA-256 of ``fields`` (each a dash if null, else UTF-8 byte count, colon, value);
    they ascend by ``doc_id`` within ``group``, groups by their bytes, null first. Returns doc_id,
    leaf, subroot, root, proof_sha256 (siblings level by level, left to right, of the untampered
    tree), folded_root and verified. Tampering lower-cases A-Z of the text where ``tampered_every``
    divides crc32 of the decimal doc_id; a null text stays, a null id is never tampered and comes
    first in its group. Rows with one id are ordered by leaf, so equal rows have equal leaves and
    proofs of their own places. A lone leaf is its subroot, a lone subroot the root; an empty table
    gives an empty result. Other columns are not read, whatever their names. ``levels`` sets the size of
    a superblock and changes no result.
    """
    parts = {f: column(docs, f) for f in fields}
    number = column(docs, doc_id).cast("long")
    lower = parts | {text: F.translate(column(docs, text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}
    chosen = F.crc32(number.cast("string").cast("binary")) % tampered_every == 0
    name = column(docs, group).cast("string")
    # Null comes before every name, and names keep their order behind a letter.
    slim = cut(docs.select(F.coalesce(F.concat(F.lit("v"), name), F.lit("n")).alias("key"), number.alias("doc_id"),
                           leaf_of(list(parts.values())).alias("node"),
                           F.when(chosen, leaf_of(list(lower.values()))).alias("changed")))
    leaves = add_orders(slim, ["node"], Want([By("doc_id", nulls_last=False)], ["key"], row_number="place", rows="n")).select(
        "key", "n", (F.col("place") - 1).alias("no"), "node",
        # As text: pandas has no whole numbers beside nulls.
        F.col("doc_id").cast("string").alias("doc_id"), "changed")

    # Up: one node per superblock until each group has one, then the groups' roots in order until one is left.
    blocks = Superblocks(levels)
    steps: list[DataFrame] = []

    def top_of(nodes: DataFrame) -> DataFrame:
        nodes = cut(blocks.climb(nodes))
        while (nodes.agg(F.max("n")).first()[0] or 0) > 1:
            steps.append(nodes.withColumns({"child": F.col("key"), "child_no": F.col("no")}))
            nodes = cut(blocks.climb(nodes))
        return nodes

    ordered = add_orders(top_of(leaves).select("key", "node"), ["key"], Want([], row_number="place", rows="n"))
    subroots = cut(ordered.select(F.lit("").alias("key"), "n", (F.col("place") - 1).alias("no"), "node",
                                  F.col("key").alias("child"), F.lit(0).cast("long").alias("child_no")))
    steps.append(subroots)
    root = top_of(subroots)

    # Down: what lies outside each superblock.
    nothing = F.array().cast("array<string>")
    outer = root.select("key", "no", F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"),
                        nothing.alias("before"), nothing.alias("after"))
    for step in reversed(steps):
        outer = cut(blocks.descend(step, outer, step is subroots))
    return blocks.finish(leaves, outer).withColumn("doc_id", F.col("doc_id").cast("long"))
