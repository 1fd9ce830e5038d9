"""Sharding by a hierarchical weighted hash tree.

A key descends region, rack and shard. On each level every child draws a number from
the hash of the key and the child's name, -ln(u) / weight, and the least draw wins; a
node weighs what its shards weigh together. A child's draw depends on nothing else, so
a change of weight moves keys only between that child and its siblings: movement stays
within subtrees whose weights change, and a shard that comes as a region of its own
takes rows from all others and moves none between them.

Only the key decides: null keys go to one shard, equal keys always meet, whatever the
other columns hold. Rows with several key columns hash them together. Of draws that tie
the first child's wins; rows that tie for a slot get slots in any order; repeated rows get
a slot each; very long texts are read whole; an empty table gives no rows. place keeps
the input's columns, and replaces one of its result's name; shard_documents returns its
own columns only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.llm.store import count_off, keep_names, materialise, scoped

#: region -> rack -> shard -> weight
Tree = dict[str, dict[str, dict[int, float]]]

#: Eight shards of equal weight.
EIGHT: Tree = {
    "r0": {"k0": {0: 1.0, 1: 1.0}, "k1": {2: 1.0, 3: 1.0}},
    "r1": {"k0": {4: 1.0, 5: 1.0}, "k1": {6: 1.0, 7: 1.0}},
}


def grow(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """tree with one more shard in a region of its own, so that rows move into it only."""
    name = f"new{shard}"
    if name in tree or any(shard in rack for region in tree.values() for rack in region.values()):
        raise ValueError(f"shard {shard} is there already")
    return {**tree, name: {"k0": {shard: weight}}}


def weight_of(node: dict | float) -> float:
    return sum(map(weight_of, node.values())) if isinstance(node, dict) else float(node)


def _draw(keys: Sequence[Column], path: str, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(path), *keys), 11)
    return -F.log((bits + 0.5) / float(1 << 53)) / weight


def _descend(keys: Sequence[Column], node: dict, path: str) -> Column:
    """The shard under node; children without weight take nothing."""
    kids = [(name, kid, w) for name, kid in node.items() if (w := weight_of(kid)) > 0]
    if not kids:
        raise ValueError(f"{path or 'the tree'} has no weight")
    below = [F.lit(name).cast("int") if not isinstance(kid, dict) else _descend(keys, kid, f"{path}/{name}") for name, kid, _ in kids]
    if len(kids) == 1:
        return below[0]
    least = F.array_min(F.array(*(F.struct(_draw(keys, f"{path}/{name}", w).alias("d"), F.lit(i).alias("i")) for i, (name, _, w) in enumerate(kids))))["i"]
    if not isinstance(kids[0][1], dict):
        return F.element_at(F.array(*below), least + 1)
    out = below[-1]
    for i in range(len(kids) - 2, -1, -1):
        out = F.when(least == i, below[i]).otherwise(out)
    return out


def shard_of(keys: Sequence[Column], tree: Tree) -> Column:
    """The shard, an int, that the tree gives to a key."""
    return _descend(keys, tree, "")


def place(docs: DataFrame, keys: Sequence[str], tree: Tree, out: str = "shard") -> DataFrame:
    """docs with the shard of each row; a column of that name is replaced."""
    return keep_names(docs, {out: shard_of([F.col(k) for k in keys], tree)})


def with_slots(placed: DataFrame, order: Sequence[str], shard: str = "shard", out: str = "slot") -> DataFrame:
    """placed (materialised, for it is read more than once) with each shard's rows numbered from 0."""
    most = placed.groupBy(shard).count().agg(F.max("count")).first()[0] or 0
    return count_off(placed, [shard], list(order), out, most)


@scoped
def shard_documents(docs: DataFrame, tree: Tree = EIGHT, id_col: str = "doc_id", text_col: str = "text", grown: Tree | None = None) -> DataFrame:
    """One row for each document: id, size (UTF-8 bytes plus 1), text_crc32, law, shard, slot, grown_shard.

    A null text has no bytes and the checksum of none.
    """
    keys = [F.col(id_col)]
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(keys, tree).alias("shard"),
        shard_of(keys, grown if grown is not None else grow(tree, 1 + max(s for r in tree.values() for k in r.values() for s in k))).alias("grown_shard"),
    )
    return with_slots(materialise(rows), [id_col, "size", "text_crc32"])
