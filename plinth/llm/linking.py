"""From shared hash keys to verified links and connected components, without all pairs.

Nodes that share a key are candidates. In every bucket the nodes are paired with its
least node, so a bucket of n gives n - 1 pairs, and pairs that several buckets give are
one. Short sketches drop pairs that cannot be links; the rest is verified in full, and
links join components. A link that misses the least nodes of its buckets is found after
that: the nodes that met the least nodes of one component are a group, and in groups that
still hold several components, nodes of different components are compared block by block,
first by sketch, then, where any are alike, in full. A group that fits a block is one task, to
which each node goes once; of larger ones, tasks hold two blocks of bounded size. Tasks
give flags or one link for each union, never all pairs. So a large group of near copies
costs one comparison a node, and still no link within a bucket is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.llm.store import is_small, materialise, release
from plinth.llm.words import arrow_stream

#: Nodes of a block when sketches are compared, and when payloads are, and the payloads' bytes; a task holds two blocks at most.
SKETCH_BLOCK, BLOCK_NODES, BLOCK_BYTES = 8192, 2048, 8 << 20

#: Nodes whose sets a worker holds at once while it reduces links.
FOREST_NODES = 1_000_000
#: Links, reduced by partition, that one task joins at once, without rounds; their nodes are twice as many at most.
ONE_TASK = 200_000

#: Tells for payloads a[i] and b[i] whether the two are linked.
Verify = Callable[[list[bytes], list[bytes]], np.ndarray]
#: Takes a block's payloads; the function that it gives tells for one of them which of all it is linked with.
Prepare = Callable[[list[bytes]], Callable[[int], np.ndarray]]


class Union:
    """Disjoint sets of nodes; the least node stands for its set."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (p := self.up.get(root, root)) != root:
            root = p
        while (p := self.up.get(x, x)) != root:
            self.up[x] = root
            x = p
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def star_pairs(keys: DataFrame) -> DataFrame:
    """(a, b), distinct: every node b that shares a key with others, and the least node a of that key. keys: (key, node)."""
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("a")).filter("n > 1").select("key", "a")
    return keys.join(shared, "key").filter("node <> a").select("a", F.col("node").alias("b")).distinct()


def verified(pairs: DataFrame, payloads: DataFrame, verify: Verify) -> DataFrame:
    """Those of pairs (a, b) that are linked. payloads: (node, payload)."""
    left = pairs.join(payloads.select(F.col("node").alias("b"), F.col("payload").alias("pb")), "b")
    both = left.join(payloads.select(F.col("node").alias("a"), F.col("payload").alias("pa")), "a").select("a", "b", "pa", "pb")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows * (16 << 20) // max(batch.nbytes, 1))
            parts = [batch.slice(at, step) for at in range(0, batch.num_rows, step)]
            ok = pa.array([x for p in parts for x in verify(p.column(2).to_pylist(), p.column(3).to_pylist()).tolist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])

    return arrow_stream(both, each, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of links (a, b); a component is named by its least node.

    Each partition first reduces its links to a forest. Few that remain are reduced in one
    task, which spares the driver the plans of all rounds. Else large stars and small
    stars take turns until nothing changes: a logarithmic number of rounds, each of two
    aggregations that combine before the shuffle and joins whose hot side can be split.
    """

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Union()
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.join(x, y)
            if len(found.up) > FOREST_NODES:
                yield from tree(found)
                found = Union()
        yield from tree(found)

    def tree(found: Union) -> Iterator[pa.RecordBatch]:
        nodes = list(found.up)
        for at in range(0, len(nodes), 50_000):
            some = nodes[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([found.find(x) for x in some], pa.int64())], names=["a", "b"])

    # a is always the greater node
    now = materialise(arrow_stream(links.filter("a <> b").select("a", "b"), forest, "a long, b long").distinct())
    few = now.count() <= ONE_TASK
    if few:
        links, now = now, materialise(arrow_stream(now.coalesce(1), forest, "a long, b long"))
        release(links)
    seen = None
    while not few:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()  # rows are distinct, and no number of them overflows
        if state == seen or not state[0]:
            break
        seen = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = materialise(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        new = materialise(small.distinct())
        release(now, large)
        now = new
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _blocks(left_over: DataFrame, payloads: DataFrame, prepare: Prepare, block: int, flag: bool) -> DataFrame:
    """Links (a, b) between components of a group, or with flag (key, node) of nodes that have any.

    left_over: key, node, component, main.

    Nodes of the group's main component, that of its least node, are compared with
    the others only, and the others with each other: in one task if the group fits a
    block, else block by block. Sketches are short, so flags go by nodes alone.
    """
    sized = left_over.withColumn("bytes", F.lit(0)) if flag else left_over.join(payloads.select("node", F.octet_length("payload").alias("bytes")), "node")
    amount = lambda on, what: (F.sum(F.when(on, 1).otherwise(0)).alias(f"n_{what}"), F.sum(F.when(on, F.col("bytes").cast("long")).otherwise(0)).alias(f"bytes_{what}"))
    sizes = sized.groupBy("key").agg(*amount(F.col("main"), "main"), *amount(~F.col("main"), "other"))
    counted = left_over.join(sizes, "key")
    many = lambda what: F.greatest(F.ceil(F.col(f"n_{what}") / block), F.ceil(F.col(f"bytes_{what}") / BLOCK_BYTES), F.lit(1)).cast("int")
    of_main, of_other = many("main"), many("other")
    own = F.pmod(F.xxhash64("node"), F.when(F.col("main"), of_main).otherwise(of_other)).cast("int")
    fits = (F.col("n_main") + F.col("n_other") <= block) & (F.col("bytes_main") + F.col("bytes_other") <= BLOCK_BYTES)
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    group = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    met = F.transform(upto(of_other), lambda x: group(1, x, F.col("own")))
    meets = F.concat(
        F.transform(upto(of_other), lambda x: group(0, F.least("own", x), F.greatest("own", x))),
        F.transform(upto(of_main), lambda x: group(1, F.col("own"), x)),
    )
    alone = F.array(group(0, F.lit(0), F.lit(0)))
    groups = F.explode(F.when(fits, alone).when(F.col("main"), met).otherwise(meets)).alias("g")
    rows = counted.withColumn("own", own).select("key", "node", "component", "main", "own", groups).select("key", "g.kind", "g.i", "g.j", "main", "own", "node", "component")
    full = rows.join(payloads, "node").select("key", "kind", "i", "j", "main", "own", "node", "component", "payload")
    dealt = full.repartition("key", "kind", "i", "j").sortWithinPartitions("key", "kind", "i", "j", "main", "own", "node")

    def compare(group: list[tuple]) -> Iterator[tuple[int, int]]:
        """Rows: key, kind, i, j, main, own, node, component, payload."""
        found = Union()
        key, kind, i, j = group[0][:4]
        linked_with = prepare([r[8] for r in group])
        right = np.array([r[4] if kind else r[5] == j for r in group])
        component = np.array([r[7] for r in group])
        flagged: set[int] = set()
        for at, r in enumerate(group):
            if r[4] or not kind and r[5] != i:
                continue
            hits = np.flatnonzero(linked_with(at) & right & (component != component[at]))
            if flag:
                flagged.update(hits.tolist(), [at] if len(hits) else [])
                continue
            for x in hits:
                if found.join(r[7], group[x][7]):
                    yield r[6], group[x][6]
        yield from ((key, group[x][6]) for x in flagged)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            links: list[tuple[int, int]] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and group[0][:4] != row[:4]:
                    links += compare(group)
                    group = []
                group.append(row)
            yield _links(links)
        if group:
            yield _links(list(compare(group)))

    return arrow_stream(dealt, each, "a long, b long")


def _links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*links) if links else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def link(
    keys: DataFrame,
    sketches: DataFrame,
    payloads: Callable[[DataFrame], DataFrame],
    alike: tuple[Verify, Prepare],
    linked: tuple[Verify, Prepare],
) -> DataFrame:
    """(node, component) of all nodes that a verified link joins with another.

    keys: (key, node), distinct and materialised. sketches: (node, payload) of all nodes,
    short; payloads gives the same of the nodes of a frame, in full. alike and linked tell
    for two sketches whether there may be a link, for two payloads whether there is.
    """
    pairs = materialise(star_pairs(keys))
    likely = materialise(verified(pairs, sketches, alike[0]))
    known = materialise(payloads(likely.select(F.explode(F.array("a", "b")).alias("node")).distinct()))
    first = materialise(verified(likely, known, linked[0]))
    release(likely, known)
    joined = materialise(components(first))
    groups = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a")
    members = pairs.select("a", "b").join(groups, "a").select(F.col("a").alias("key"), F.col("b").alias("node")).unionByName(groups.select(F.col("a").alias("key"), F.col("a").alias("node")))
    label = joined.select("node", "component")
    labelled = members.join(label, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    # groups whose least nodes are in one component are one group, so that a node is in it once
    mains = label.select(F.col("node").alias("key"), F.col("component").alias("of_key"))
    grouped = labelled.join(mains, "key", "left").select(F.coalesce("of_key", "key").alias("key"), "node", "component").distinct()
    labelled = materialise(grouped.withColumn("main", F.col("component") == F.col("key")))
    open_ = labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("key")
    left_over = materialise(labelled.join(open_, "key", "left_semi"))
    flagged = materialise(_blocks(left_over, sketches, alike[1], SKETCH_BLOCK, True).select(F.col("a").alias("key"), F.col("b").alias("node")).distinct())
    some = flagged.limit(1).count()
    if some:
        left_over = materialise(left_over.join(flagged, ["key", "node"], "left_semi"))
        known = materialise(payloads(flagged.select("node").distinct()))
        more = materialise(_blocks(left_over, known, linked[1], BLOCK_NODES, False))
        release(known)
        joined = materialise(components(first.unionByName(more)))
    release(pairs, labelled, flagged, left_over)
    return joined


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """df marked for broadcast if it is counted to be small."""
    return F.broadcast(df) if is_small(df) else df
