"""SimHash fingerprints, the binary trie self-join that links them, and the groups they form.

Distinct fingerprints are the leaves of a binary trie. The join starts from a node paired with itself
and goes down both sides at once: each pair of nodes has up to four pairs of children, a pair that
parts at a bit has one more differing bit, and a pair with more than the budget is dropped together
with everything below it.

Fingerprints within a budget of b bits agree on at least one of b + 1 equal stretches of bits. So the
trie is built b + 1 times, with each stretch in front once, and the join only starts at the nodes
below a whole stretch, each paired with itself. These nodes are the groups that are dealt to tasks.
A node with more than ``NODE_ROWS`` leaves is dealt as the pairs of its descendants ``SPLIT_BITS``
further down, again and again while such nodes exist.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envstream.llm.common import keyed, place_of, rows_at, written
from envstream.llm.components import components

BITS, SHINGLE = 64, 3
NODE_ROWS, SPLIT_BITS = 4096, 10
#: Leaves and pairs of nodes that are held at a time; neither changes the result.
CHUNK_ROWS, FRONTIER = 100_000, 500_000


def _fingerprints(texts: list[str]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    made = np.zeros(len(texts), np.uint64)
    for row, text in enumerate(texts):
        # On bytes, lower() changes A to Z only, and split() cuts at the six separators.
        words = text.encode("utf-8").lower().split()
        if not words:
            continue
        shingles = ([b" ".join(words)] if len(words) < SHINGLE else
                    [b" ".join(three) for three in zip(words, words[1:], words[2:])])
        hashes = np.fromiter((xxh64_intdigest(s, 42) for s in shingles), np.uint64, len(shingles))
        set_bits = np.zeros(BITS, np.int64)
        for start in range(0, len(hashes), 1 << 16):
            some = hashes[start:start + (1 << 16)].astype(">u8").view(np.uint8)
            set_bits += np.unpackbits(some.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        made[row] = np.packbits(2 * set_bits > len(hashes)).view(">u8")[0]
    return made


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and its 64-bit ``fingerprint`` (as a signed long). A null text has no words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.concatenate([
                _fingerprints([t.as_py() or "" for t in batch.column(1).slice(at, 200)])
                for at in range(0, batch.num_rows, 200)] or [np.zeros(0, np.uint64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made.view(np.int64))], names=["doc_id", "fingerprint"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, fingerprint long")


def _stretches(parts: int) -> list[tuple[int, int]]:
    edges = [BITS * i // parts for i in range(parts + 1)]
    return list(zip(edges, edges[1:]))


def _turned(value: Column, by: int) -> Column:
    """Rotated left, so that bit ``by`` comes first."""
    if not by:
        return value
    return F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value, BITS - by))


def _bits(value: Column, first: int, end: int) -> Column:
    return F.shiftrightunsigned(value, BITS - end).bitwiseAND(F.lit((1 << (end - first)) - 1))


def trie_links(leaves: np.ndarray, starts: np.ndarray, right: np.ndarray, depth: np.ndarray,
               budget: int) -> np.ndarray:
    """Pairs (as positions) of leaves that differ in at most ``budget`` bits.

    Leaves are sorted by group, side and value; ``starts`` marks the first of each group. A group with one side is joined with itself, one with
    two sides across them; the pairs meet at bit ``depth`` of the group.
    """
    edges = np.flatnonzero(starts)
    ends = np.append(edges[1:], len(leaves))
    middle = np.array([a + np.searchsorted(right[a:b], True) for a, b in zip(edges, ends)], np.int64)
    two = (middle > edges) & (middle < ends)
    pure = np.where(two, middle, ends)
    alone = np.where(two, middle, edges)
    # A pair of nodes: bounds of both, the next bit, and whether they are one node.
    stack = [np.stack([edges, pure, alone, ends, depth[edges].astype(np.int64), (~two).astype(np.int64)])]
    links = []
    while stack:
        nodes = stack.pop()
        if nodes.shape[1] > FRONTIER:
            stack += np.array_split(nodes, -(-nodes.shape[1] // FRONTIER), axis=1)
            continue
        a, b, c, d, bit, same = nodes
        leaf = (b - a == 1) & (d - c == 1)
        met = nodes[:, leaf & (same == 0)]
        near = np.bitwise_count(leaves[met[0]] ^ leaves[met[2]]) <= budget
        links.append(met[:, near][[0, 2]])
        a, b, c, d, bit, same = nodes = nodes[:, ~leaf]
        if not nodes.shape[1]:
            continue
        cut = []
        for low, high in ((a, b), (c, d)):
            cut.append(_first_one(leaves, low, high, bit))
        m, n = cut
        below = bit + 1
        children = [np.stack([a, m, c, n, below, same]), np.stack([m, b, n, d, below, same]),
                    np.stack([a, m, n, d, below, 0 * same])]
        other = np.stack([m, b, c, n, below, 0 * same])[:, same == 0]
        found = np.concatenate([*children, other], axis=1)
        found = found[:, (found[0] < found[1]) & (found[2] < found[3])]
        # A node of one leaf needs no pair with itself.
        found = found[:, (found[5] == 0) | (found[1] - found[0] > 1)]
        # All leaves of a node agree on the bits above, so any two of them show what differs there.
        apart = np.bitwise_count((leaves[found[0]] ^ leaves[found[2]]) >> (
            np.uint64(BITS) - found[4].astype(np.uint64)))
        stack.append(found[:, apart <= budget])
    return np.concatenate(links, axis=1) if links else np.zeros((2, 0), np.int64)


def _first_one(leaves: np.ndarray, low: np.ndarray, high: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Per node, its first leaf with a one at its bit, by binary search in all nodes at once."""
    low, high = low.copy(), high.copy()
    shift = (BITS - 1 - bit).astype(np.uint64)
    while (open_ := low < high).any():
        middle = (low + high) // 2
        one = (leaves[np.minimum(middle, len(leaves) - 1)] >> shift) & np.uint64(1) == 1
        high = np.where(open_ & one, middle, high)
        low = np.where(open_ & ~one, middle + 1, low)
    return low


def _dealt(found: DataFrame, budget: int) -> DataFrame:
    """One row per leaf and start node: node (turn and path), value, depth, right.

    ``value`` is the fingerprint with the stretch of the turn in front, ``depth`` the bits that lead
    to the node. A path with an x is a pair of nodes, and ``right`` tells its sides apart.
    """
    stretches = _stretches(budget + 1)
    turns = [found.select(
        F.concat_ws("/", F.lit(i), _bits(F.col("fingerprint"), first, end)).alias("node"),
        F.lit(i).alias("turn"), _turned(F.col("fingerprint"), first).alias("value"),
        F.lit(end - first).alias("depth"), F.lit(False).alias("right"))
        for i, (first, end) in enumerate(stretches)]
    rows = reduce(DataFrame.union, turns)
    depth = max(end - first for first, end in stretches)
    done = []
    while True:
        rows = written(rows, "trie-nodes")
        large = written(rows.groupBy("node").agg(F.count("*").alias("n")).where(
            F.col("n") > NODE_ROWS).select("node"), "trie-large")
        if depth + SPLIT_BITS > BITS or large.isEmpty():
            return reduce(DataFrame.union, done, rows)
        done.append(rows.join(large, "node", "left_anti"))
        rows = _split(rows.join(large, "node", "left_semi"), budget)
        depth += SPLIT_BITS


def _split(rows: DataFrame, budget: int) -> DataFrame:
    """Pairs of descendants in place of each node; a pair of nodes has one differing bit already."""
    masks = [m for m in range(1 << SPLIT_BITS) if m.bit_count() <= budget]
    closer = [m for m in masks if m.bit_count() < budget]
    is_pair = F.col("node").contains("x")
    own = F.expr(f"cast(shiftrightunsigned(value, {BITS - SPLIT_BITS} - depth) "
                 f"& {(1 << SPLIT_BITS) - 1} as int)")
    mask = F.explode(F.when(is_pair, F.array(*map(F.lit, closer))).otherwise(
        F.array(*map(F.lit, masks))))
    rows = rows.withColumns({"own": own, "mask": mask}).withColumn(
        "other", F.col("own").bitwiseXOR(F.col("mask")))
    right = F.when(is_pair, F.col("right")).otherwise(F.col("own") > F.col("other"))
    step = F.when(is_pair | (F.col("mask") != 0), F.when(
        right, F.concat_ws("x", "other", "own")).otherwise(F.concat_ws("x", "own", "other"))
    ).otherwise(F.col("own").cast("string"))
    return rows.select(F.concat_ws("/", "node", step).alias("node"), "turn", "value",
                       (F.col("depth") + SPLIT_BITS).alias("depth"), right.alias("right"))


def links(found: DataFrame, budget: int) -> DataFrame:
    """Edges (a, b) of distinct fingerprints that span the groups of all linked ones.

    ``found`` has a ``fingerprint`` per row, each once. Within a task, links that close a circle are
    left out: they change no group.
    """
    if budget < 1:
        raise ValueError("distinct fingerprints differ in one bit at least")
    turned = np.array([first for first, _ in _stretches(budget + 1)], np.uint64)

    def joined(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        leaves = table["value"].to_numpy().view(np.uint64)
        pair = trie_links(leaves, starts, table["right"].to_numpy(), table["depth"].to_numpy(), budget)
        pair = pair[:, _spanning(pair, len(leaves))]
        by = turned[table["turn"].to_numpy()]
        back = (leaves >> by) | (leaves << ((np.uint64(BITS) - by) % np.uint64(BITS)))
        return pa.RecordBatch.from_arrays(
            [pa.array(back[side].view(np.int64)) for side in pair], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) < CHUNK_ROWS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            starts = _starts(table["node"])
            end = int(np.flatnonzero(starts)[-1])  # the last node may go on in the next batch
            if end:
                yield joined(table.slice(0, end), starts[:end])
            held = table.slice(end).to_batches()
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield joined(table, _starts(table["node"]))

    unsigned = F.col("value").bitwiseXOR(F.lit(-2 ** 63))
    return _dealt(found, budget).repartition("node").sortWithinPartitions(
        "node", "right", unsigned).mapInArrow(run, "a long, b long")


def _starts(node: pa.ChunkedArray) -> np.ndarray:
    changed = pa.compute.not_equal(node.slice(1), node.slice(0, len(node) - 1))
    return np.append(True, changed.to_numpy())


def _spanning(pair: np.ndarray, n: int) -> np.ndarray:
    """Positions of links that join two trees of the links before them."""
    parent = list(range(n))
    kept = []
    for i, (a, b) in enumerate(pair.T.tolist()):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append(i)
    return np.array(kept, np.int64)


def groups(docs: DataFrame, budget: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id.

    Documents without words share the fingerprint zero. Copies are one leaf of the trie. A null id
    takes part in links; a group of null ids only has a null component_id. Repeated rows give
    repeated rows; columns other than doc_id and text are not looked at; an empty table gives an
    empty result.
    """
    found = written(fingerprints(docs), "fingerprints")
    leaves = written(found.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "leaves")
    roots = components(links(leaves, budget))
    placed = leaves.join(roots, leaves.fingerprint == roots.node, "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "root").select("fingerprint", "component_id")
    return found.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def first_rows(docs: DataFrame, budget: int = 2) -> DataFrame:
    """One row of ``docs`` per group, unchanged: that of the least doc_id, then of the least hash of text.

    Ids may be null, which count last, or repeated.
    """
    named = keyed(docs).select("id_hash", "text_hash", "own.doc_id", "own.text").select(
        place_of().alias("doc_id"), "text")
    return rows_at(docs, groups(named, budget).select("component_id.*").distinct())
