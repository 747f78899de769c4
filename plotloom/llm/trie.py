"""Prefix trie of conversations by union-find over neighbours in sorted order.

A turn is the pair (role, text), known by a 128-bit digest.  Conversations are cut into blocks
of ``BLOCK`` turns; a block goes with the digest of all turns before it, so one conversation of
any length is spread over many rows.  Equal blocks are counted, the distinct ones are sorted, and
neighbours in the same place of the trie are joined by an edge whose depth is the length of their
longest common prefix (LCP).

A batch of sorted blocks is a forest of its own: its edges are taken in descending depth, and
every merge of two components in a union-find creates a branching node (or a further child of the
node that the same depth has made).  Nodes that may go on in a neighbouring batch (those of the first and the
last block, the starts of blocks and their ends) are contracted to one row each, and such rows
are merged by the digest of their prefix, across batches and partitions alike.

Sums over a subtree need no walk: a node's bytes are counted at the least conversation that
has it, its owner.  A conversation owns the end of its path from some depth on, so a first round
finds these depths and a second one adds up, per node, figures of its member conversations.

Defined results: rows without a conv_id belong to no conversation and are left out; turns are ordered by
``turn`` (null first), turns of one number by their digest; a null role or text is empty.
Repeated rows are turns of their own.  An empty table gives no node, not even a root.  Other
columns of the input may have any name.

What reaches the driver is two rows per partition of the sorted turns.  Ids of one ending are hashed
in order by one task, read in pieces of a batch; SHA-256 cannot be split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotloom.operators.sizing import cut_lineage
from plotloom.session import shuffle_partitions

# Turns in a block; the longest key that is sorted has 16 bytes for each.
BLOCK = 64
NO_ENDS = hashlib.sha256(b"").hexdigest()


# Turns -----------------------------------------------------------------------------


def placed(turns: DataFrame) -> DataFrame:
    """(conv_id, place, a, b, size): every turn with its place from 0, its digest and its text's bytes.

    Places are counted in range partitions of the sorted turns, and a conversation that goes on in
    the next partition is counted on there, so no task needs to hold a whole conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long"),
        "turn",
        F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), text, role).alias("b"),
        F.octet_length(text).cast("long").alias("size"),
        F.rand(5).alias("chance"),  # spreads equal rows
    )
    order = ["conv_id", "turn", "a", "b", "chance"]
    dealt = rows.repartitionByRange(shuffle_partitions(turns.sparkSession), *order).sortWithinPartitions(*order)
    dealt = cut_lineage(dealt.select("conv_id", "a", "b", "size", F.spark_partition_id().alias("part")))
    starts = _starts(dealt)

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.asarray(batch.column(0))
            if conv is None:
                conv, seen = starts.get(batch.column(4)[0].as_py(), (None, 0))
            turns_ = np.flatnonzero(np.diff(ids)) + 1
            begins = np.concatenate(([0], turns_))
            sizes = np.diff(np.concatenate((begins, [len(ids)])))
            place = np.arange(len(ids)) - np.repeat(begins, sizes)
            if ids[0] == conv:
                place[: sizes[0]] += seen
            conv, seen = int(ids[-1]), int(place[-1]) + 1
            columns = [batch.column(0), pa.array(place), *(batch.column(i) for i in (1, 2, 3))]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "place", "a", "b", "size"])

    return dealt.mapInArrow(number, "conv_id long, place long, a long, b long, size long")


def _starts(dealt: DataFrame) -> dict[int, tuple[int, int]]:
    """Per partition the last conversation before it and how many of its turns are before it."""

    def edges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, last, count = None, None, None, 0
        for batch in batches:
            ids = np.asarray(batch.column(0))
            if not len(ids):
                continue
            if part is None:
                part, first = batch.column(1)[0].as_py(), int(ids[0])
            if ids[-1] != last:
                count = 0
            last = int(ids[-1])
            count += int((ids == last).sum())
        if part is not None:
            values = [pa.array([v], pa.int64()) for v in (part, first, last, count)]
            yield pa.RecordBatch.from_arrays(values, ["part", "first", "last", "count"])

    schema = "part long, first long, last long, count long"
    starts, conv, seen = {}, None, 0
    for row in sorted(dealt.select("conv_id", "part").mapInArrow(edges, schema).collect()):
        if conv is not None:
            starts[row["part"]] = (conv, seen)
        whole = row["first"] == row["last"] == conv  # one conversation fills the partition
        conv, seen = row["last"], row["count"] + (seen if whole else 0)
    return starts


def lengths(numbered: DataFrame) -> DataFrame:
    """(conv_id, n): how many turns a conversation has."""
    return numbered.groupBy("conv_id").agg(F.count("*").alias("n"))


# Blocks ----------------------------------------------------------------------------


def _blocks(numbered: DataFrame) -> DataFrame:
    """One row per conversation and block, with the digest and the bytes before and after it."""
    turn = numbered.select(
        "conv_id",
        (F.col("place") / BLOCK).cast("long").alias("k"),
        "place",
        F.xxhash64("place", "a", "b").alias("u"),
        F.xxhash64("b", "place", "a").alias("v"),
        "size",
    )
    grouped = turn.groupBy("conv_id", "k").agg(
        F.sort_array(F.collect_list(F.struct("place", "u", "v", "size"))).alias("turns"),  # BLOCK at most
        F.bit_xor("u").alias("u"),
        F.bit_xor("v").alias("v"),
        F.sum("size").alias("size"),
    )
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.lit(0).cast("long")
    return grouped.select(
        "conv_id",
        "k",
        F.coalesce(F.bit_xor("u").over(before), nothing).alias("g"),
        F.coalesce(F.bit_xor("v").over(before), nothing).alias("h"),
        "u",
        "v",
        (F.sum("size").over(whole) - F.coalesce(F.sum("size").over(before), nothing)).alias("rest"),
        F.lead("k").over(whole.orderBy("k")).isNull().alias("last"),
        "turns",
    ).select(
        "conv_id",
        "k",
        "g",
        "h",
        F.col("g").bitwiseXOR(F.col("u")).alias("x"),
        F.col("h").bitwiseXOR(F.col("v")).alias("y"),
        (F.col("k") * BLOCK + F.size("turns")).alias("depth"),
        "rest",
        "last",
        F.flatten(F.transform("turns", lambda t: F.array(t["u"], t["v"]))).alias("tokens"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"),
    )


def _with_turnless(blocks: DataFrame, convs: DataFrame) -> DataFrame:
    """The blocks, and an empty one for every conversation without turns."""
    nothing = F.lit(0).cast("long")
    empty = F.array().cast("array<long>")
    turnless = convs.where("n = 0").select(
        "conv_id",
        *[nothing.alias(c) for c in ("k", "g", "h", "x", "y", "depth", "rest")],
        F.lit(True).alias("last"),
        empty.alias("tokens"),
        empty.alias("sizes"),
    )
    return blocks.unionByName(turnless)


def _ends(blocks: DataFrame) -> DataFrame:
    """(depth, x, y, ends): SHA-256 of the ids of the conversations that end there, in order."""
    order = ["x", "y", "depth", "conv_id"]
    ends = blocks.where("last").select(*order)
    dealt = ends.repartitionByRange(shuffle_partitions(blocks.sparkSession), *order).sortWithinPartitions(*order)
    schema = "x long, y long, depth long, least long, ends string, ids binary"

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The first and the last ending of a batch may go on elsewhere; their ids are passed on.
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([np.asarray(batch.column(i)) for i in range(3)])
            ids = batch.column(3).to_pylist()
            edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), len(ids)]
            digests, texts = [], []
            for begin, end in zip(edges, edges[1:]):
                text = ",".join(map(str, ids[begin:end])).encode()
                edge = begin == 0 or end == len(ids)
                digests.append(None if edge else hashlib.sha256(text).hexdigest())
                texts.append(text if edge else None)
            at = edges[:-1]
            columns = [pa.array(keys[i, at]) for i in range(3)]
            columns += [pa.array([ids[i] for i in at], pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["x", "y", "depth", "least", "ends", "ids"])

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            found = []
            for *key, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 5))):
                if key != now:
                    if now is not None:
                        found.append((*now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(ids)
                else:
                    digest.update(b"," + ids)
            if found:
                yield _rows(found)
        if now is not None:
            yield _rows([(*now, digest.hexdigest())])

    def _rows(found: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in list(zip(*found))[:3]]
        return pa.RecordBatch.from_arrays([*columns, pa.array([f[3] for f in found])], ["x", "y", "depth", "ends"])

    cut = cut_lineage(dealt.mapInArrow(pieces, schema))
    open_ = cut.where("ends is null").repartition("x", "y", "depth").sortWithinPartitions("x", "y", "depth", "least")
    whole = open_.mapInArrow(joined, "x long, y long, depth long, ends string")
    return cut.where("ends is not null").select("x", "y", "depth", "ends").unionByName(whole)


# Forests ---------------------------------------------------------------------------

FIGURES = ("n", "rest", "own", "leaves")
# A node as it leaves a batch.  The owner's own figures are needed beside the sums.
NODE = (
    "depth long, x long, y long, conv_id long, conv_own long, conv_rest long, "
    "n long, rest long, own long, leaves long, before long, kids long, ends string, parent long"
)
FOREST = f"kind int, up_x long, up_y long, node struct<{NODE}>, below array<struct<{NODE}>>"
_NODE = pa.struct(
    [(part.split()[0], pa.string() if part.split()[1] == "string" else pa.int64()) for part in NODE.split(", ")]
)
CLOSED, OPEN, BELOW = range(3)


def _union(lcp: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Depth, first item, last item and parent (-1: none) of the nodes of a batch's forest.

    Node i is item i for the first ``len(sizes)`` nodes.  An edge lies between items j and
    j + 1; a negative depth is no edge.
    """
    n = len(sizes)
    depth, first, last = sizes.tolist(), list(range(n)), list(range(n))
    parent = [-1] * n
    leader, top = list(range(n)), list(range(n))

    def find(i: int) -> int:
        while leader[i] != i:
            leader[i] = leader[leader[i]]
            i = leader[i]
        return i

    order = np.argsort(-lcp, kind="stable")
    for j, d in zip(order.tolist(), lcp[order].tolist()):
        if d < 0:
            break
        left, right = find(j), find(j + 1)
        a, b = top[left], top[right]
        leader[right] = left
        if depth[a] == d:  # one more child
            parent[b] = a
            last[a] = last[b]
        else:
            node = len(depth)
            depth.append(d)
            first.append(first[a])
            last.append(last[b])
            parent.append(-1)
            parent[a] = parent[b] = node
            top[left] = node
    return np.array(depth), np.array(first), np.array(last), np.array(parent)


def _padded(column: pa.ListArray, width: int, counts: np.ndarray) -> np.ndarray:
    out = np.zeros((len(counts), width), dtype=np.int64)
    out[np.arange(width) < counts[:, None]] = np.asarray(column.flatten())
    return out


def _forest(batch: pa.RecordBatch) -> pa.RecordBatch:
    column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    k, g, h, ended = (np.asarray(column[c]) for c in ("k", "g", "h", "ended"))
    items = batch.num_rows
    sizes = np.diff(np.asarray(column["tokens"].offsets)) // 2
    width = max(int(sizes.max()), 1)
    tokens = _padded(column["tokens"], 2 * width, 2 * sizes).reshape(items, width, 2)
    texts = _padded(column["sizes"], width, sizes)
    # Edges between neighbours of one segment (place in the trie where the block begins).
    fit = np.arange(width) < np.minimum(sizes[1:], sizes[:-1])[:, None]
    equal = ((tokens[1:] == tokens[:-1]).all(axis=2) & fit).cumprod(axis=1).sum(axis=1)
    apart = (k[1:] != k[:-1]) | (g[1:] != g[:-1]) | (h[1:] != h[:-1])
    depth, first, last, parent = _union(np.where(apart, -1, equal), sizes)
    # Digest and bytes of every prefix: column d is for the first d turns.
    digests = np.concatenate((np.stack((g, h), axis=1)[:, None, :], tokens), axis=1)
    digests = np.bitwise_xor.accumulate(digests, axis=1)
    bytes_ = np.concatenate((np.zeros((items, 1), np.int64), texts.cumsum(axis=1)), axis=1)
    # Sums and owners of the nodes' runs of items.
    sums = {}
    for name in FIGURES:
        total = np.concatenate(([0], np.asarray(column[name]).cumsum()))
        sums[name] = total[last + 1] - total[first]
    owners = np.asarray(column["conv_id"])
    least = np.full(len(depth), -1)  # the item whose owner is least
    least[:items] = np.arange(items)
    order = np.argsort(-depth, kind="stable")
    for node in order.tolist():
        up = parent[node]
        if up >= 0 and (least[up] < 0 or owners[least[node]] < owners[least[up]]):
            least[up] = least[node]
    # Every node of the batch stands for the chain of depths down to it; depth 0 is the segment's start.
    above = np.where(parent >= 0, depth[parent], 0)
    length = np.maximum(depth - above, 0)
    rows = np.repeat(np.arange(len(depth)), length)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(length) - length, length) + above[rows] + 1
    bottom = at == depth[rows]
    edge = (first == 0) | (last == items - 1)
    going = np.zeros(len(depth), dtype=bool)  # conversations that go on in the next block
    going[:items] = (sizes == BLOCK) & (ended < np.asarray(column["n"]))
    is_open = edge[rows] | (bottom & going[rows])
    # Children: one inside a chain, those of the node at its lower end.
    top_row = np.full(len(depth), -1)
    top_row[length > 0] = (np.cumsum(length) - length)[length > 0]
    tops = np.flatnonzero(top_row >= 0)
    with_parent = tops[parent[tops] >= 0]
    closed_top = ~is_open[top_row[with_parent]]
    all_kids = np.bincount(parent[with_parent], minlength=len(depth))
    closed_kids = np.bincount(parent[with_parent][closed_top], minlength=len(depth))
    # An open row counts its closed children only; the open ones are counted once merged.
    next_open = np.append(is_open[1:], False)
    kids = np.where(
        bottom, np.where(is_open, closed_kids[rows], all_kids[rows]), np.where(is_open & next_open, 0, 1)
    )
    up_open = np.ones(len(rows), dtype=bool)
    up_owner = np.zeros(len(rows), dtype=np.int64)
    inner = at > above[rows] + 1
    up_open[inner] = is_open[np.flatnonzero(inner) - 1]
    up_owner[inner] = owners[least[rows[inner]]]
    outer = np.flatnonzero(~inner)
    ups = parent[rows[outer]]
    real = (ups >= 0) & (above[rows[outer]] > 0)
    up_row = top_row[ups[real]] + length[ups[real]] - 1
    up_open[outer[real]] = is_open[up_row]
    up_owner[outer[real]] = owners[least[ups[real]]]
    ends = np.array([None] * len(rows), dtype=object)
    shown = np.flatnonzero(bottom & (rows < items))
    item_ends = column["ends"].to_pylist()
    ends[shown] = [item_ends[i] for i in rows[shown].tolist()]
    head = first[rows]

    def struct(pick: np.ndarray, known: np.ndarray) -> pa.StructArray:
        who, place = rows[pick], at[pick]
        owner = least[who]
        key = digests[head[pick], place]
        values = [
            k[head[pick]] * BLOCK + place,
            key[:, 0],
            key[:, 1],
            owners[owner],
            np.asarray(column["conv_own"])[owner],
            np.asarray(column["conv_rest"])[owner],
            *(sums[name][who] for name in FIGURES),
            bytes_[head[pick], place - 1],
            kids[pick],
        ]
        fields = [pa.array(v, pa.int64()) for v in values]
        fields += [pa.array(ends[pick], pa.string()), pa.array(up_owner[pick], pa.int64(), mask=~known)]
        return pa.StructArray.from_arrays(fields, fields=list(_NODE))

    closed = np.flatnonzero(~is_open & ~up_open)
    opened = np.flatnonzero(is_open)
    below = np.flatnonzero(~is_open & up_open)
    below = below[np.lexsort((head[below], at[below]))]  # brothers side by side
    keys = digests[head[below], at[below] - 1]
    same = np.concatenate((keys, at[below][:, None], k[head[below]][:, None]), axis=1)
    starts = np.flatnonzero(np.concatenate(([True], (same[1:] != same[:-1]).any(axis=1)))) if len(below) else below
    segments = np.flatnonzero(np.concatenate(([True], apart)))  # first item of each segment
    parts = [
        _part(CLOSED, None, struct(closed, np.ones(len(closed), bool)), None),
        _part(OPEN, digests[head[opened], at[opened] - 1], struct(opened, ~up_open[opened]), None),
        _part(BELOW, keys[starts], None, (struct(below, np.zeros(len(below), bool)), starts)),
        _part(OPEN, None, _segment_starts(column, segments, depth, parent, top_row, is_open, first, sums, owners, least), None),
    ]
    return pa.Table.from_batches([p for p in parts if p.num_rows]).combine_chunks().to_batches()[0]


def _segment_starts(column, segments, depth, parent, top_row, is_open, first, sums, owners, least) -> pa.StructArray:
    """The depth-0 node of every segment: the root with its members, or else the end of the block before.

    The latter's members are counted there, so only the closed children found here are added.
    """
    items = len(column["k"])
    k, g, h = (np.asarray(column[c]) for c in ("k", "g", "h"))
    tops = np.flatnonzero((parent < 0) | ((parent >= 0) & (depth[parent] == 0)))
    tops = tops[top_row[tops] >= 0]
    place = np.searchsorted(segments, first[tops], side="right") - 1
    kids = np.bincount(place[~is_open[top_row[tops]]], minlength=len(segments))
    ends_at = np.append(segments[1:], items)
    root = k[segments] == 0
    empty = np.asarray(column["tokens"].offsets)
    turnless = root & (empty[segments] == empty[segments + 1])
    totals = {}
    for name in FIGURES:
        total = np.concatenate(([0], np.asarray(column[name]).cumsum()))
        totals[name] = np.where(root, total[ends_at] - total[segments], 0)
    who = [b + int(np.argmin(owners[b:e])) for b, e in zip(segments.tolist(), ends_at.tolist())]
    item_ends = column["ends"].to_pylist()
    fields = [
        pa.array(k[segments] * BLOCK, pa.int64()),
        pa.array(g[segments], pa.int64()),
        pa.array(h[segments], pa.int64()),
        *(pa.array(np.asarray(column[c])[who], pa.int64(), mask=~root) for c in ("conv_id", "conv_own", "conv_rest")),
        *(pa.array(totals[name], pa.int64()) for name in FIGURES),
        pa.array(np.zeros(len(segments)), pa.int64(), mask=~root),
        pa.array(kids, pa.int64()),
        pa.array([item_ends[i] if t else None for i, t in zip(segments.tolist(), turnless.tolist())], pa.string()),
        pa.nulls(len(segments), pa.int64()),
    ]
    return pa.StructArray.from_arrays(fields, fields=list(_NODE))


def _part(kind: int, keys: np.ndarray | None, nodes: pa.StructArray | None, lists: tuple | None) -> pa.RecordBatch:
    if lists is None:
        size = len(nodes)
        below = pa.nulls(size, pa.list_(_NODE))
    else:
        values, starts = lists
        size = len(starts)
        below = pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)).astype(np.int32)), values)
        nodes = pa.nulls(size, _NODE)
    up = [pa.nulls(size, pa.int64())] * 2 if keys is None else [pa.array(keys[:, i], pa.int64()) for i in (0, 1)]
    columns = [pa.array(np.full(size, kind, dtype=np.int32)), *up, nodes, below]
    return pa.RecordBatch.from_arrays(columns, ["kind", "up_x", "up_y", "node", "below"])


def _forests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield _forest(batch)


def _nodes(blocks: DataFrame, ends: DataFrame | None) -> DataFrame:
    """Every node of the trie with its sums; ``blocks`` also has own and leaf per conversation."""
    key = ["k", "g", "h", "x", "y", "depth"]
    items = blocks.groupBy(*key).agg(
        F.min(F.struct("conv_id", "own", "rest")).alias("owner"),
        F.count("*").alias("n"),
        F.sum("rest").alias("rest"),
        F.sum("own").alias("own"),
        F.sum("leaf").alias("leaves"),
        F.sum(F.col("last").cast("long")).alias("ended"),
        F.first("tokens").alias("tokens"),
        F.first("sizes").alias("sizes"),
    )
    if ends is None:
        items = items.withColumn("ends", F.lit(None).cast("string"))
    else:
        # Where a whole block of conversations goes on, the same prefix may also be an ending.
        items = items.join(ends, ["x", "y", "depth"], "left")
    owner = F.col("owner")
    chosen = items.select(
        "k",
        "g",
        "h",
        "tokens",
        "sizes",
        *FIGURES,
        "ended",
        owner["conv_id"].alias("conv_id"),
        owner["own"].alias("conv_own"),
        owner["rest"].alias("conv_rest"),
        "ends",
    )
    order = ["k", "g", "h", "tokens"]
    dealt = chosen.repartitionByRange(shuffle_partitions(blocks.sparkSession), *order).sortWithinPartitions(*order)
    found = cut_lineage(dealt.mapInArrow(_forests, FOREST))
    node = F.col("node")
    contracted = found.where(F.col("kind") == OPEN).select("up_x", "up_y", "node.*")
    merged = contracted.groupBy("depth", "x", "y").agg(
        F.min(F.when(F.col("conv_id").isNotNull(), F.struct("conv_id", "conv_own", "conv_rest"))).alias("owner"),
        *[F.sum(name).alias(name) for name in FIGURES],
        F.max("before").alias("before"),
        F.sum("kids").alias("kids"),
        F.max("ends").alias("ends"),
        F.max("parent").alias("parent"),
        F.max("up_x").alias("up_x"),
        F.max("up_y").alias("up_y"),
    )
    merged = cut_lineage(merged.select("*", "owner.*").drop("owner"))
    more = merged.where("up_x is not null").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("up_x").alias("x"), F.col("up_y").alias("y")
    )
    more = more.agg(F.count("*").alias("more"))
    ups = merged.select(
        (F.col("depth") + 1).alias("depth"), F.col("x").alias("up_x"), F.col("y").alias("up_y"), F.col("conv_id").alias("up")
    )
    names = [part.split()[0] for part in NODE.split(", ")]
    whole = merged.join(more, ["depth", "x", "y"], "left").withColumn("kids", F.col("kids") + F.coalesce("more", F.lit(0)))
    whole = whole.join(ups, ["depth", "up_x", "up_y"], "left").withColumn("parent", F.coalesce("parent", "up"))
    # Brothers share a row until their parent is known, so a parent of very many is no hot key.
    below = found.where(F.col("kind") == BELOW).withColumn("depth", F.get("below", F.lit(0))["depth"])
    below = below.join(ups, ["depth", "up_x", "up_y"]).select("up", F.explode("below").alias("node"))
    below = below.select("node.*", "up").withColumn("parent", F.col("up"))
    closed = found.where(F.col("kind") == CLOSED).select(node["depth"].alias("depth"), *[node[c].alias(c) for c in names[1:]])
    return closed.unionByName(below.select(*names)).unionByName(whole.select(*names))


def prefix_trie(numbered: DataFrame, convs: DataFrame) -> DataFrame:
    """Every node: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (bytes that sharing saves in the subtree) and ends (SHA-256 of the ids that end there).

    ``numbered`` has the turns as ``placed`` gives them; ``convs`` (conv_id, n) has every conversation,
    also those without turns.
    """
    blocks = cut_lineage(_with_turnless(_blocks(numbered), convs))
    nothing = F.lit(0).cast("long")
    first = _nodes(blocks.withColumns({"own": nothing, "leaf": nothing}), None)
    facts = first.groupBy("conv_id").agg(
        F.max(F.col("conv_rest") - F.col("before")).alias("own"),
        F.max((F.col("kids") == 0).cast("long")).alias("leaf"),
    )
    known = blocks.join(facts, "conv_id", "left").withColumns(
        {"own": F.coalesce("own", nothing), "leaf": F.coalesce("leaf", nothing)}
    )
    nodes = _nodes(known, _ends(blocks))
    shared = F.col("rest") - F.col("n") * F.col("before")
    distinct = F.col("own") - F.col("conv_own") + F.col("conv_rest") - F.col("before")
    return nodes.select(
        "conv_id",
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (shared - distinct).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends"),
    )


def with_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes with the role and text of their last turn; ``turns`` is (conv_id, place, role, text)."""
    last = turns.select("conv_id", (F.col("place") + 1).alias("depth"), "role", "text")
    return nodes.join(last, ["conv_id", "depth"], "left")


def shared_heads(numbered: DataFrame, base: Column, head: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the first turns of others: (turns as ``placed`` gives them, convs).

    ``base`` names, per conv_id, the conversation whose first ``head`` turns (all, if it has fewer)
    stand in place of the own first ``head`` turns.
    """
    known = lengths(numbered)
    convs = known.select("conv_id", "n", base.alias("base"), head.cast("long").alias("head"))
    bases = known.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("head", F.coalesce("base_n", F.lit(0)))
    convs = convs.join(bases, "base", "left").withColumn("taken", taken)
    convs = cut_lineage(convs.withColumn("rest", F.greatest(F.col("n") - F.col("head"), F.lit(0))))
    heads = convs.where("taken > 0").select("conv_id", "base", F.explode(F.sequence(F.lit(0), F.col("taken").cast("int") - 1)).alias("place"))
    heads = heads.withColumn("place", F.col("place").cast("long"))
    longest = numbered.withColumnRenamed("conv_id", "base")
    heads = heads.join(longest, ["base", "place"]).select("conv_id", "place", "a", "b", "size")
    # A long conversation is dealt out by stretches of turns.
    stretch = lambda place: (place / SPAN).cast("long")
    spans = convs.where("rest > 0").select(
        "conv_id", "head", "taken", F.explode(F.sequence(F.lit(0).cast("long"), stretch(F.col("n") - 1))).alias("span")
    )
    tails = numbered.withColumn("span", stretch(F.col("place"))).join(spans, ["conv_id", "span"]).where("place >= head")
    tails = tails.select("conv_id", (F.col("place") - F.col("head") + F.col("taken")).alias("place"), "a", "b", "size")
    return heads.unionByName(tails), convs.select("conv_id", (F.col("taken") + F.col("rest")).alias("n"))


SPAN = 1024
