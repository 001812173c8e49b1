"""The prefix trie of step sequences (conversations of turns), one row a node.

1. Members with equal sequences form a class. Its ids, ascending, are hashed as a stream of chunks of
   at most ``CHUNK_IDS`` ids, so no task holds the ids of a large class.
2. A class's key is the digests of its steps one after the other. Classes are dealt out by ranges of
   the key into blocks of about ``BLOCK_BYTES`` and sorted within them, so that neighbours share the
   longest prefixes.
3. In a block, the neighbours' common prefix lengths (LCP) are edges. Union-find takes them in
   descending depth: the merge of two components at a depth makes a branching node there, or joins
   the second one to the first one's node of that depth. Steps between a node and its parent are
   nodes with one child.
4. Blocks are contracted to their first and last key. The same union-find over the LCPs within and
   between blocks tells which nodes go on across boundaries, and in which block each begins. Of
   those ("open") nodes every block gives its own share, counted so that shares add up: a node is
   the child of its parent only in the block where it begins, and its "less one member" is taken off
   there only. One aggregation merges the shares.

To the driver come three numbers a block. The nodes of a path through several blocks are the only
rows merged, at most one a block and depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from veracast.llm.common import kept
from veracast.llm.encode import ragged

STEP_BYTES = 16
BLOCK_BYTES = 16 << 20
# A block's least size where the input would make fewer blocks than cores.
LEAST_ROWS = 2_000
CHUNK_IDS = 1_000
_OUT_ROWS = 50_000
_CLASS = "cls binary, least bigint, n bigint, ends string"
_NODES = (
    "depth bigint, start int, conv bigint, parent_conv bigint, parent_start int, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved bigint, ends string"
)
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def step_digest(*parts: Column) -> Column:
    """``STEP_BYTES`` of SHA-256 over the parts, each but the last with its length in front."""
    framed = [c for p in parts[:-1] for c in (F.octet_length(p).cast("string"), F.lit(":"), p)]
    return F.unhex(F.substring(F.sha2(F.concat(*framed, parts[-1]).cast("binary"), 256), 1, 2 * STEP_BYTES))


def _id_hasher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cls, ids) sorted by class and id range to one row a class."""
    names = ["cls", "least", "n", "ends"]
    types = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
    done: list[tuple] = []
    current = least = hashed = None
    n = 0
    for batch in batches:
        for cls, first, count, ids in zip(*[c.to_pylist() for c in batch.columns]):
            if cls != current:
                if hashed is not None:
                    done.append((current, least, n, hashed.hexdigest()))
                current, least, n, hashed = cls, first, 0, hashlib.sha256(ids.encode())
            else:
                hashed.update(b"," + ids.encode())
            n += count
        if len(done) >= _OUT_ROWS:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
            done = []
    if hashed is not None:
        done.append((current, least, n, hashed.hexdigest()))
    if done:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)


def classes_of(members: DataFrame) -> DataFrame:
    """(id, key, weights) to one row a distinct key: key, weights, least id, n, SHA-256 of its ids."""
    # Ids are distinct, so a range of ids holds at most CHUNK_IDS of a class.
    bucket = F.expr(f"(id - pmod(id, {CHUNK_IDS})) div {CHUNK_IDS}").alias("bucket")
    ids = F.sort_array(F.collect_list("id")).alias("ids")
    chunks = members.select("id", "cls", bucket).groupBy("cls", "bucket").agg(ids)
    chunks = chunks.select(
        "cls",
        "bucket",
        F.col("ids")[0].alias("first"),
        F.size("ids").cast("bigint").alias("count"),
        F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("text"),
    )
    hashed = (
        chunks.repartition("cls")
        .sortWithinPartitions("cls", "bucket")
        .select("cls", "first", "count", "text")
        .mapInArrow(_id_hasher, _CLASS)
    )
    one = members.select(F.col("id").alias("least"), "cls", "key", "weights")
    return hashed.join(one, ["least", "cls"]).select("key", "weights", "least", "n", "ends")


def common_steps(a: bytes, b: bytes) -> int:
    """Number of whole steps that two keys begin with alike."""
    low, high = 0, min(len(a), len(b)) // STEP_BYTES
    while low < high:
        middle = (low + high + 1) // 2
        at, upto = low * STEP_BYTES, middle * STEP_BYTES
        if a[at:upto] == b[at:upto]:
            low = middle
        else:
            high = middle - 1
    return low


class Forest:
    """Nodes that union-find over neighbours' LCP edges in descending depth gives.

    Nodes 0 to n - 1 are the sorted sequences themselves, at their own depth; branching nodes follow.
    ``first`` and ``last`` are the sequences a node spans, ``parent`` is -1 for the top.
    """

    def __init__(self, lengths: list[int], edges: list[int]):
        n = len(lengths)
        self.depth, self.parent = list(lengths), [-1] * n
        self.first, self.last = list(range(n)), list(range(n))
        root, top = list(range(n)), list(range(n))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        # Stable, so the edges of one depth come from left to right.
        for i in np.argsort(-np.array(edges, np.int64), kind="stable").tolist():
            a, b, d = find(i), find(i + 1), edges[i]
            left, right = top[a], top[b]
            if self.depth[left] != d:
                node = len(self.depth)
                self.depth.append(d)
                self.parent.append(-1)
                self.first.append(self.first[left])
                self.last.append(self.last[left])
                self.parent[left] = node
                left = node
            self.parent[right] = left
            self.last[left] = self.last[right]
            root[b] = a
            top[a] = left


def begins(intra: list[int], bounds: list[int]) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """For each block: LCP with the block before and after (-1: none), and where its open nodes begin.

    ``intra`` holds the LCP of each block's first and last key, ``bounds`` that of a block's last and
    the next one's first. The last item of a block lists (depth, block): a node of that depth or less,
    down to the next item's, which holds the block's first key, begins in that block.
    """
    edges = [e for pair in zip(intra, [*bounds, -1]) for e in pair][:-1]
    far = max(edges, default=0) + 1
    forest = Forest([far] * (2 * len(intra)), edges)
    out = []
    for i in range(len(intra)):
        chain, node = [], forest.parent[2 * i]
        while node >= 0:
            start = forest.first[node] // 2
            if start < i:
                chain.append((forest.depth[node], start))
            node = forest.parent[node]
        left = bounds[i - 1] if i else -1
        out.append((left, bounds[i] if i < len(bounds) else -1, chain))
    return out


def block_nodes(keys, weights, least, counts, ends, part: int, left: int, right: int, chain):
    """Columns of ``_NODES`` of one block: all nodes of its sorted distinct keys."""
    n = len(keys)
    lengths = [len(k) // STEP_BYTES for k in keys]
    forest = Forest(lengths, [common_steps(a, b) for a, b in zip(keys, keys[1:])])
    depth, parent = np.array(forest.depth), np.array(forest.parent)
    first, last = np.array(forest.first), np.array(forest.last)
    size = len(depth)
    # Weights of the steps up to each depth of each sequence, one after the other.
    base = np.cumsum([0, *[k + 1 for k in lengths]])
    flat = np.zeros(base[-1], np.int64)
    for i, w in enumerate(weights):
        flat[base[i] + 1 : base[i] + 1 + lengths[i]] = w
    upto = np.cumsum(flat)
    from_left = first == 0
    above = np.where(parent >= 0, depth[parent], -1)
    # Shares of the compressed nodes, deepest first.
    convs, least_id = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    convs[:n], least_id[:n] = counts, least
    leaves, saved, children = (np.zeros(size, np.int64) for _ in range(3))
    has_child = np.zeros(size, bool)
    has_child[parent[parent >= 0]] = True
    leaves[:n] = ~has_child[:n]
    if lengths[-1] <= right:
        leaves[n - 1] = 0
    at = base[first]
    weight = upto[at + depth] - np.where(above >= 0, upto[at + np.maximum(above, 0)], 0)
    shared = np.minimum(depth, left)
    again = np.where(
        from_left & (shared > above),
        upto[at + np.maximum(shared, 0)] - np.where(above >= 0, upto[at + np.maximum(above, 0)], 0),
        0,
    )
    new_child = ~(from_left & (above + 1 <= left))
    for x in np.argsort(-depth, kind="stable").tolist():
        saved[x] += (convs[x] - 1) * weight[x] + again[x]
        p = parent[x]
        if p >= 0:
            convs[p] += convs[x]
            least_id[p] = min(least_id[p], least_id[x])
            leaves[p] += leaves[x]
            saved[p] += saved[x]
            children[p] += new_child[x]
    # One row for every depth from below the parent to the node itself.
    steps = depth - above
    owner = np.repeat(np.arange(size), steps)
    k = ragged(above + 1, steps)
    own_weight = flat[at[owner] + k]
    open_left = from_left[owner] & (k <= left)
    own = (convs[owner] - 1) * own_weight + np.where(open_left, own_weight, 0)
    before = np.cumsum(own) - own
    chain_start = np.cumsum(steps) - steps
    total = saved[owner] - (before - before[chain_start][owner])
    is_own = k == depth[owner]
    below = np.where(is_own, children[owner], 1 - (from_left[owner] & (k + 1 <= left)))
    is_open = open_left | ((last[owner] == n - 1) & (k <= right))
    begun = np.full(max(left, -1) + 2, part)
    for d, start in sorted(chain, reverse=True):
        begun[: min(d, left) + 1] = start
    start = np.where(open_left, begun[np.minimum(k, left)], part)
    higher = k - 1 > above[owner]
    up = np.where(higher, owner, parent[owner])
    up_left = from_left[up] & (k - 1 <= left)
    up_open = (k > 0) & (up_left | ((last[up] == n - 1) & (k - 1 <= right)))
    up_start = np.where(up_left, begun[np.clip(k - 1, 0, max(left, 0))], part)
    ended = is_own & (owner < n)
    texts = pa.array(ends, pa.string()).take(pa.array(np.where(ended, owner, 0), mask=~ended))
    return [
        pa.array(k, pa.int64()),
        pa.array(start.astype(np.int32), mask=~is_open),
        pa.array(least_id[owner]),
        pa.array(least_id[up], mask=(k == 0) | up_open),
        pa.array(up_start.astype(np.int32), mask=~up_open),
        pa.array(convs[owner]),
        pa.array(below.astype(np.int64)),
        pa.array(leaves[owner]),
        pa.array(total),
        texts,
    ]


def _builder(shared):
    names = [c.split()[0] for c in _NODES.split(", ")]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value

        def done(part, rows):
            columns = block_nodes(*map(list, zip(*rows)), part, *places[part])
            whole = pa.record_batch(columns, names=names)
            for at in range(0, whole.num_rows, _OUT_ROWS):
                yield whole.slice(at, _OUT_ROWS)

        current, rows = None, []
        for batch in batches:
            for part, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if part != current and rows:
                    yield from done(current, rows)
                    rows = []
                current = part
                rows.append(row)
        if rows:
            yield from done(current, rows)

    return build


def _common(a: Column, b: Column) -> Column:
    @F.arrow_udf("int")
    def steps(left: pa.Array, right: pa.Array) -> pa.Array:
        pairs = zip(left.to_pylist(), right.to_pylist())
        return pa.array([None if b is None else common_steps(a, b) for a, b in pairs], pa.int32())

    return steps(a, b)


def prefix_trie(
    members: DataFrame, member: str = "conv_id", steps: str = "turns", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Nodes of the trie of all members' sequences: depth, conv_id, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    ``steps`` is an array of structs (digest, tokens), ``digest`` as ``step_digest`` gives; members'
    ids are distinct. A node is a distinct sequence of first steps, the empty one included; its
    ``conv_id`` is the least id of its members. A null array is an empty sequence; a row without an
    id is no member. Without members there are no nodes. A sequence is one row of 24 bytes a step,
    whatever its texts; other columns are not used, whatever their names.
    """
    spark = members.sparkSession
    digests = F.transform(F.coalesce(steps, F.array()), lambda s: F.hex(s["digest"]))
    tokens = F.transform(F.coalesce(steps, F.array()), lambda s: s["tokens"].cast("bigint"))
    rows = kept(
        members.where(F.col(member).isNotNull()).select(
            F.col(member).cast("bigint").alias("id"),
            F.unhex(F.array_join(digests, "")).alias("key"),
            tokens.alias("weights"),
        ).select("*", F.unhex(F.substring(F.sha2("key", 256), 1, 32)).alias("cls")),
        "members",
    )
    classes = kept(classes_of(rows), "classes")
    size, found = classes.agg(
        F.sum(F.octet_length("key") + 8 * F.size("weights") + 100).cast("bigint"), F.count("*")
    ).first()
    cores = spark.sparkContext.defaultParallelism
    blocks = max(1, -(-(size or 0) // block_bytes), min(cores, -(-found // LEAST_ROWS)))
    dealt = kept(
        classes.repartitionByRange(blocks, "key").withColumn("part", F.spark_partition_id()), "dealt"
    )
    ends = dealt.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    # One row a block.
    following = F.lead("low").over(Window.orderBy("part"))
    figures = (
        ends.select("part", "low", "high", following.alias("next"))
        .select("part", _common(F.col("low"), F.col("high")), _common(F.col("high"), F.col("next")))
        .orderBy("part")
        .collect()
    )
    parts = [f[0] for f in figures]
    runs = begins([f[1] for f in figures], [f[2] for f in figures[:-1]])
    places = {
        part: (left, right, [(d, parts[i]) for d, i in chain])
        for part, (left, right, chain) in zip(parts, runs)
    }
    shared = spark.sparkContext.broadcast(places)
    nodes = kept(
        dealt.repartition(blocks, "part")
        .sortWithinPartitions("part", "key")
        .select("part", "key", "weights", "least", "n", "ends")
        .mapInArrow(_builder(shared), _NODES),
        "nodes",
    )
    opened = kept(
        nodes.where("start is not null")
        .groupBy("depth", "start")
        .agg(
            F.min("conv").alias("conv"),
            F.min("parent_start").alias("parent_start"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
            F.max("ends").alias("ends"),
        ),
        "opened",
    )
    above = opened.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("start").alias("parent_start"),
        F.col("conv").alias("parent_conv"),
    )
    figures = ["n_convs", "n_children", "n_leaves", "saved", "ends"]
    within = nodes.where("start is null")
    whole = within.where("parent_start is null").select("depth", "conv", "parent_conv", *figures)
    below = (
        within.where("parent_start is not null")
        .select("depth", "conv", "parent_start", *figures)
        .union(opened.where("parent_start is not null").select("depth", "conv", "parent_start", *figures))
    )
    below = below.join(above, ["depth", "parent_start"]).select("depth", "conv", "parent_conv", *figures)
    top = opened.where("parent_start is null").select(
        "depth", "conv", F.lit(None).cast("bigint").alias("parent_conv"), *figures
    )
    return whole.union(below).union(top).select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256"),
    )


def turns_of(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as steps of ``prefix_trie``.

    A turn without a number comes first; turns of one number are ordered by the SHA-256 of role and
    text. Null roles and texts are empty. Rows without a conv_id belong to no conversation.
    """
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            step_digest(who, said).alias("digest"),
            F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).alias("tokens"),
        ).alias("step"),
    )
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("step")).alias("steps"))
    return listed.select(
        "conv_id",
        F.transform("steps", lambda s: F.struct(s["digest"].alias("digest"), s["tokens"].alias("tokens"))).alias("turns"),
    )
