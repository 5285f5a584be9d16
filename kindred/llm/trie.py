"""Prefix trie of conversations: sorted sequences, sparse tables over their common prefixes.

A turn is the MD5 of its role and text, so a conversation is a string of 16 bytes per turn. Equal
conversations are folded into one row. The distinct ones are sorted across the cluster and cut into
blocks; a block holds the length of the common prefix of each row with the row before it. A node of
depth d is an interval of rows whose common prefixes are d or longer, and each candidate prefix (the
first row of an interval and a depth) finds its ends by binary search over a sparse table of range
minima, its parent's ends likewise. Everything asked of a node is then a difference of prefix sums or
one range minimum.

Blocks know only how much their first row shares with the row before it. A node that goes beyond a
block gets one partial row from each block it touches, under a digest of its prefix; the partial rows
are summed. Their number is the depth shared at block ends, not the number of rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import text_of
from kindred.session import through_table

TURN = 16  # bytes of a turn's digest
BLOCK = 200_000  # turns per block
CHUNK = 50_000  # ids per piece of an id list
SLICE = 1_000_000  # candidate prefixes worked on at once
NO_ID = np.iinfo(np.int64).max

NODE = (
    "block int, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
NODE_COLUMNS = [part.split()[0] for part in NODE.split(", ")]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _sequences(batches):
    """One row per conversation from turns that are sorted by conversation: digests and sizes."""
    now, digests, sizes, started = None, [], [], False

    def row():
        columns = [pa.array([now], pa.int64())]
        columns += [pa.array([b"".join(x)], pa.binary()) for x in (digests, sizes)]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "seq", "sizes"])

    done = []
    for batch in batches:
        ids = batch.column("conv_id").to_pylist()
        marks = batch.column("digest").to_pylist()
        lengths = np.array(batch.column("size"), np.int64)
        i = 0
        while i < len(ids):
            j = i
            while j < len(ids) and ids[j] == ids[i]:
                j += 1
            if started and ids[i] != now:
                done.append(row())
                digests, sizes = [], []
            now, started = ids[i], True
            digests.append(b"".join(marks[i:j]))
            sizes.append(lengths[i:j].tobytes())
            i = j
        if len(done) >= 1000:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
            done = []
    if started:
        done.append(row())
    if done:
        yield from pa.Table.from_batches(done).combine_chunks().to_batches()


def sequences(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id``, ``seq`` (16 bytes per turn) and ``sizes`` (UTF-8 bytes of each text, 8 bytes each).

    Turns stand in the order of their number, null first; turns of equal number in that of their
    digests. A null role or text is empty, repeated turns are kept. Rows without a conversation id form
    one conversation with a null id. Texts are digested where they are read; 40 bytes per turn are
    shuffled, and the turns of one conversation meet in one task as 24 bytes each, so the longest
    conversation has at most 89 million turns (2 GB).
    """
    role, text = text_of(role_col), text_of(text_col)
    mark = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.unhex(mark).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    return (
        rows.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "digest")
        .select("conv_id", "digest", "size")
        .mapInArrow(_sequences, "conv_id long, seq binary, sizes binary")
    )


def rebuild(convs: DataFrame, group: int = 5, longest: int = 9) -> DataFrame:
    """Conversations that share beginnings, as branching from a first one gives them.

    Conversation c becomes the first h turns of conversation c - c % ``group`` and then its own turns
    after its first h, where h is the crc32 of c in decimals modulo ``longest``. The first part is empty
    where that conversation is absent. A conversation without an id stays as it is.
    """
    convs = through_table(convs, "convs")
    ahead = F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest, F.lit(0)).cast("int")
    heads = convs.select(
        F.col("conv_id").alias("base"),
        F.substring("seq", 1, TURN * (longest - 1)).alias("head"),
        F.substring("sizes", 1, 8 * (longest - 1)).alias("head_sizes"),
    )

    def spliced(head, own, width):
        first = F.substring(F.coalesce(F.col(head), F.lit(b"")), F.lit(1), width * F.col("h"))
        return F.concat(first, F.substring(F.col(own), width * F.col("h") + 1, F.octet_length(own)))

    return (
        convs.withColumn("h", ahead)
        .withColumn("base", F.expr(f"conv_id - conv_id % {int(group)}"))
        .join(heads, "base", "left")
        .select("conv_id", spliced("head", "seq", TURN).alias("seq"), spliced("head_sizes", "sizes", 8).alias("sizes"))
    )


def _id_pieces(batches):
    """Lists of ids, cut into pieces: rows are sorted by class and id."""
    names = ["class", "first", "n", "ids"]
    for batch in batches:
        classes, ids = batch.column("class").to_pylist(), batch.column("conv_id").to_pylist()
        out, i = [], 0
        while i < len(ids):
            j = i + 1
            while j < len(ids) and j - i < CHUNK and classes[j] == classes[i]:
                j += 1
            known = [x for x in ids[i:j] if x is not None]
            out.append((classes[i], known[0] if known else None, j - i, ",".join(map(str, known))))
            i = j
        if out:
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def _id_digests(batches):
    """One row per class; the pieces of a list are hashed as they come, none is kept."""
    names = ["class", "n", "least", "ends"]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
    now = None

    def closed():
        return now, n, least, digest.hexdigest()

    for batch in batches:
        out = []
        for cls, first, count, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if cls != now:
                if now is not None:
                    out.append(closed())
                now, n, least, digest, any_id = cls, 0, None, hashlib.sha256(), False
            n += count
            if ids:
                least = first if least is None else least
                digest.update((("," if any_id else "") + ids).encode())
                any_id = True
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(closed(), kinds)], names)


def distinct_sequences(convs: DataFrame, pieces: int) -> DataFrame:
    """Equal conversations folded: ``seq``, ``sizes``, ``n`` members, ``least`` id, ``ends`` digest.

    Ids of a class are spread over tasks by range and come together as pieces of a list, which one
    task hashes in order, holding none of them.
    """
    named = convs.withColumn("class", F.unhex(F.md5("seq")))
    ids = (
        named.select("class", "conv_id")
        .repartitionByRange(pieces, "class", "conv_id")
        .sortWithinPartitions("class", "conv_id")
        .mapInArrow(_id_pieces, "class binary, first long, n long, ids string")
        .repartition("class")
        .sortWithinPartitions("class", "first")
        .mapInArrow(_id_digests, "class binary, n long, least long, ends string")
    )
    return named.select("class", "seq", "sizes").dropDuplicates(["class"]).join(ids, "class").drop("class")


def shared_turns(a: bytes | None, b: bytes | None) -> int:
    """Length of the common prefix in turns, -1 without a neighbour."""
    if a is None or b is None:
        return -1
    width = min(len(a), len(b)) // TURN
    x = np.frombuffer(a, "u8", 2 * width).reshape(-1, 2)
    y = np.frombuffer(b, "u8", 2 * width).reshape(-1, 2)
    differ = (x != y).any(axis=1)
    return int(np.argmax(differ)) if differ.any() else width


def _shared(batches):
    for batch in batches:
        both = zip(batch.column("before").to_pylist(), batch.column("low").to_pylist())
        shared = pa.array([shared_turns(a, b) for a, b in both], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("block"), shared], ["block", "shared"])


class RangeMinimum:
    """Minima of all ranges whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        width = 1
        while 2 * width <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def right(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The farthest r with values[at + 1 .. r] all >= least."""
        at, last = at.copy(), len(self.levels[0]) - 1
        for k in range(len(self.levels) - 1, -1, -1):
            can = np.flatnonzero(at + (1 << k) <= last)
            can = can[self.levels[k][at[can] + 1] >= least[can]]
            at[can] += 1 << k
        return at

    def left(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The farthest l with values[l + 1 .. at] all >= least."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            can = np.flatnonzero(at >= 1 << k)
            can = can[self.levels[k][at[can] - (1 << k) + 1] >= least[can]]
            at[can] -= 1 << k
        return at

    def least(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Minima of values[i .. j]."""
        level = np.frexp((j - i + 1).astype(float))[1] - 1
        out = np.empty(len(i), self.levels[0].dtype)
        for k in np.unique(level):
            here = level == k
            out[here] = np.minimum(self.levels[k][i[here]], self.levels[k][j[here] - (1 << k) + 1])
        return out


def _prefix_keys(seq: bytes, depth: int) -> np.ndarray:
    """Digests of the prefixes of 0 .. depth turns."""
    digest, keys = hashlib.blake2b(digest_size=16), []
    for d in range(depth + 1):
        if d:
            digest.update(seq[TURN * (d - 1) : TURN * d])
        keys.append(digest.copy().digest())
    out = np.empty(len(keys), object)
    out[:] = keys
    return out


def _summed(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values)])


def block_nodes(seqs, sizes, weights, ids, ends, before: int, after: int):
    """The nodes of a block as batches of columns (all of NODE but the block).

    ``before`` and ``after``: turns that the first row shares with the row before the block, and the
    last one with the row after it; -1 without such a row.
    """
    n = len(seqs)
    lengths = np.array([len(s) // TURN for s in seqs], np.int64)
    starts = _summed(lengths)[:-1]
    marks = np.frombuffer(b"".join(seqs), "u8").reshape(-1, 2)
    # Bytes of the first e turns of row i: bytes_[starts[i] + e] - bytes_[starts[i]].
    bytes_ = _summed(np.frombuffer(b"".join(sizes), np.int64))

    def upto(i, e):
        return bytes_[starts[i] + e] - bytes_[starts[i]]

    shared = np.empty(n, np.int64)
    shared[0] = before
    width = np.minimum(lengths[:-1], lengths[1:])
    pair = np.repeat(np.arange(n - 1), width)
    offset = np.arange(len(pair)) - np.repeat(_summed(width)[:-1], width)
    differ = np.flatnonzero((marks[starts[pair] + offset] != marks[starts[pair + 1] + offset]).any(axis=1))
    shared[1:] = width
    first = differ[np.unique(pair[differ], return_index=True)[1]]
    shared[1 + pair[first]] = offset[first]

    rows = np.arange(n)
    table, least_id = RangeMinimum(shared), RangeMinimum(ids)
    whole = upto(rows, lengths)
    members = _summed(weights)
    heavy = _summed(weights * whole)
    fresh = _summed(whole - upto(rows, np.maximum(shared, 0)))
    leaves = _summed(lengths > np.append(shared[1:], after))
    by_shared = np.sort((shared + 1) * (n + 1) + rows)

    def branches(d, i, j):
        """Rows of i .. j that leave their predecessor at depth d."""
        base = (d + 1) * (n + 1)
        return np.searchsorted(by_shared, base + j, "right") - np.searchsorted(by_shared, base + i)

    keys_in, keys_out = _prefix_keys(seqs[0], before), _prefix_keys(seqs[-1], after)
    ends_ = np.array(ends, object)
    # The first row stands for every node that comes from the block before, too.
    lowest = shared + 1
    lowest[0] = 0
    counts = np.maximum(lengths - lowest + 1, 0)
    cuts = _summed(counts)
    for low in range(0, int(cuts[-1]), SLICE):
        at = np.arange(low, min(low + SLICE, int(cuts[-1])))
        i = np.searchsorted(cuts, at, "right") - 1
        d = lowest[i] + at - cuts[i]
        right = table.right(i, d)
        starts_here = d > shared[i]
        leaves_block = (right == n - 1) & (d <= after)
        crossing = ~starts_here | leaves_block
        count = members[right + 1] - members[i]
        below = np.maximum(d - 1, 0)
        new = np.where(
            starts_here, fresh[right + 1] - fresh[i + 1] + whole[i] - upto(i, below), fresh[right + 1] - fresh[i]
        )
        saved = heavy[right + 1] - heavy[i] - count * upto(i, below) - new
        children = np.where(
            starts_here, branches(d, i + 1, right) + (lengths[i] > d), branches(d, i, right)
        )
        key = np.full(len(i), None, object)
        key[crossing & ~starts_here] = keys_in[d[crossing & ~starts_here]]
        key[crossing & starts_here] = keys_out[d[crossing & starts_here]]
        # Parents: the interval one turn higher, searched on both sides.
        inner = d > 0
        up = np.maximum(d - 1, 0)
        left, far = table.left(i, up), table.right(i, up)
        from_before = inner & (left == 0) & (before >= up)
        beyond = inner & ~from_before & (far == n - 1) & (after >= up)
        parent_key = np.full(len(i), None, object)
        parent_key[from_before] = keys_in[up[from_before]]
        parent_key[beyond] = keys_out[up[beyond]]
        parent = least_id.least(left, far)
        local = inner & ~from_before & ~beyond
        end = np.where(starts_here & (lengths[i] == d), ends_[i], None)
        end[~crossing & np.array([e is None for e in end])] = EMPTY_SHA
        own = least_id.least(i, right)
        yield [
            pa.array(key, pa.binary()),
            pa.array(parent_key, pa.binary()),
            pa.array(d),
            pa.array(own, mask=own == NO_ID),
            pa.array(parent, mask=~local | (parent == NO_ID)),
            pa.array(count),
            pa.array(children),
            pa.array(leaves[right + 1] - leaves[i]),
            pa.array(saved),
            pa.array(end, pa.string()),
        ]


def _nodes(shared: dict[int, int]):
    """``shared``: turns that each block's first row shares with the row before it."""
    blocks = sorted(shared)
    after = {b: shared[c] for b, c in zip(blocks, blocks[1:])}

    def run(batches):
        now, parts = None, []

        def closed():
            rows = pa.Table.from_batches(parts)
            seqs, sizes, ends = (rows.column(c).to_pylist() for c in ("seq", "sizes", "ends"))
            ids = rows.column("least").fill_null(int(NO_ID)).to_numpy()
            weights = rows.column("n").to_numpy()
            for columns in block_nodes(seqs, sizes, weights, ids, ends, shared[now], after.get(now, -1)):
                block = pa.array(np.full(len(columns[0]), now, np.int32))
                yield pa.RecordBatch.from_arrays([block, *columns], NODE_COLUMNS)

        for batch in batches:
            of = np.array(batch.column("block"))
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(of)]])
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if parts and of[i] != now:
                    yield from closed()
                    parts = []
                now = int(of[i])
                parts.append(batch.slice(i, j - i))
        if parts:
            yield from closed()

    return run


def trie(convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every distinct beginning of the conversations, one row each.

    ``convs``: ``conv_id``, ``seq`` and ``sizes`` as :func:`sequences` gives them. Returns ``conv_id``
    (smallest member), ``depth`` (turns), ``parent_conv_id`` (null for the root), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` (bytes that need no second pass when members share
    the node and those below it) and ``ends_sha256`` (digest of the ids that end there, in order).

    Conversations without turns are members of the root. A member without an id counts, but gives
    no smallest id and no part of a digest. No conversation gives no row. ``block`` is the number of
    turns a task holds at once.
    """
    convs = through_table(convs, "sequences")
    turns, rows = convs.agg(F.sum(F.octet_length("seq")), F.count(F.lit(1))).first()
    blocks = 1 + max((turns or 0) // TURN, rows) // block
    folded = through_table(distinct_sequences(convs, blocks), "distinct")
    held = through_table(
        folded.repartitionByRange(blocks, "seq").withColumn("block", F.spark_partition_id()), "blocks"
    )
    edges = held.groupBy("block").agg(F.min("seq").alias("low"), F.max("seq").alias("high"))
    edges = edges.withColumn("before", F.lag("high").over(Window.orderBy("block")))
    # Two numbers per block come to the driver.
    shared = dict(
        (r.block, r.shared)
        for r in edges.select("block", "before", "low").mapInArrow(_shared, "block int, shared long").collect()
    )
    nodes = through_table(
        held.repartition(blocks, "block").sortWithinPartitions("block", "seq").mapInArrow(_nodes(shared), NODE),
        "nodes",
    )
    wide = nodes.where("key IS NOT NULL")
    totals = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    merged = through_table(
        wide.groupBy("key").agg(
            F.max("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"),
            F.max("parent_key").alias("parent_key"),
            *(F.sum(c).alias(c) for c in totals),
            F.coalesce(F.max("ends_sha256"), F.lit(EMPTY_SHA)).alias("ends_sha256"),
        ),
        "wide",
    )
    # A node inside a block finds a parent that goes beyond it by block and key, so that no key is hot.
    names = merged.select(F.col("key").alias("up"), F.col("conv_id").alias("up_conv"))
    here = wide.select("block", "key").distinct().join(names, F.col("key") == F.col("up")).drop("key")
    out = ("conv_id", "depth", "parent_conv_id", *totals, "ends_sha256")
    narrow = nodes.where("key IS NULL")
    whole = (
        narrow.join(here.withColumnRenamed("block", "at"), (narrow.block == F.col("at")) & (narrow.parent_key == F.col("up")), "left")
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up_conv"))
        .select(*out)
    )
    across = (
        merged.join(names, F.col("parent_key") == F.col("up"), "left")
        .withColumn("parent_conv_id", F.col("up_conv"))
        .select(*out)
    )
    return whole.unionByName(across)
