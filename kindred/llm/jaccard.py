"""N-gram Jaccard join by T-occurrence search with DivideSkip.

Two sets of n and m shingles with 100 * intersection >= 75 * union share at least
ceil(3 (n + m) / 7) shingles. A set's inverted lists are ordered by length, shortest first. All but
its T - 1 longest lists are its short lists, T = ceil(3 n / 4) being the least overlap with any
partner: a partner must stand in one of them. The long ones are never joined, only probed.

1. Every distinct shingle set is a class; copies take no further part.
2. List lengths: tasks send the distinct shingles of a chunk of documents with their counts, by
   range of the hash, and then the document of each occurrence. A shingle that is in very many
   documents comes once per chunk. Documents get back only shingles with two or more documents;
   most documents thereby see that their short lists hold nobody else, and drop out.
3. Pairs are looked for inside the short lists. Lists longer than a block are cut by hash, and all
   pairs of parts are blocks too. First each member is held against the leader of its block, the
   one that stands first in it; then members of different components are held against each other,
   so that a group of near copies is never expanded into all pairs. A pair is dropped if the sizes
   or the positions in the two sets rule the overlap out.
4. Remaining pairs are verified on whole sets: the short lists of a query are heap-merged, the
   long ones probed by binary search.

A shingle is a 64-bit hash of five word hashes. Chunks, blocks and hash ranges are bounded; the
number of ranges grows with the corpus.
"""

from __future__ import annotations

import hashlib
import heapq
from bisect import bisect_left
from collections import defaultdict
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import text_of
from kindred.llm.graph import components
from kindred.session import through_table

WIDTH = 5
BLOCK = 1024  # members of a part of a long list
CHUNK = 400_000  # shingles that a task counts at once
RANGE = 4_000_000  # shingles per hash range
SEEN = 500_000  # sets that a task remembers to skip copies
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)


class WordHashes(dict):
    """Remembers the hashes of words."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxh3_64_intdigest(word)
        return value


def shingle_set(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingles; fewer than five words are one shingle, none give none."""
    words = text.lower().split()  # of bytes: A-Z and the six blanks only
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h
    if len(h) < WIDTH:
        out = np.array([0x632BE59BD9B4E019 * len(h) % 2**64], np.uint64)
        for i, x in enumerate(h):
            out = (out ^ x) * np.uint64(FACTORS[i])
    else:
        out = np.zeros(len(h) - WIDTH + 1, np.uint64)
        for i, factor in enumerate(FACTORS):
            out += h[i : len(h) - WIDTH + 1 + i] * np.uint64(factor)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sets(batches):
    """Per document: its shingle count and a digest of its set."""
    hashes = WordHashes()
    for batch in batches:
        sets = [shingle_set(t, hashes) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("place"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_digest(s) for s in sets], pa.binary()),
            ],
            ["doc_id", "place", "n", "digest"],
        )


COUNTED = "range int, step byte, chunk long, a binary, b binary"


def _counted(columns):
    kinds = [pa.int32(), pa.int8(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["range", "step", "chunk", "a", "b"]
    )


def _occurrences(ranges: int):
    """Chunks of documents as (range, distinct shingles, counts), then the documents."""

    def flush(chunk, sets, digests):
        lengths = np.array([len(s) for s in sets])
        tokens = np.concatenate(sets)
        where = (tokens & np.uint64(0xFFFFFFFF)) % np.uint64(ranges)
        key = (where << np.uint64(32)) | (tokens >> np.uint64(32))
        order = np.argsort(key, kind="stable")
        key = key[order]
        docs = np.repeat(np.arange(len(sets), dtype=np.uint16), lengths)[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        counts = np.diff(np.append(first, len(key))).astype(np.uint16)
        distinct = key[first]
        edges = np.arange(ranges + 1, dtype=np.uint64) << np.uint64(32)
        cut, cut_all = np.searchsorted(distinct, edges[:-1]), np.searchsorted(key, edges[:-1])
        cut, cut_all = np.append(cut, len(distinct)), np.append(cut_all, len(key))
        low = distinct.astype(np.uint32)
        rows = [(chunk % ranges, 2, chunk, lengths.astype(np.uint32).tobytes(), b"".join(digests))]
        for r in range(ranges):
            i, j = cut[r], cut[r + 1]
            if i < j:
                rows.append((r, 0, chunk, low[i:j].tobytes(), counts[i:j].tobytes()))
                rows.append((r, 1, chunk, docs[cut_all[r] : cut_all[r + 1]].tobytes(), None))
        return _counted(list(zip(*rows)))

    def run(batches):
        hashes, seen = WordHashes(), set()
        chunk = TaskContext.get().partitionId() << 32
        sets, digests, size = [], [], 0
        for batch in batches:
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), hashes)
                d = _digest(s)
                if not len(s) or d in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(d)
                sets.append(s)
                digests.append(d)
                size += len(s)
                if size >= CHUNK or len(sets) == 60_000:
                    yield flush(chunk, sets, digests)
                    chunk += 1
                    sets, digests, size = [], [], 0
        if sets:
            yield flush(chunk, sets, digests)

    return run


SHARED = "chunk long, range int, docs binary, tokens binary, df binary"


def _shared(rows):
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
        ["chunk", "range", "docs", "tokens", "df"],
    )


def _lengths(batches):
    """Sums the counts of a range, then keeps occurrences of shingles with two or more documents."""
    now, chunks, summed = None, {}, False
    for batch in batches:
        out = []
        for r, step, chunk, a, b in zip(*(batch.column(i) for i in range(5))):
            r, step, chunk, a = r.as_py(), step.as_py(), chunk.as_py(), a.as_py()
            if r != now:
                now, chunks, summed = r, {}, False
            if step == 0:
                chunks[chunk] = [np.frombuffer(a, np.uint32), np.frombuffer(b.as_py(), np.uint16)]
            elif step == 1:
                if not summed:
                    tokens = np.concatenate([x[0] for x in chunks.values()])
                    _, inverse = np.unique(tokens, return_inverse=True)
                    counts = np.concatenate([x[1] for x in chunks.values()])
                    df = np.bincount(inverse, counts).astype(np.uint32)[inverse]
                    at = 0
                    for x in chunks.values():
                        x.append(df[at : at + len(x[0])])
                        at += len(x[0])
                    summed = True
                tokens, counts, df = chunks.pop(chunk)
                several = np.repeat(df, counts) > 1
                if several.any():
                    out.append(
                        (
                            chunk,
                            r,
                            np.frombuffer(a, np.uint16)[several].tobytes(),
                            np.repeat(tokens, counts)[several].tobytes(),
                            np.repeat(df, counts)[several].tobytes(),
                        )
                    )
            else:
                out.append((chunk, -1, None, a, b.as_py()))
        if out:
            yield _shared(out)


POSTING = "token long, digest binary, n int, pos int"


def _short_lists(batches):
    """Per document of a chunk: its short lists with two or more documents, and its positions."""

    def flush(rows):
        lengths = np.frombuffer(rows[0][2], np.uint32).astype(np.int64)
        digests = rows[0][3]
        if len(rows) == 1:
            return None
        docs = np.concatenate([np.frombuffer(x[1], np.uint16) for x in rows[1:]])
        tokens = np.concatenate(
            [np.frombuffer(x[2], np.uint32).astype(np.int64) | (x[0] << 32) for x in rows[1:]]
        )
        df = np.concatenate([np.frombuffer(x[3], np.uint32) for x in rows[1:]])
        order = np.lexsort((tokens, df, docs))
        docs, tokens = docs[order].astype(np.int64), tokens[order]
        shared = np.bincount(docs, minlength=len(lengths))
        own = lengths - shared  # lists with nobody else come first
        rank = np.arange(len(docs)) - np.repeat(np.cumsum(shared) - shared, shared)
        short = lengths - (3 * lengths + 3) // 4 + 1
        kept = np.flatnonzero(rank < (short - own)[docs])
        if not len(kept):
            return None
        docs = docs[kept]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(tokens[kept]),
                pa.array([digests[16 * d : 16 * d + 16] for d in docs.tolist()], pa.binary()),
                pa.array(lengths[docs].astype(np.int32)),
                pa.array((own[docs] + rank[kept]).astype(np.int32)),
            ],
            ["token", "digest", "n", "pos"],
        )

    now, rows = None, []
    for batch in batches:
        for chunk, *row in zip(*(batch.column(i) for i in range(5))):
            chunk = chunk.as_py()
            if chunk != now:
                if rows and (out := flush(rows)):
                    yield out
                now, rows = chunk, []
            rows.append([x.as_py() for x in row])
    if rows and (out := flush(rows)):
        yield out


def divide_skip(lists: list[list[int]], need: dict[int, int]):
    """Ids of ``need`` that occur at least as often as needed in sorted lists.

    The T - 1 longest lists, T being the least need, are not merged: what is found in the others is
    looked up in them by binary search.
    """
    lists = sorted(lists, key=len)
    n_long = max(0, min(min(need.values()) - 1, len(lists)))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    for id_, run in groupby(heapq.merge(*short)):
        wanted = need.get(id_)
        if wanted is None:
            continue
        count, left = sum(1 for _ in run), n_long
        for probed in long:
            if count >= wanted or count + left < wanted:
                break
            at = bisect_left(probed, id_)
            count += at < len(probed) and probed[at] == id_
            left -= 1
        if count >= wanted:
            yield id_


def verified(sets: dict[int, np.ndarray], pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The pairs of a block that are similar."""
    queries = defaultdict(list)
    for a, b in pairs:
        queries[a].append(b)
    out = []
    for a, others in queries.items():
        mine = sets[a]
        ids = np.repeat(np.arange(len(others)), [len(sets[b]) for b in others])
        tokens = np.concatenate([sets[b] for b in others])
        found = np.minimum(np.searchsorted(mine, tokens), len(mine) - 1)
        hit = mine[found] == tokens
        order = np.lexsort((ids[hit], found[hit]))
        at, ids = found[hit][order], ids[hit][order].tolist()
        cuts = np.append(np.flatnonzero(np.diff(at, prepend=-1)), len(at)).tolist()
        lists = [ids[i:j] for i, j in zip(cuts, cuts[1:])]
        need = {i: -(-3 * (len(mine) + len(sets[b])) // 7) for i, b in enumerate(others)}
        out += [(a, others[i]) for i in divide_skip(lists, need)]
    return out


def _verify(batches):
    """Blocks of sets, then pairs: the pairs that are similar."""
    now, sets, pairs = None, {}, []

    def flush():
        found = verified(sets, pairs)
        return pa.RecordBatch.from_arrays(
            [pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], ["a", "b"]
        )

    for batch in batches:
        for block, a, b, shingles in zip(*(batch.column(i) for i in range(4))):
            block, a, b = block.as_py(), a.as_py(), b.as_py()
            if block != now:
                if pairs:
                    yield flush()
                now, sets, pairs = block, {}, []
            if b is None:
                sets[a] = np.frombuffer(shingles.as_py(), np.uint64)
            else:
                pairs.append((a, b))
    if pairs:
        yield flush()


def _tokens(batches):
    """The set of each class; a text that only shares its place with the class is passed over."""
    hashes, seen = WordHashes(), set()
    for batch in batches:
        found = []
        for cls, digest, text in zip(*(batch.column(i) for i in range(3))):
            cls = cls.as_py()
            if cls in seen:
                continue
            s = shingle_set(text.as_py(), hashes)
            if _digest(s) == digest.as_py():
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(cls)
                found.append((cls, s.tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[i] for f in found], k) for i, k in enumerate((pa.int64(), pa.binary()))],
            ["cls", "shingles"],
        )


def _possible(left: str, right: str):
    """Sizes and positions of the first common list leave room for the overlap."""
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    room = F.least(n - F.col(f"{left}.pos"), m - F.col(f"{right}.pos"))
    return (7 * room >= 3 * (n + m)) & (4 * F.least(n, m) >= 3 * F.greatest(n, m))


def _similar(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """Verified pairs of a table (block, a, b)."""
    pairs = through_table(pairs.groupBy("a", "b").agg(F.min("block").alias("block")), "pairs")
    members = (
        pairs.select("block", F.col("a").alias("cls"))
        .unionByName(pairs.select("block", F.col("b").alias("cls")))
        .distinct()
    )
    sets = members.join(tokens, "cls").select(
        "block", F.col("cls").alias("a"), F.lit(None).cast("long").alias("b"), "shingles"
    )
    rows = sets.unionByName(
        pairs.select("block", "a", "b", F.lit(None).cast("binary").alias("shingles"))
    )
    return rows.repartition("block").sortWithinPartitions(
        "block", F.col("b").asc_nulls_first()
    ).mapInArrow(_verify, "a long, b long")


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``.

    Words are runs without blanks, A-Z lower-cased; a document's set is that of its distinct
    five-word shingles, with fewer words the whole sequence, without words empty. Two documents are
    linked when 100 * intersection >= 75 * union. ``component_id`` is the smallest id reachable by
    links. Documents without words are linked with nothing, not even with each other: their
    component is their own id. Null ids are ignored by the minimum, so a component of null ids alone
    has a null id. Other columns are not looked at.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).cast("binary").alias("text"))
    # Ids may be null or stand at different texts, so a text is found again by a hash of both.
    texts = texts.withColumn("place", F.xxhash64("doc_id", "text"))
    sized = through_table(
        texts.mapInArrow(_sets, f"doc_id {kind}, place long, n long, digest binary"), "sized"
    )
    full = sized.where("n > 0")
    classes = through_table(
        full.groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.min("place").alias("place"))
        .withColumn("cls", F.monotonically_increasing_id()),
        "classes",
    )
    total = full.agg(F.sum("n")).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // RANGE)
    postings = (
        texts.select("text")
        .mapInArrow(_occurrences(ranges), COUNTED)
        .repartition(ranges, "range")
        .sortWithinPartitions("range", "step")
        .mapInArrow(_lengths, SHARED)
        .repartition(ranges, "chunk")
        .sortWithinPartitions("chunk", "range")
        .mapInArrow(_short_lists, POSTING)
    )
    postings = through_table(postings, "postings")
    members = postings.join(classes.select("digest", "cls"), "digest").groupBy("token", "cls").agg(
        F.min("n").alias("n"), F.min("pos").alias("pos")
    )
    members = through_table(members, "members")
    lists = members.groupBy("token").count().where("count > 1")
    parts = F.ceil(F.col("count") / BLOCK).cast("int")
    placed = members.join(lists, "token").withColumns(
        {"parts": parts, "part": F.pmod(F.xxhash64("cls"), parts).cast("int")}
    )
    entries = through_table(
        placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
            F.xxhash64("token", F.least("part", "other"), F.greatest("part", "other")).alias("block"),
            "token",
            (F.col("part") == F.col("other")).alias("inner"),
            "part",
            "cls",
            "n",
            "pos",
        ),
        "entries",
    )
    wanted = entries.select("cls").distinct().join(classes, "cls")
    tokens = through_table(
        texts.join(wanted.select("cls", "digest", "place"), "place")
        .select("cls", "digest", "text")
        .mapInArrow(_tokens, "cls long, shingles binary")
        .dropDuplicates(["cls"]),
        "tokens",
    )
    leader = F.min(F.struct("pos", "cls", "n")).alias("lead")
    inner = entries.where("inner")
    star = (
        inner.alias("x")
        .join(inner.groupBy("block").agg(leader), "block")
        .where((F.col("cls") != F.col("lead.cls")) & _possible("x", "lead"))
        .select(
            "block",
            F.least("lead.cls", "cls").alias("a"),
            F.greatest("lead.cls", "cls").alias("b"),
        )
    )
    found = through_table(_similar(star, tokens), "similar")
    named = entries.join(
        components(found).withColumnRenamed("node", "cls"), "cls", "left"
    ).withColumn("root", F.coalesce("root", "cls"))
    named = through_table(named, "named")
    x, y = named.alias("x"), named.alias("y")
    cross = x.join(
        y,
        (F.col("x.block") == F.col("y.block"))
        & (F.col("x.token") == F.col("y.token"))
        & (F.col("x.inner") | (F.col("x.part") != F.col("y.part")))
        & (F.col("x.cls") < F.col("y.cls"))
        & (F.col("x.root") != F.col("y.root"))
        & _possible("x", "y"),
    ).select(F.col("x.block").alias("block"), F.col("x.cls").alias("a"), F.col("y.cls").alias("b"))
    found = found.unionByName(through_table(_similar(cross, tokens), "similar"))
    rooted = classes.join(
        components(found).withColumnRenamed("node", "cls"), "cls", "left"
    ).withColumn("root", F.coalesce("root", "cls"))
    rooted = through_table(rooted.select("digest", "root", "first_id"), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(smallest, "root").select("digest", "component_id")
    return (
        full.join(named, "digest")
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
        .unionByName(
            sized.where("n = 0").select(
                "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")
            )
        )
    )
