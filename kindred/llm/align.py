"""Alignment of two tokenizers over the same texts, and how often their ids meet.

Both token sequences of a text cover the same bytes. Their end offsets are compared at the current
index shift: as long as they agree, slices of doubling length are compared and a stretch of
one-to-one groups is jumped over; where they differ, the smaller end moves on until both meet, and
the shift is updated. Every step inside such a group is one overlapping pair, a link.

Links are counted in two passes. Chunks of texts hand on their distinct pairs and, for each
document, the places of its links in that list (differences of sorted places, about a byte each). The
pairs are summed over the corpus by Spark, each chunk gets the totals of its own pairs back by a join,
and documents add them up. No task holds more than a chunk of texts and its pairs.
"""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import text_of
from kindred.session import through_table

FOLDER = "/opt/tokenizers"
CHUNK = 8_000_000  # bytes of text

# How byte-level vocabularies split texts, and the ranges of bytes they write as the
# character of the same number; all other bytes follow from U+0100 on.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTED = ((33, 126), (161, 172), (174, 255))

# Characters whose class is the same in every version of Unicode.
_SETTLED = re.compile("[^\x00-ɏ‐-‧]")


def byte_letters() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary."""
    own = [b for low, high in PRINTED for b in range(low, high + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBpe:
    """Byte-level BPE of a tokenizers file.

    Merges are ranked by id in such files, so common texts are encoded by tiktoken, which is faster;
    texts with characters whose class depends on the version of Unicode go to the library of the file.
    """

    def __init__(self, content: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        model = json.loads(content)
        special = {t["id"] for t in model["added_tokens"]}
        letters = byte_letters()
        vocabulary = {t: i for t, i in model["model"]["vocab"].items() if i not in special}
        self.size = 1 + max(chain(vocabulary.values(), special))
        self.bytes = [b""] * self.size
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        self.exact = Tokenizer.from_str(content)
        self.exact.encode_special_tokens = True
        ranks = {b: i for i, b in enumerate(self.bytes) if b}
        merged = [m if isinstance(m, str) else "".join(m) for m in model["model"]["merges"]]
        order = [vocabulary[m.replace(" ", "")] for m in merged]
        if order != sorted(order) or len(ranks) != len(vocabulary) or len(vocabulary) != 256 + len(order):
            raise ValueError("merges do not stand in the order of ids")
        before = model["pre_tokenizer"]
        if model["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"]:
            raise ValueError("the vocabulary does not take texts as they are")
        self.fast = tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if _SETTLED.search(text):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.int64)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)


class PieceBpe:
    """Sentencepiece model with byte fallback; encoding puts a space before the text."""

    def __init__(self, content: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=content)
        self.size = self.model.vocab_size()
        pieces = [self.model.id_to_piece(i) for i in range(self.size)]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]

    def encode(self, text: str) -> np.ndarray:
        ids = self.model.encode(text)
        return np.fromiter(ids, np.int64, len(ids))


def meet(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Indices of both tokens of every link, in order.

    ``a``, ``b``: rising ends of the tokens of the same bytes, the last ones equal. A link whose ends
    are equal closes a group.
    """
    i = j = 0
    n = len(a)
    left, right = [], []
    add_left, add_right = left.append, right.append
    while i < n:
        x, y = a[i], b[j]
        if x == y:
            # Jump over the stretch in which all ends agree at this shift.
            shift, start, step = j - i, i, 1
            i += 1
            while i < n and a[i : i + step] == b[i + shift : i + shift + step]:
                i += step
                step *= 2
            while step > 1:
                step //= 2
                if i < n and a[i : i + step] == b[i + shift : i + shift + step]:
                    i += step
            if i == start + 1:
                add_left(start)
                add_right(j)
                j += 1
                continue
            if i > n:
                i = n
            j = i + shift
            left.extend(range(start, i))
            right.extend(range(start + shift, j))
        else:
            while x != y:
                add_left(i)
                add_right(j)
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            add_left(i)
            add_right(j)
            i += 1
            j += 1
    return left, right


def packed(values: np.ndarray) -> bytes:
    """Seven bits a byte, lowest first; the high bit says that more follow."""
    width, shift = np.ones(len(values), np.int64), 7
    while (rest := values >> shift).any():
        width += rest > 0
        shift += 7
    starts = np.cumsum(width) - width
    out = np.empty(int(width.sum()), np.uint8)
    for k in range(int(width.max(initial=0))):
        has = width > k
        more = (width[has] > k + 1).astype(np.uint8) << 7
        out[starts[has] + k] = ((values[has] >> (7 * k)) & 127).astype(np.uint8) | more
    return out.tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    data = np.frombuffer(blob, np.uint8)
    if not len(data):
        return np.empty(0, np.int64)
    last = data < 128
    starts = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts)


@dataclass(frozen=True)
class Pair:
    """Contents of the two tokenizer files; they travel with the tasks (about 2 MB)."""

    first: str
    second: bytes


def tokenizers(first: str = f"{FOLDER}/byte_bpe_50k.json", second: str = f"{FOLDER}/piece_bpe_32k.model") -> Pair:
    with open(first, encoding="utf-8") as f, open(second, "rb") as g:
        return Pair(f.read(), g.read())


class _Aligner:
    def __init__(self, pair: Pair):
        self.a, self.b = ByteBpe(pair.first), PieceBpe(pair.second)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b))
        # Ids followed by what separates them: in a group, after its first half, after a group.
        self.written = np.array([f"{i}{mark}" for mark in ",|;" for i in range(max(self.a.size, self.b.size))], "S")

    def align(self, text: str):
        """Codes of the links, tokens and groups; None where the tokens do not give the text."""
        whole = b" " + text.encode()
        a, b = self.a.encode(" " + text), self.b.encode(text)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        # The first side takes the bytes as they are, so that only a length could differ.
        if a_ends[-1] != len(whole) or b"".join(map(self.b.bytes.__getitem__, b.tolist())) != whole:
            return None
        left, right = (np.fromiter(x, np.int64, len(x)) for x in meet(a_ends.tolist(), b_ends.tolist()))
        closes = a_ends[left] == b_ends[right]
        a_ends, b_ends = left[closes] + 1, right[closes] + 1
        groups = self.groups(a, b, a_ends, b_ends)
        return a[left] * self.b.size + b[right], (len(a), len(b), len(a_ends), len(left)), groups

    def groups(self, a, b, a_ends, b_ends) -> str:
        size = len(self.written) // 3
        a_counts, b_counts = np.diff(a_ends, prepend=0), np.diff(b_ends, prepend=0)
        a_marks, b_marks = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_marks[a_ends - 1], b_marks[b_ends - 1] = 1, 2
        out = np.empty(len(a) + len(b), np.int64)
        # A token stands behind its own kind and the other kind's earlier groups (b: and this one).
        out[np.arange(len(a)) + np.repeat(b_ends - b_counts, a_counts)] = a + size * a_marks
        out[np.arange(len(b)) + np.repeat(a_ends, b_counts)] = b + size * b_marks
        # Shorter ids are filled up with zero bytes.
        return self.written[out].tobytes().translate(None, b"\0")[:-1].decode()


ALIGNED = (
    "chunk string, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "links binary, pairs binary, pair_counts binary"
)


def align(
    docs: DataFrame, pair: Pair | None = None, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """Aligned tokens of every row, and one more row for each chunk of texts with its pairs.

    Rows of documents: ``chunk``, ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups``
    (ids as ``a1,a2|b1;a3|b2,b3``) and ``links``; the row of a chunk has only ``pairs`` and
    ``pair_counts``. Texts that are null or empty, or that the tokens of one side do not give back, have no
    tokens and an empty ``groups``. Repeated rows and ids are kept apart, other columns are not looked at.
    A task holds about 100 bytes for each byte of the longest text.
    """
    pair = pair or tokenizers()
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    names = [c.split()[0] for c in ALIGNED.split(", ")]

    def run(batches):
        from pyspark import TaskContext

        aligner = _Aligner(pair)
        kinds = [pa.string(), None, *[pa.int64()] * 4, pa.string(), *[pa.binary()] * 3]
        task, chunks = TaskContext.get().partitionId(), 0
        ids, found, size = [], [], 0

        def closed():
            codes = [f[0] for f in found]
            of = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
            # Sorted by code, then by document again: two sorts of whole numbers.
            both = np.sort(np.concatenate(codes) * len(codes) + of)
            all_pairs = both // len(codes)
            first = np.flatnonzero(np.diff(all_pairs, prepend=-1))
            pairs, counts = all_pairs[first], np.diff(np.append(first, len(both)))
            place = np.repeat(np.arange(len(pairs)), counts)
            place = np.sort((both - all_pairs * len(codes)) * (len(pairs) + 1) + place) - of * (len(pairs) + 1)
            cuts = np.cumsum([0, *(len(c) for c in codes)])
            name = f"{task}-{chunks}"
            low = 0
            while low < len(found):
                # Groups are long: hand rows on by the megabyte.
                high, held = low, 0
                while high < len(found) and held < 1 << 22:
                    held += len(found[high][2])
                    high += 1
                part = found[low:high]
                links = [packed(np.diff(place[cuts[k] : cuts[k + 1]], prepend=0)) for k in range(low, high)]
                columns = [[name] * len(part), None, *zip(*(f[1] for f in part)), [f[2] for f in part], links]
                columns += [[None] * len(part)] * 2
                arrays = [pa.array(c, k) if c is not None else None for c, k in zip(columns, kinds)]
                arrays[1] = pa.concat_arrays(ids[low:high])
                yield pa.RecordBatch.from_arrays(arrays, names)
                low = high
            last = [[name], None, *[[None]] * 6, [pairs.tobytes()], [counts.tobytes()]]
            arrays = [pa.array(c, k) if c is not None else None for c, k in zip(last, kinds)]
            arrays[1] = pa.nulls(1, ids[0].type)
            yield pa.RecordBatch.from_arrays(arrays, names)

        nothing = (np.empty(0, np.int64), (0, 0, 0, 0), "")
        for batch in batches:
            column = batch.column("doc_id")
            for i, text in enumerate(batch.column("text")):
                text = text.as_py()
                ids.append(column.slice(i, 1))
                found.append((aligner.align(text) if text else None) or nothing)
                size += 100 + len(text)
                if size >= chunk:
                    yield from closed()
                    chunks, ids, found, size = chunks + 1, [], [], 0
        if found:
            yield from closed()

    return rows.mapInArrow(run, ALIGNED.format(id=kind))


def _pair_rows(batches):
    for batch in batches:
        for name, pairs, counts in zip(*(batch.column(c).to_pylist() for c in ("chunk", "pairs", "pair_counts"))):
            pairs, counts = np.frombuffer(pairs, np.int64), np.frombuffer(counts, np.int64)
            for low in range(0, len(pairs), 50_000):
                part = slice(low, low + 50_000)
                n = len(pairs[part])
                columns = [pa.array([name] * n), pa.array(np.arange(low, low + n)), pa.array(pairs[part])]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(counts[part])], ["chunk", "place", "pair", "n"]
                )


def link_counts(aligned: DataFrame, second_size: int) -> DataFrame:
    """Adds ``n_best`` and ``count_sum`` to the rows of documents; ``aligned`` must be a stored table.

    The count of a pair is the number of links that hold it in all texts. ``count_sum`` adds the counts
    of a document's links; ``n_best`` is the number of links whose count is the highest of all pairs
    with the same second id. ``second_size``: ids of the second tokenizer.

    A pair occurs once per chunk on the one side of the join and once on the other. All pairs of a second
    id are at most as many as the first vocabulary has ids.
    """
    pairs = (
        aligned.where("pairs IS NOT NULL")
        .select("chunk", "pairs", "pair_counts")
        .mapInArrow(_pair_rows, "chunk string, place long, pair long, n long")
    )
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    second = F.pmod("pair", F.lit(second_size))
    totals = through_table(
        totals.withColumn("best", F.max("total").over(Window.partitionBy(second)) == F.col("total")), "totals"
    )
    known = pairs.join(totals, "pair").select("chunk", "place", "total", "best")
    kept = [c for c in aligned.columns if c not in ("chunk", "pairs", "pair_counts", "links")]
    kinds = dict(aligned.dtypes)
    empty = [F.lit(None).cast(kinds[c]).alias(c) for c in kept]
    # The pairs of a chunk come before its documents.
    both = known.select("chunk", "place", "total", "best", *empty, F.lit(None).cast("binary").alias("links")).unionByName(
        aligned.where("pairs IS NULL").select(
            "chunk",
            F.lit(None).cast("long").alias("place"),
            F.lit(None).cast("long").alias("total"),
            F.lit(None).cast("boolean").alias("best"),
            *kept,
            "links",
        )
    )

    def run(batches):
        now, table, parts = None, None, []
        for batch in batches:
            names = batch.column("chunk").to_numpy(zero_copy_only=False)
            known = np.array(batch.column("place").is_valid())
            new = (names[1:] != names[:-1]) | (known[1:] != known[:-1])
            cuts = np.concatenate([[0], np.flatnonzero(new) + 1, [len(names)]])
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if names[i] != now:
                    now, table, parts = names[i], None, []
                part = batch.slice(i, j - i)
                if known[i]:
                    parts.append((np.array(part.column("total")), np.array(part.column("best"))))
                    continue
                if table is None:
                    table = [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0, np.int64)] * 2
                    parts = []
                places = [np.cumsum(unpacked(blob)) for blob in part.column("links").to_pylist()]
                sums = [
                    pa.array([int(column[p].sum()) if len(p) else 0 for p in places], pa.int64())
                    for column in (table[1], table[0])
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), *sums], [*kept, "n_best", "count_sum"]
                )

    schema = ", ".join(f"{c} {kinds[c]}" for c in kept)
    return (
        both.repartition("chunk")
        .sortWithinPartitions("chunk", F.col("place").asc_nulls_last())
        .mapInArrow(run, f"{schema}, n_best long, count_sum long")
    )


def second_size(pair: Pair) -> int:
    return PieceBpe(pair.second).size


def alignment_report(docs: DataFrame, pair: Pair | None = None, chunk: int = CHUNK) -> DataFrame:
    """One row per document: counts, digest of its groups, and the counts of its links in all texts.

    An empty table gives no rows; see :func:`align` for nulls and :func:`link_counts` for the counts.
    """
    pair = pair or tokenizers()
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).when(F.col("pairs").isNull(), "")
    aligned = align(docs, pair, chunk=chunk).withColumn("groups_sha256", digest).drop("groups")
    return link_counts(through_table(aligned, "aligned"), second_size(pair))
