"""Language-model scores: an interpolated modified Kneser-Ney bigram model.

Tasks count the bigrams of a chunk of texts and send them by range of the hash of the first word.
A range sums its counts and writes them as sorted hash arrays, together with what each first word
needs for its discount mass, and passes on for every second word how many first words it follows. A
second shuffle sums those by range of the word. Scoring tasks map the files into memory and look the
bigrams of a chunk up in sorted order, so their own memory is that of a chunk. Only totals come to
the driver.

Files are written to a name of their own and then renamed, with contents that depend on the rows
alone, so a task that runs twice is harmless. Workers map the files by path: the shared folder must
be mounted on them (a ``file:`` path).
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import text_of
from kindred.llm.jaccard import WordHashes
from kindred.session import scratch_path, through_table

CHUNK = 400_000  # tokens
RANGE = 4_000_000  # tokens per range
START, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
MIX, SALT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def bigram_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    out = first * MIX + second
    out ^= out >> np.uint64(29)
    return out * SALT


def _summed(keys, *columns):
    """Sorted distinct keys and the sums of columns."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
    return [keys[first]] + [np.add.reduceat(c[order], first) if len(keys) else c for c in columns]


def _sequence(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Word hashes and the end."""
    words = text.lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    out[-1] = END
    return out


def _before(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Previous words, words, and the lengths of the sequences."""
    lengths = np.array([len(s) for s in sequences])
    second = np.concatenate(sequences)
    first = np.empty_like(second)
    first[1:] = second[:-1]
    first[np.cumsum(lengths) - lengths] = START
    return first, second, lengths


def _save(folder: str, name: str, array: np.ndarray) -> None:
    os.makedirs(folder, exist_ok=True)
    temporary = f"{folder}/.{name}-{uuid.uuid4().hex}.npy"
    np.save(temporary, array)
    os.replace(temporary, f"{folder}/{name}.npy")


BLOBS = "range int, a binary, b binary, c binary"
TOTALS = ("n1", "n2", "n3", "n4")


def _blob_batch(rows):
    names = ["range", "a", "b", "c"]
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _chunks(batches, names=()):
    """Chunks of texts as lists of sequences, with the columns ``names`` of their rows."""
    hashes, chunk, size, rows = WordHashes(), [], 0, []
    for batch in batches:
        named = batch.select(list(names)) if names else None
        for i, text in enumerate(batch.column("text")):
            s = _sequence(text.as_py(), hashes)
            chunk.append(s)
            size += len(s)
            if names:
                rows.append(named.slice(i, 1))
            if size >= CHUNK:
                yield chunk, rows
                chunk, size, rows = [], 0, []
    if chunk:
        yield chunk, rows


def _runs(where: np.ndarray):
    """(range, start, end) of each run of equal ranges."""
    cuts = np.flatnonzero(where[1:] != where[:-1]) + 1
    starts = np.concatenate([[0], cuts]) if len(where) else cuts
    return [(int(where[i]), i, j) for i, j in zip(starts, [*cuts, len(where)])]


def _bigrams(ranges: int):
    def run(batches):
        for chunk, _ in _chunks(batches):
            first, second, _ = _before(chunk)
            order = np.lexsort((second, first, first % np.uint64(ranges)))
            first, second = first[order], second[order]
            new = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
            at = np.flatnonzero(np.concatenate([[True], new]))
            counts = np.diff(np.append(at, len(first))).astype(np.uint32)
            first, second = first[at], second[at]
            where = first % np.uint64(ranges)
            rows = [
                (r, first[i:j].tobytes(), second[i:j].tobytes(), counts[i:j].tobytes())
                for r, i, j in _runs(where)
            ]
            yield _blob_batch(rows)

    return run


def _by_range(batches, dtypes):
    """(range, arrays) of rows that are sorted by range."""
    now, parts = None, []

    def joined():
        return now, [np.concatenate([np.frombuffer(p[k], t) for p in parts]) for k, t in enumerate(dtypes)]

    for batch in batches:
        for r, *blobs in zip(*(batch.column(i) for i in range(1 + len(dtypes)))):
            r = r.as_py()
            if r != now:
                if parts:
                    yield joined()
                now, parts = r, []
            parts.append([b.as_py() for b in blobs])
    if parts:
        yield joined()


def _contexts(folder: str, ranges: int):
    """Writes the bigrams of a range, passes on the second words and the counts of counts."""

    def run(batches):
        for r, (first, second, counts) in _by_range(batches, (np.uint64, np.uint64, np.uint32)):
            order = np.lexsort((second, first))
            first, second, counts = first[order], second[order], counts[order].astype(np.int64)
            new = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
            at = np.flatnonzero(np.concatenate([[True], new]))
            counts = np.add.reduceat(counts, at)
            first, second = first[at], second[at]
            keys = bigram_keys(first, second)
            order = np.argsort(keys)
            _save(folder, f"bigram-{r}", keys[order])
            _save(folder, f"bigram-count-{r}", counts[order])
            at = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
            _save(folder, f"context-{r}", first[at])
            stats = [np.add.reduceat(x, at) for x in (counts, counts == 1, counts == 2, counts > 2)]
            _save(folder, f"context-stats-{r}", np.array(stats, np.int64).T)
            totals = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
            words, follows, seen = _summed(second, np.ones(len(second), np.int64), counts)
            where = words % np.uint64(ranges)
            order = np.argsort(where, kind="stable")
            where, words, follows, seen = where[order], words[order], follows[order], seen[order]
            rows = [
                (
                    w,
                    words[i:j].tobytes(),
                    follows[i:j].astype(np.uint32).tobytes(),
                    seen[i:j].tobytes(),
                )
                for w, i, j in _runs(where)
            ]
            blobs = _blob_batch(rows)
            # The totals of a range stand in its first row.
            columns = [pa.array([t] + [0] * (len(rows) - 1), pa.int64()) for t in totals]
            columns.append(pa.array([r] * len(rows), pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*blobs.columns, *columns], [*blobs.schema.names, *TOTALS, "own"]
            )

    return run


def _words(folder: str):
    def run(batches):
        for r, (words, follows, seen) in _by_range(batches, (np.uint64, np.uint32, np.int64)):
            words, follows, seen = _summed(words, follows.astype(np.int64), seen)
            _save(folder, f"word-{r}", words)
            _save(folder, f"word-stats-{r}", np.array([seen, follows], np.int64).T)
            totals = [len(words), seen.sum(), follows.sum()]
            totals += [(follows == k).sum() for k in (1, 2, 3, 4)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(t)]) for t in totals], ["v", "n", "pairs", "n1", "n2", "n3", "n4"]
            )

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2, 3 and more.

    Counts of counts that are zero (tiny or uniform corpora) give no estimate; then and whenever an
    estimate leaves [0, count], 0.5 is taken.
    """
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    out = np.zeros(4)
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = k - (k + 1) * y * b / a if a and b else 0.5
        out[k] = d if 0 < d <= k else 0.5
    return out


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the totals of the training texts."""

    folder: str
    ranges: int
    tokens: int
    words: int
    pairs: int
    of_bigrams: np.ndarray
    of_words: np.ndarray
    few: tuple[int, int, int]  # words that follow one, two, more words
    of_firsts: frozenset[int]  # ranges that have first words
    of_seconds: frozenset[int]  # ranges that have second words


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Counts all whole texts; null texts count as empty, and an empty text is its end."""
    spark = docs.sparkSession
    path = urlparse(scratch_path(spark, "lm"))
    if path.scheme not in ("", "file"):
        raise ValueError("language models are memory-mapped: mount spark.checkpoint.dir on the workers")
    folder = path.path
    texts = docs.select(text_of(text_col).cast("binary").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (6 * RANGE))
    passed = through_table(
        texts.mapInArrow(_bigrams(ranges), BLOBS)
        .repartition(ranges, "range")
        .sortWithinPartitions("range")
        .mapInArrow(_contexts(folder, ranges), BLOBS + "".join(f", {t} long" for t in TOTALS) + ", own int"),
        "follows",
    )
    of = [x or 0 for x in passed.agg(*(F.sum(t) for t in TOTALS)).first()]
    words = (
        passed.select("range", "a", "b", "c")
        .repartition(ranges, "range")
        .sortWithinPartitions("range")
        .mapInArrow(_words(folder), "v long, n long, pairs long, n1 long, n2 long, n3 long, n4 long")
    )
    v, n, pairs, n1, n2, n3, n4 = (
        x or 0 for x in words.agg(*(F.sum(c) for c in words.columns)).first()
    )
    # One number per range with rows comes to the driver.
    own, target = (frozenset(r[0] for r in passed.select(c).distinct().collect()) for c in ("own", "range"))
    few = (n1, n2, v - n1 - n2)
    return Model(folder, ranges, n, v, pairs, discounts(*of), discounts(n1, n2, n3, n4), few, own, target)


class Arrays:
    """The sorted arrays of a model, mapped into memory as they are asked for."""

    def __init__(self, model: Model):
        self.model, self.maps = model, {}

    def _map(self, name: str):
        if name not in self.maps:
            # A range without rows has no file; where a file is missing, loading raises.
            has = self.model.of_seconds if name.startswith("word") else self.model.of_firsts
            there = int(name.rsplit("-", 1)[1]) in has
            self.maps[name] = np.load(f"{self.model.folder}/{name}.npy", mmap_mode="r") if there else None
        return self.maps[name]

    def look_up(self, where: np.ndarray, keys: np.ndarray, name: str, values: str, width: int):
        """The values of keys, 0 where a key is unknown; every distinct key is looked up once."""
        order = np.lexsort((keys, where))
        keys_, where_ = keys[order], where[order]
        new = np.concatenate([[True], (keys_[1:] != keys_[:-1]) | (where_[1:] != where_[:-1])])
        distinct, ranges = keys_[new], where_[new]
        found = np.zeros((len(distinct), width), np.int64)
        cuts = np.append(np.flatnonzero(np.diff(ranges.astype(np.int64), prepend=-1)), len(ranges))
        for i, j in zip(cuts, cuts[1:]):
            known = self._map(f"{name}-{ranges[i]}")
            if known is not None:
                at = np.minimum(np.searchsorted(known, distinct[i:j]), len(known) - 1)
                hit = known[at] == distinct[i:j]
                stats = self._map(f"{values}-{ranges[i]}")
                found[i:j][hit] = np.reshape(stats[at[hit]], (-1, width))
        out = np.empty((len(keys), width), np.int64)
        out[order] = found[np.cumsum(new) - 1]
        return out

    def log10(self, first: np.ndarray, second: np.ndarray):
        """Counts of the words, and log10 of the probability of each word after its predecessor."""
        m, ranges = self.model, np.uint64(self.model.ranges)
        seen, follows = self.look_up(second % ranges, second, "word", "word-stats", 2).T
        keys = bigram_keys(first, second)
        pair = self.look_up(first % ranges, keys, "bigram", "bigram-count", 1)[:, 0]
        total, one, two, more = self.look_up(first % ranges, first, "context", "context-stats", 4).T
        d, e = m.of_bigrams, m.of_words
        # Words by the number of words they follow, down to a uniform share that leaves room for one
        # unknown word.
        rest = sum(x * y for x, y in zip(e[1:], m.few)) / max(m.pairs, 1)
        low = (follows - e[np.minimum(follows, 3)]) / max(m.pairs, 1)
        low = low + (rest if m.pairs else 1.0) / (m.words + 1)
        mass = (d[1] * one + d[2] * two + d[3] * more) / np.maximum(total, 1)
        high = (pair - d[np.minimum(pair, 3)]) / np.maximum(total, 1) + mass * low
        return seen, np.log10(np.where(total > 0, high, low))


def score(texts: DataFrame, model: Model) -> DataFrame:
    """Adds ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` to rows with
    a binary ``text``, which is dropped.

    ``base_score`` sums the log10 of add-half unigram probabilities, ``score`` those of the model.
    """
    names = [c for c in texts.columns if c != "text"]
    added = {"n_tokens": "long", "n_known": "long", "train_tokens": "long"}
    added |= {"base_score": "double", "score": "double"}
    kinds = [f"{c} {texts.schema[c].dataType.simpleString()}" for c in names]
    kinds += [f"{c} {k}" for c, k in added.items()]

    def run(batches):
        arrays = Arrays(model)
        scale = np.log10(max(model.tokens + 0.5 * (model.words + 1), 0.5))
        for chunk, rows in _chunks(batches, names):
            first, second, lengths = _before(chunk)
            seen, logs = arrays.log10(first, second)
            starts = np.cumsum(lengths) - lengths
            columns = (
                lengths,
                np.add.reduceat((seen > 0).astype(np.int64), starts),
                np.full(len(lengths), model.tokens),
                np.add.reduceat(np.log10(seen + 0.5) - scale, starts),
                np.add.reduceat(logs, starts),
            )
            kept = pa.Table.from_batches(rows).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [kept.column(c).chunk(0) for c in names] + [pa.array(c) for c in columns],
                [*names, *added],
            )

    return texts.mapInArrow(run, ", ".join(kinds))


def perplexities(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every row of ``docs`` by a model of the rows where ``held_out`` does not hold.

    ``held_out``: a column expression over ``doc_id``. Returns ``doc_id``, ``held_out``, ``n_tokens``
    (words and one end), ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``perplexity``
    (10 to the mean negative score). Null texts count as empty, their only token is the end. Without
    training rows every probability is the uniform one. Repeated rows are counted and scored each.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).cast("binary").alias("text"))
    rows = rows.select("doc_id", held_out.alias("held_out"), "text")
    model = fit(rows.where(~F.col("held_out")))
    return score(rows, model).withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    )
