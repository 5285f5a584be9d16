"""Word vectors and record embeddings."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.config import Config
from kindred.operators.exact import PARTS, carried, lists, matrix, split, value
from kindred.operators.skipgram import skip_gram
from kindred.session import through_table


def subsample(
    records: DataFrame, threshold: float, seed: int, key: str = "record_id", tokens_col: str = "tokens"
) -> DataFrame:
    """Thins out words whose share f of all tokens is high: each occurrence stays with chance
    (sqrt(f / threshold) + 1) * threshold / f.

    An occurrence is drawn by a hash of the record's key, its place and the word, so reruns agree; rows
    with the same key and the same word at a place are drawn alike. Only words with a share above 2.6
    times the threshold have a chance below 1, so the table of chances has fewer than 1 / (2.6 *
    threshold) words at any size of the corpus. Null tokens and null lists stay as they are.
    """
    counts = records.select(F.explode(tokens_col).alias("word")).groupBy("word").count().where("word is not null")
    shares = counts.join(counts.agg(F.sum("count").alias("all"))).select(
        "word", (F.col("count") / F.col("all") / threshold).alias("f")
    )
    chance = (F.sqrt("f") + 1) / F.col("f")
    rare = shares.where(chance < 1).agg(F.map_from_entries(F.collect_list(F.struct("word", chance))).alias("_chances"))

    def stays(word, place):
        bits = F.shiftrightunsigned(F.xxhash64(F.col(key), place, word, F.lit(seed)), 11)
        return F.coalesce(bits / 2.0**53 < F.element_at("_chances", word), F.lit(True))

    kept = records.join(rare).withColumn(tokens_col, F.filter(tokens_col, stays))
    return kept.drop("_chances")


def fit_word_vectors(records: DataFrame, config: Config, tokens_col: str = "tokens") -> DataFrame:
    """(word, vector ARRAY<DOUBLE>) from a skip-gram model with negative sampling (see ``skip_gram``).

    With ``word2vec_sample`` frequent words are thinned out first (see ``subsample``). Null tokens and null
    lists teach nothing.
    """
    if config.word2vec_sample > 0:
        records = subsample(records, config.word2vec_sample, config.seed, tokens_col=tokens_col)
    return skip_gram(records, config, tokens_col)


def embed(
    records: DataFrame,
    word_vectors: DataFrame,
    size: int,
    keys: Sequence[str] = ("record_id",),
    tokens_col: str = "tokens",
) -> DataFrame:
    """(keys, vector): mean of the vectors of the known words; zeros when none is known.

    One row per record: records with the same or null keys stay apart. Null tokens count as none. The
    mean does not depend on how records are dealt to tasks.
    """
    keys = list(keys)
    means = _embedded(records, word_vectors, size, keys, [tokens_col])
    return means.select(*keys, F.col("_mean0").alias("vector"))


def embed_fields(
    records: DataFrame, word_vectors: DataFrame, size: int, fields: Sequence[str]
) -> DataFrame:
    """(record_id, one vector column per field) from one token column per field.

    All fields are embedded in one pass; one row per record, as in :func:`embed`.
    """
    fields = list(fields)
    means = _embedded(records, word_vectors, size, ["record_id"], fields)
    return means.select("record_id", *(F.col(f"_mean{i}").alias(f) for i, f in enumerate(fields)))


BLOCK_NUMBERS = 4_000_000  # numbers of a block of the word table
# Of a chunk of records: tokens, numbers of the vectors of its words, numbers of the means of its records.
TOKENS, HELD, MEANS = 1_000_000, 32_000_000, 4_000_000
_ASKED = "_block int, _words array<string>"
_CHUNK = "_chunk long, _n int, _keys binary, _ends binary, _at binary, _counts binary"


def _stored(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def _counted(keys, fields, size, blocks):
    """Chunks of records: a row with the counts of all its words, and one for each block that has some of them.

    A chunk's row has its keys and, for every field of a record in turn, the places of its distinct words
    in the list of words and their counts.
    """
    names = [part.split()[0] for part in f"{_CHUNK}, {_ASKED}".split(", ")]
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4, pa.int32(), pa.list_(pa.string())]

    def words_of(batch, lengths, low, high):
        found = [batch.column(f).slice(low, high - low).flatten() for f in fields]
        row = np.arange(high - low) * len(fields)
        of = np.concatenate([np.repeat(row + i, n[low:high]) for i, n in enumerate(lengths)])
        return of, pa.concat_arrays(found).dictionary_encode()

    def run(batches):
        task, chunk = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            n = batch.num_rows
            lengths = [pc.fill_null(pc.list_value_length(batch.column(f)), 0) for f in fields]
            lengths = [x.to_numpy(zero_copy_only=False).astype(np.int64) for x in lengths]
            cuts = np.concatenate([[0], np.cumsum(sum(lengths))])
            low = 0
            while low < n:
                high = max(low + 1, int(np.searchsorted(cuts, cuts[low] + TOKENS, "right")) - 1)
                high = min(high, low + max(1, MEANS // (size * len(fields))))
                of, words = words_of(batch, lengths, low, high)
                while len(words.dictionary) * size > HELD and high > low + 1:
                    high = low + (high - low) // 2
                    of, words = words_of(batch, lengths, low, high)
                of = of[np.array(words.is_valid())]
                at, words = words.indices.drop_null().to_numpy(), words.dictionary
                pair, counts = np.unique(of * max(1, len(words)) + at, return_counts=True)
                of, at = np.divmod(pair, max(1, len(words)))
                ends = np.cumsum(np.bincount(of, minlength=(high - low) * len(fields)))
                few = np.uint8 if counts.max(initial=0) < 256 else np.int32
                blobs = [x.astype(t).tobytes() for x, t in ((ends, np.int32), (at, np.int32), (counts, few))]
                of_records = _stored(batch.select(keys).slice(low, high - low))
                out = [(task + chunk, high - low, of_records, *blobs, None, words.to_pylist())]
                block = np.array([zlib.crc32(w.encode()) % blocks for w in words.to_pylist()])
                for b in np.unique(block):
                    asked = words.take(pa.array(np.flatnonzero(block == b))).to_pylist()
                    out.append((task + chunk, None, None, None, None, None, int(b), asked))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                low, chunk = high, chunk + 1

    return run


def _blob(vectors: np.ndarray) -> bytes:
    """Numbers of four bytes where these say the same."""
    short = vectors.astype(np.float32)
    return (short if (short == vectors).all() else vectors.astype(float)).tobytes()


def _from_blob(blob: pa.Buffer, rows: int, size: int) -> np.ndarray:
    return np.frombuffer(blob, np.float32 if blob.size == 4 * rows * size else float).reshape(rows, size)


def _packed(size, blocks):
    """The words of a batch that belong to a block as one row, their vectors as bytes."""

    def run(batches):
        for batch in batches:
            names = batch.column("word")
            vectors = matrix(batch.column("vector")).reshape(-1, size)
            block = np.array([zlib.crc32(w.encode()) % blocks for w in names.to_pylist()])
            for b in np.unique(block):
                mine = np.flatnonzero(block == b)
                words = pa.array([names.take(pa.array(mine)).to_pylist()], pa.list_(pa.string()))
                blob = pa.array([_blob(vectors[mine])], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), words, blob], ["_block", "_words", "_vectors"])

    return run


class _Block:
    """The words of a place with their vectors, in the order in which they come."""

    def __init__(self, size):
        self.size, self.words, self.vectors, self.whole = size, [], [], None

    def add(self, words, blob):
        self.words.append(words)
        self.vectors.append(_from_blob(blob, len(words), self.size))

    def table(self):
        if self.whole is None:
            self.whole = pa.concat_arrays(self.words), np.concatenate(self.vectors)
            self.vectors = []
        return self.whole


def _asking(batches, size):
    """(batch, row, block, places) for each list of words: where they stand among the words of its place.

    The words of a place come before the lists that ask for them; all lists at hand are looked up at once.
    """
    now, block = None, None
    for batch in batches:
        place = batch.column("_place").to_pylist()
        lengths = np.array(pc.fill_null(pc.list_value_length(batch.column("_words")), 0))
        cuts, looked = np.concatenate([[0], np.cumsum(lengths)]), 0
        for i in range(batch.num_rows):
            if place[i] != now:
                now, block, looked = place[i], _Block(size), 0
            blob = batch.column("_vectors")[i]
            if blob.is_valid:
                block.add(batch.column("_words")[i].values, blob.as_buffer())
                continue
            if not block.words:
                continue
            if i >= looked:
                # The words of all chunks at hand are looked up at once: the table is hashed once.
                start, looked = i, i + 1
                while looked < batch.num_rows and place[looked] == now:
                    looked += 1
                known = batch.column("_words").slice(start, looked - start).flatten()
                known = pc.index_in(known, block.table()[0]).fill_null(-1).to_numpy()
            yield batch, i, block, known[cuts[i] - cuts[start] : cuts[i + 1] - cuts[start]]


def _answered(size):
    """The words and vectors of a block that a chunk asks for."""

    def run(batches):
        for batch, i, block, at in _asking(batches, size):
            words, vectors = block.table()
            at = at[at >= 0]
            if len(at):
                found = pa.array([words.take(pa.array(at)).to_pylist()], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_chunk").slice(i, 1), found, pa.array([_blob(vectors[at])], pa.binary())],
                    ["_chunk", "_words", "_vectors"],
                )

    return run


def _multiplied(size, fields):
    """Sums of records: counts of a chunk times the vectors of its words, which come before it."""

    def run(batches):
        for batch, i, block, known in _asking(batches, size):
            vectors = block.table()[1]
            of = np.frombuffer(batch.column("_rows")[i].as_py(), np.int64)
            at, counts = (np.frombuffer(batch.column(c)[i].as_py(), np.int32) for c in ("_at", "_counts"))
            at = known[at]
            of, at, counts = of[at >= 0], at[at >= 0], counts[at >= 0].astype(np.int64)
            if not len(of):
                continue
            first = np.flatnonzero(np.diff(of, prepend=-1))
            sums = [np.zeros((len(first), size), np.int64) for _ in PARTS[1:]]
            # About four million numbers of the table and two million of the records at a time.
            width = max(1, min(size, 4_000_000 // len(vectors)))
            step = max(1, 2_000_000 // width)
            for left in range(0, size, width):
                part = slice(left, min(left + width, size))
                tables = split(vectors[:, part].astype(float))
                for low in range(0, len(of), step):
                    high = min(low + step, len(of))
                    begun = np.searchsorted(first, low, "right") - 1
                    mine = slice(begun, np.searchsorted(first, high))
                    cuts = np.maximum(first[mine] - low, 0)
                    for total, table in zip(sums, tables):
                        total[mine, part] += np.add.reduceat(table[at[low:high]] * counts[low:high, None], cuts)
            row = of[first]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row // fields),
                    pa.array((row % fields).astype(np.int32)),
                    pa.array(np.add.reduceat(counts, first)),
                    *map(lists, carried(*sums)),
                ],
                ["_row", "_field", *PARTS],
            )

    return run


def _mean_rows(keys, fields, size):
    """The keys and the mean of each field of every record of the chunks."""

    def run(batches):
        waiting = []

        def chunks():
            for batch in batches:
                pairs = {"_rows": [], "_at": [], "_counts": []}
                for i in range(batch.num_rows):
                    n = batch.column("_n")[i].as_py()
                    if n is None:
                        for values in pairs.values():
                            values.append(None)
                        continue
                    place, blob = batch.column("_place")[i].as_py(), batch.column("_counts")[i].as_py()
                    ends = np.frombuffer(batch.column("_ends")[i].as_py(), np.int32)
                    few = np.uint8 if len(blob) == ends[-1] else np.int32
                    of = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0)) + (place << 32)
                    pairs["_rows"].append(of.astype(np.int64).tobytes())
                    pairs["_at"].append(batch.column("_at")[i].as_py())
                    pairs["_counts"].append(np.frombuffer(blob, few).astype(np.int32).tobytes())
                    waiting.append((place, n, batch.column("_keys")[i].as_py()))
                wide = [batch.column(c) for c in ("_place", "_words", "_vectors")]
                wide += [pa.array(values, pa.binary()) for values in pairs.values()]
                yield pa.RecordBatch.from_arrays(wide, ["_place", "_words", "_vectors", *pairs])

        def filled(found=None):
            place, n, blob = waiting.pop(0)
            means = np.zeros((n * fields, size))
            if found is not None:
                parts = [matrix(found.column(c)) for c in PARTS[1:]]
                at = found.column("_row").to_numpy() - (place << 32)
                means[at] = value(*parts) / found.column("_n").to_numpy()[:, None]
            own = pa.ipc.open_stream(blob).read_all().to_batches()[0]
            columns = [lists(means[i::fields]) for i in range(fields)]
            return pa.RecordBatch.from_arrays([*own.columns, *columns], [*keys, *(f"_mean{i}" for i in range(fields))])

        for found in _multiplied(size, 1)(chunks()):
            place = found.column("_row")[0].as_py() >> 32
            while waiting[0][0] != place:
                yield filled()
            yield filled(found)
        while waiting:
            yield filled()

    return run


def _embedded(records, word_vectors, size, keys, fields):
    """(keys, _mean0, _mean1, ...): the means of the fields of every record, zeros where no word is known.

    Records are read once and their words counted in chunks; the word table is cut by hash into blocks.
    A chunk asks each block for the vectors of its own words, which come to it once, and the whole means
    of its records are made in one task. What is sent grows with the distinct words of the chunks, not
    with the blocks that the words of a record lie in.
    """
    spark = records.sparkSession
    words = word_vectors.select("word", "vector").where("word IS NOT NULL")
    total = words.agg(F.count(F.lit(1))).first()[0]
    blocks = 1 + total * size // BLOCK_NUMBERS
    types = dict(records.dtypes)
    stored = through_table(
        records.select(*keys, *fields).mapInArrow(_counted(keys, fields, size, blocks), f"{_CHUNK}, {_ASKED}"),
        "word-counts",
    )
    # Chunks are numbered task by task, so that each has a partition of its own.
    task = F.shiftright("_chunk", 33)
    rows = stored.where("_block IS NULL").groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("n")).collect()
    starts, chunks = [], 0
    for r in sorted(rows):
        starts.append((r["_task"], chunks))
        chunks += r["n"]
    starts = spark.createDataFrame(starts, "_task long, _start long")
    number = (F.col("_start") + F.col("_chunk") - F.shiftleft("_task", 33)).cast("int")
    stored = stored.withColumn("_task", task).join(F.broadcast(starts), "_task")
    stored = stored.withColumn("_chunk", number).drop("_task", "_start")

    asked = stored.where("_block IS NOT NULL").select("_chunk", *(c.split()[0] for c in _ASKED.split(", ")))
    # Blocks are copied only to give all cores some: copies that grew with the chunks would send the
    # whole word table once more for every so many of them.
    copies = max(1, min(chunks, -(-spark.sparkContext.defaultParallelism // blocks)))
    copy = F.sequence(F.col("_block") * copies, F.col("_block") * copies + F.lit(copies - 1))
    tables = words.mapInArrow(_packed(size, blocks), "_block int, _words array<string>, _vectors binary")
    tables = tables.select(
        F.explode(copy).alias("_place"), F.lit(None).cast("int").alias("_chunk"), "_words", "_vectors"
    )
    asked = asked.select(
        (F.col("_block") * copies + F.pmod(F.col("_chunk"), F.lit(copies))).alias("_place"),
        "_chunk",
        "_words",
        F.lit(None).cast("binary").alias("_vectors"),
    )
    answers = (
        tables.unionByName(asked)
        .repartitionById(blocks * copies, "_place")
        .sortWithinPartitions("_place", F.col("_vectors").isNull())
        .mapInArrow(_answered(size), "_chunk int, _words array<string>, _vectors binary")
    )
    columns = [part.split()[0] for part in _CHUNK.split(", ")[1:]]
    means = ", ".join([*(f"{k} {types[k]}" for k in keys), *(f"_mean{i} array<double>" for i in range(len(fields)))])
    return (
        answers.unionByName(stored.where("_block IS NULL").select("_chunk", "_words", *columns), allowMissingColumns=True)
        .withColumnRenamed("_chunk", "_place")
        .repartitionById(max(1, chunks), "_place")
        .sortWithinPartitions("_place", F.col("_vectors").isNull())
        .mapInArrow(_mean_rows(keys, len(fields), size), means)
    )


def stack(wide: DataFrame, fields: Sequence[str], value: str) -> DataFrame:
    """(record_id, field, value): one row per field."""
    pairs = [F.struct(F.lit(f).alias("field"), F.col(f).alias(value)) for f in fields]
    return wide.select("record_id", F.inline(F.array(*pairs)))


def concat_features(text_vectors: DataFrame, category_vectors: DataFrame) -> DataFrame:
    """(record_id, features): text part first, category part second, joined on the key."""
    return text_vectors.join(category_vectors, "record_id").select(
        "record_id", F.concat("vector", "category_vector").alias("features")
    )
