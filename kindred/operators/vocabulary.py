"""Word counts and the keyword report."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.session import through_table

TOP_WORDS = 5
TOP_RECORDS = 5
WORDS_BEFORE, WORDS_AFTER = 2, 2
# Tokens and pairs counted at once inside a task.
_TOKENS, _PAIRS = 1_000_000, 4_000_000
# Bytes of a table of keywords that every task may hold.
KEYWORD_BYTES = 32_000_000
# The words that are counted for all keywords, and the most counts of them that a task may hold.
FREQUENT, _COUNTS = 4096, 4_000_000


def vocabulary(records: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """(token, count): all occurrences. Counts are partial before the shuffle."""
    return (
        records.select(F.explode(tokens_col).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def frequent(vocab: DataFrame, min_frequency: int = 2) -> DataFrame:
    """Words seen more often than ``min_frequency``."""
    return vocab.where(F.col("count") > min_frequency)


def by_frequency(vocab: DataFrame) -> DataFrame:
    """Most frequent first; equal counts in order of the token."""
    return vocab.orderBy(F.desc("count"), "token")


def _hits(records: DataFrame, keywords: DataFrame) -> DataFrame:
    """(keyword, record_id) for every record that holds the keyword.

    Only ids and words take part in the join, whatever its strategy.
    """
    return records.select(
        "record_id", F.explode(F.array_distinct("tokens")).alias("keyword")
    ).join(keywords.select("keyword").distinct(), "keyword")


def _with_keywords(records: DataFrame, keywords: DataFrame) -> DataFrame:
    """(record_id, tokens, keywords) for the records that hold a keyword.

    The keywords of a record come back to it as one list, so a token list is shuffled at
    most once and not once per word.
    """
    per_record = (
        _hits(records, keywords)
        .groupBy("record_id")
        .agg(F.collect_list("keyword").alias("keywords"))
    )
    return records.select("record_id", "tokens").join(per_record, "record_id")


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row number and word number of every list item, and the distinct words."""
    words = column.flatten().dictionary_encode()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(column)), lengths)
    if words.null_count:
        rows = rows[np.array(words.is_valid())]
    return rows, words.indices.drop_null().to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of batches with at most ``_TOKENS`` tokens, or one record."""
    for batch in batches:
        lengths = pc.fill_null(pc.list_value_length(batch.column("tokens")), 0)
        reach = np.cumsum(lengths.to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = reach[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(reach, done + _TOKENS, side="right")))
            yield batch.slice(start, end - start)
            start = end


def _numbers(words: pa.Array, listed: pa.Array) -> np.ndarray:
    """Place of each word in a list, -1 for those that are not in it."""
    places = pc.index_in(words, value_set=listed.cast(words.type))
    return pc.fill_null(places, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _expanded(key_row, key, cell_row, cell, times, rows, width):
    """(key * width + cell, n): the cells of its row for every key, at most ``_PAIRS`` at a time.

    Repeats of a word in a record are counted before. Keys come in order, so that the few keys of a part
    are counted in an array where that is no longer than the part.
    """
    order = np.argsort(key, kind="stable")
    key_row, key = key_row[order], key[order]
    first = np.searchsorted(cell_row, np.arange(rows + 1))
    sizes = first[key_row + 1] - first[key_row]
    reach = np.cumsum(sizes)
    start = 0
    while start < len(key_row):
        done = reach[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(reach, done + _PAIRS, side="right")))
        part, n = slice(start, end), sizes[start:end]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(first[key_row[part]], n) + inside
        low = key[start]
        pair = np.repeat(key[part] - low, n) * width + cell[at]
        span = (key[end - 1] - low + 1) * width
        if span <= max(len(pair), _PAIRS):
            total = np.bincount(pair, weights=times[at], minlength=1)
            pairs = np.flatnonzero(total)
            total = total[pairs]
        else:
            pairs, where = np.unique(pair, return_inverse=True)
            total = np.bincount(where, weights=times[at], minlength=1)[: len(pairs)]
        yield pairs + low * width, total.astype(np.int64)
        start = end


def _cells(row: np.ndarray, code: np.ndarray, width: int):
    """Row, word and number of times of the distinct words of each row."""
    cells, times = np.unique(row * width + code, return_counts=True)
    return *np.divmod(cells, max(width, 1)), times


def _pair_rows(keys: pa.Array, words: pa.Array, pairs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    keyword, word = np.divmod(pairs, max(len(words), 1))
    return pa.RecordBatch.from_arrays(
        [keys.take(pa.array(keyword)), words.take(pa.array(word)), pa.array(n)], ["keyword", "word", "n"]
    )


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(keyword, word, n) summed within slices of a batch, from records with their keywords."""
    for batch in _slices(batches):
        row, code, words = _lists(batch.column("tokens"))
        key_row, key, keys = _lists(batch.column("keywords"))
        if len(key_row) and len(row):
            cells = _cells(row, code, len(words))
            for pairs, n in _expanded(key_row, key, *cells, batch.num_rows, len(words)):
                yield _pair_rows(keys, words, pairs, n)


def _pair_counts_of(keys: pa.Array):
    """The same from records and a list of keywords."""

    def run(batches):
        for batch in _slices(batches):
            row, code, words = _lists(batch.column("tokens"))
            cell_row, cell, times = _cells(row, code, len(words))
            key = _numbers(words, keys)[cell]
            hit = key >= 0
            for pairs, n in _expanded(cell_row[hit], key[hit], cell_row, cell, times, batch.num_rows, len(words)):
                yield _pair_rows(keys, words, pairs, n)

    return run


def _listed_counts(keys: pa.Array, listed: pa.Array):
    """(keyword, word, n) for the listed words, summed over all that a task reads."""

    def run(batches):
        width = len(listed)
        sums = np.zeros(len(keys) * width, np.int64)
        for batch in _slices(batches):
            row, code, words = _lists(batch.column("tokens"))
            key, place = _numbers(words, keys)[code], _numbers(words, listed)[code]
            hit, seen = key >= 0, place >= 0
            key_row, key, _ = _cells(row[hit], key[hit], len(keys))
            cells = _cells(row[seen], place[seen], width)
            for pairs, n in _expanded(key_row, key, *cells, batch.num_rows, width):
                sums[pairs] += n
        pairs = np.flatnonzero(sums)
        for start in range(0, len(pairs), _TOKENS):
            part = pairs[start : start + _TOKENS]
            yield _pair_rows(keys, listed, part, sums[part])

    return run


def _holders(scored: DataFrame, keywords: DataFrame, shared: DataFrame | None) -> DataFrame:
    """(keyword) for every record that holds it; each of the records that share an id holds the keywords of all."""
    if shared is None:
        return scored.select("keyword")
    own = scored.join(shared.select("record_id").distinct(), "record_id", "left_anti").select("keyword")
    return own.unionByName(_with_keywords(shared, keywords).select(F.explode("keywords").alias("keyword")))


def keyword_records(records: DataFrame, keywords: DataFrame) -> DataFrame:
    """(keyword, n_records)."""
    return _records_per_keyword(_hits(records, keywords))


def _records_per_keyword(hits: DataFrame) -> DataFrame:
    return hits.groupBy("keyword").agg(F.count(F.lit(1)).alias("n_records"))


def _small(table: DataFrame, *columns: str) -> pa.Table | None:
    """The table if every task may hold it."""
    size = sum(
        (F.octet_length(c) if kind == "string" else F.octet_length(F.array_join(c, "")) + 8 * F.size(c)) + 16
        for c, kind in table.select(*columns).dtypes
    )
    if (table.agg(F.sum(size)).first()[0] or 0) > KEYWORD_BYTES:
        return None
    return table.select(*columns).toArrow()


def _strings(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays([c.cast(pa.string()) for c in column.chunks]) if column.num_chunks else pa.array([], pa.string())


def _by_id(records: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Records whose id no other has, and the others, None without such. Null ids are in neither."""
    records = records.where("record_id IS NOT NULL")
    ids = records.groupBy("record_id").agg(F.count(F.lit(1)).alias("_n"))
    shared = through_table(ids.where("_n > 1").select("record_id"), "shared-ids")
    if shared.isEmpty():
        return records, None
    return records.join(shared, "record_id", "left_anti"), records.join(shared, "record_id", "left_semi")


def cooccurring_words(
    records: DataFrame, keywords: DataFrame, top: int = TOP_WORDS
) -> DataFrame:
    """(keyword, word, n, rank): most frequent words over the containing records.

    Counts are summed in Arrow batches before the shuffle. The ranking keeps ``top`` rows per keyword and
    task before it shuffles again. Records that share an id share their keywords, which a join brings.

    A word stands beside a keyword at most as often as it stands in all records. The ``FREQUENT`` most
    frequent words are counted first: a keyword whose last place of them is above the count of every
    other word is done, and all words are counted only for the others, which few records hold.
    """
    return _cooccurring(records, keywords, _by_id(records), vocabulary(records), top)


_PAIR = "keyword STRING, word STRING, n LONG"


def _cooccurring(records, keywords, by_id, vocab, top=TOP_WORDS):
    found = _small(keywords.select("keyword").distinct(), "keyword")
    if found is None:
        return _ranked(_tagged_pairs(records, keywords), top)
    keys = pc.drop_null(_strings(found["keyword"]))
    own, shared = by_id
    own = own.select("tokens")
    if shared is not None:
        pairs = own.mapInArrow(_pair_counts_of(keys), _PAIR)
        return _ranked(pairs.unionByName(_tagged_pairs(shared, keywords)), top)
    most = min(FREQUENT, _COUNTS // max(len(keys), 1))
    if most < 10 * top:
        return _ranked(own.mapInArrow(_pair_counts_of(keys), _PAIR), top)
    first = vocab.where("token IS NOT NULL").orderBy(F.desc("count"), "token").limit(most).toArrow()
    others = first["count"][-1].as_py() if len(first) == most else 0
    listed = _strings(first["token"])
    ranked = through_table(_ranked(own.mapInArrow(_listed_counts(keys, listed), _PAIR), top), "ranked")
    done = ranked.where((F.col("rank") == top) & (F.col("n") > others)).select("keyword")
    if not others:
        return ranked
    settled = _strings(done.toArrow()["keyword"])
    rest = keys.filter(pc.invert(pc.is_in(keys, value_set=settled)))
    if not len(rest):
        return ranked
    counted = _ranked(own.mapInArrow(_pair_counts_of(rest), _PAIR), top)
    return ranked.join(F.broadcast(done), "keyword", "left_semi").unionByName(counted)


def _tagged_pairs(records: DataFrame, keywords: DataFrame) -> DataFrame:
    return _with_keywords(records, keywords).select("tokens", "keywords").mapInArrow(_pair_counts, _PAIR)


def _ranked(pairs: DataFrame, top: int) -> DataFrame:
    counts = pairs.groupBy("keyword", "word").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("keyword").orderBy(F.desc("n"), "word")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def top_word_lists(records: DataFrame, keywords: DataFrame) -> DataFrame:
    """(keyword, words): the co-occurring words of each keyword in rank order."""
    return _listed(cooccurring_words(records, keywords))


def _listed(ranked: DataFrame) -> DataFrame:
    return (
        ranked.groupBy("keyword")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "word"))).alias("ranked"))
        .select("keyword", F.col("ranked.word").alias("words"))
    )


def scored_records(
    records: DataFrame, keywords: DataFrame, words: DataFrame | None = None
) -> DataFrame:
    """(keyword, record_id, score, phrase) for every record that holds the keyword.

    ``score`` is the number of distinct top words in the record, ``phrase`` the words
    around the first place of the keyword. The token list ends here, so only the short
    phrase is shuffled afterwards.
    """
    by_id = _by_id(records)
    if words is None:
        words = through_table(_listed(_cooccurring(records, keywords, by_id, vocabulary(records))), "words")
    else:
        words = through_table(words.join(keywords.select("keyword").distinct(), "keyword", "left_semi"), "words")
    return _all_scored(records, keywords, by_id, words)


def _all_scored(records, keywords, by_id, words):
    """``words``: of keywords only."""
    distinct = words.select("keyword").distinct().count() == words.count()
    held = _small(words, "keyword", "words") if distinct else None
    if held is None:
        return _scored(_with_keywords(records, keywords), words)
    own, shared = by_id
    kind = dict(own.dtypes)["record_id"]
    scored = own.select("record_id", "tokens").mapInArrow(
        _scores(held), f"keyword STRING, record_id {kind}, score INT, phrase STRING"
    )
    return scored if shared is None else scored.unionByName(_scored(_with_keywords(shared, keywords), words))


def _scores(held: pa.Table):
    """(keyword, record_id, score, phrase) of a table (keyword, words) that the tasks hold."""
    keys = _strings(held["keyword"])
    owner, word, words = _lists(held["words"].combine_chunks() if len(held) else pa.array([], pa.list_(pa.string())))

    def run(batches):
        # One row per keyword, the numbers of its distinct words.
        wanted = np.unique(owner * max(len(words), 1) + word)
        of, word_of = np.divmod(wanted, max(len(words), 1))
        first_of = np.searchsorted(of, np.arange(len(keys) + 1))
        for batch in _slices(batches):
            column = batch.column("tokens")
            row, code, seen = _lists(column)
            key, place = _numbers(seen, keys)[code], _numbers(seen, words)[code]
            at = np.flatnonzero(key >= 0)
            cells, first = np.unique(row[at] * max(len(keys), 1) + key[at], return_index=True)
            hit_row, hit_key = np.divmod(cells, max(len(keys), 1))
            at = at[first]
            # The words of a hit's keyword that its record has.
            held_words = np.unique((row * len(words) + place)[place >= 0])
            n = first_of[hit_key + 1] - first_of[hit_key]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            asked = np.repeat(hit_row, n) * len(words) + word_of[np.repeat(first_of[hit_key], n) + inside]
            has = np.isin(asked, held_words)
            score = np.bincount(np.repeat(np.arange(len(hit_row)), n)[has], minlength=len(hit_row))
            # The tokens around the first place, within the record.
            begin = np.searchsorted(row, np.arange(batch.num_rows + 1))
            low = np.maximum(at - WORDS_BEFORE, begin[hit_row])
            high = np.minimum(at + WORDS_AFTER + 1, begin[hit_row + 1])
            ends = np.concatenate([[0], np.cumsum(high - low)])
            around = np.arange(ends[-1]) - np.repeat(ends[:-1] - low, high - low)
            near = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), seen.take(pa.array(code[around])))
            yield pa.RecordBatch.from_arrays(
                [
                    keys.take(pa.array(hit_key)),
                    batch.column("record_id").take(pa.array(hit_row)),
                    pa.array(score.astype(np.int32)),
                    pc.binary_join(near, " "),
                ],
                ["keyword", "record_id", "score", "phrase"],
            )

    return run


def _scored(tagged: DataFrame, words: DataFrame) -> DataFrame:
    """The words of a keyword go to the short (record, keyword) rows, and these to the tokens."""
    named = (
        tagged.select("record_id", F.explode("keywords").alias("keyword"))
        .join(words, "keyword")
        .groupBy("record_id")
        .agg(F.collect_list(F.struct("keyword", "words")).alias("named"))
    )
    first = F.array_position("tokens", F.col("keyword"))
    start = F.greatest(first - WORDS_BEFORE, F.lit(1))
    phrase = F.slice("tokens", start, first + WORDS_AFTER - start + 1)
    return (
        tagged.select("record_id", "tokens")
        .join(named, "record_id")
        .select("record_id", "tokens", F.inline("named"))
        .select(
            "keyword",
            "record_id",
            F.size(F.array_intersect("words", "tokens")).alias("score"),
            F.array_join(phrase, " ").alias("phrase"),
        )
    )


def representative_record(scored: DataFrame) -> DataFrame:
    """(keyword, record_id, score): the record with most top words; lowest id on ties."""
    return (
        scored.groupBy("keyword")
        .agg(F.min(F.struct((-F.col("score")).alias("neg"), "record_id")).alias("best"))
        .select("keyword", "best.record_id", (-F.col("best.neg")).alias("score"))
    )


def context_phrases(scored: DataFrame, top: int = TOP_RECORDS) -> DataFrame:
    """(keyword, rank, record_id, phrase): the keyword in its best records."""
    order = Window.partitionBy("keyword").orderBy(F.desc("score"), "record_id")
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .select("keyword", "rank", "record_id", "phrase")
    )


def keyword_report(
    records: DataFrame,
    keywords: DataFrame | None = None,
    min_frequency: int = 2,
) -> DataFrame:
    """(keyword, count, phrases, words, n_records).

    With a ``keywords`` table the report covers those keywords that are frequent enough;
    without one it covers every frequent word, whose cost is the sum of the squared
    numbers of distinct words per record.
    """
    vocab = through_table(vocabulary(records), "vocabulary")
    counts = frequent(vocab, min_frequency).withColumnRenamed("token", "keyword")
    if keywords is not None:
        counts = counts.join(keywords.select("keyword").distinct(), "keyword", "left_semi")
    counts = through_table(counts, "counts")
    by_id = _by_id(records)
    words = through_table(_listed(_cooccurring(records, counts, by_id, vocab)), "words")
    # Short rows, one per record and keyword, that are read twice.
    scored = through_table(_all_scored(records, counts, by_id, words), "scored")
    order = Window.partitionBy("keyword").orderBy(F.desc("score"), "record_id")
    phrases = (
        scored.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= TOP_RECORDS)
        .groupBy("keyword")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "phrase"))).alias("ranked"))
        .select("keyword", F.col("ranked.phrase").alias("phrases"))
    )
    n_records = _records_per_keyword(_holders(scored, counts, by_id[1]))
    return (
        counts.join(phrases, "keyword")
        .join(words, "keyword")
        .join(n_records, "keyword")
        .select("keyword", "count", "phrases", "words", "n_records")
    )
