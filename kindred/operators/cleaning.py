"""Cleaning of record tables; lemmas from dictionary tables."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.config import CATEGORY_FIELDS, TEXT_FIELDS
from kindred.functions import text as tx
from kindred.functions.scalars import (
    MISSING_VALUE,
    age_in_weeks,
    message,
    message_compat,
    prefix_before_dash,
)
from kindred.session import through_table

# Verb endings and what replaces them, in order of preference.
VERB_ENDINGS = (
    ("s", ""),
    ("ies", "y"),
    ("es", "e"),
    ("es", ""),
    ("ed", "e"),
    ("ed", ""),
    ("ing", "e"),
    ("ing", ""),
)


def shortened(word: str) -> list[str]:
    """The word with each ending replaced that it has."""
    forms = [word[: -len(ending)] + end for ending, end in VERB_ENDINGS if word.endswith(ending)]
    return [form for form in forms if form]


def _forms(batches):
    """All forms of a token that shortening leads to, by rounds; the token itself in the first."""
    names = ["token", "round", "position", "form"]
    for batch in batches:
        out = []
        for token in batch.column("token").to_pylist():
            forms, seen, rounds = shortened(token), {token}, 1
            out.append((token, 1, 0, token))
            while forms:
                # A form that came up before, with all that follows from it, adds nothing.
                forms = [f for f in dict.fromkeys(forms) if f not in seen]
                seen.update(forms)
                out.extend((token, rounds, i + 1, form) for i, form in enumerate(forms))
                forms = [f for form in forms for f in shortened(form)]
                rounds += 1
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.string()]
        columns = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def lemma_table(tokens: DataFrame, lexicon: DataFrame, exceptions: DataFrame) -> DataFrame:
    """(token, lemma) for the distinct tokens whose lemma differs from the token.

    A listed exception wins. Otherwise the endings are replaced; a candidate counts when
    the lexicon has it, and the shortest counts first. The token itself is a candidate, so
    a verb in its base form keeps it. Where no candidate of a round is known, the next
    round shortens the candidates again, until a form is known or none is left: forms lose
    a letter each time, so the rounds end. The forms of all rounds are looked up at once; the work
    grows with the vocabulary, not with the text.
    """
    words = through_table(tokens.select("token").where("token IS NOT NULL").distinct(), "words")
    known = lexicon.select(F.col("token").alias("form")).distinct()
    listed = exceptions.select("token").distinct()
    special = (
        words.join(exceptions.select("token", F.col("lemma").alias("form")), "token")
        .unionByName(words.join(listed, "token").select("token", F.col("token").alias("form")))
        .select("token", F.lit(0).alias("round"), F.lit(0).alias("position"), "form")
    )
    plain = words.join(listed, "token", "left_anti").mapInArrow(
        _forms, "token string, round int, position int, form string"
    )
    order = F.struct("round", F.length("form"), "position", "form")
    found = (
        plain.unionByName(special)
        .join(known, "form", "left_semi")
        .groupBy("token")
        .agg(F.min_by("form", order).alias("lemma"))
    )
    return through_table(found.where("lemma <> token"), "lemmas")


def lemmatize(
    records: DataFrame,
    lexicon: DataFrame,
    exceptions: DataFrame,
    tokens_col: str = "tokens",
) -> DataFrame:
    """Replaces each token by its lemma; order, repeats and all other columns stay.

    Rows are handled one by one: ids may repeat or be null, and are not looked at.
    """
    lemmas = lemma_table(records.select(F.explode(tokens_col).alias("token")), lexicon, exceptions)
    return replace_tokens(records, lemmas, [tokens_col])


LEMMA_BYTES = 32_000_000  # of a table (token, lemma) that every task may hold


def replace_tokens(
    records: DataFrame, lemmas: DataFrame, token_cols: Sequence[str], most_bytes: int = LEMMA_BYTES
) -> DataFrame:
    """Replaces the tokens that a table (token, lemma), one row per token, has.

    The table holds only tokens that change. Up to ``most_bytes`` it goes to the tasks, which look
    up the tokens of a batch where they are read; nothing is shuffled then. A larger one is joined to the
    distinct tokens of each row, by a number that rows get in a stored table.
    """
    size = F.sum(F.octet_length("token") + F.octet_length("lemma") + 16)
    if (lemmas.agg(size).first()[0] or 0) <= most_bytes:
        table = lemmas.select("token", "lemma").toArrow()
        changed, into = (table.column(c).combine_chunks().cast(pa.string()) for c in ("token", "lemma"))
        return _looked_up(records, changed, into, list(token_cols))
    return _joined(records, lemmas, token_cols)


PART_TOKENS = 500_000  # tokens of a part of a batch


def _parts(batches, token_cols):
    """Parts of batches with at most ``PART_TOKENS`` tokens, or one row."""
    for batch in batches:
        lengths = (pc.fill_null(pc.list_value_length(batch.column(c)), 0) for c in token_cols)
        reach = np.cumsum(sum(n.to_numpy(zero_copy_only=False).astype(np.int64) for n in lengths))
        start = 0
        while start < batch.num_rows:
            done = reach[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(reach, done + PART_TOKENS, side="right")))
            yield batch.slice(start, end - start)
            start = end


def _looked_up(records: DataFrame, changed: pa.Array, into: pa.Array, token_cols: list[str]) -> DataFrame:
    def run(batches):
        for batch in _parts(batches, token_cols):
            columns = list(batch.columns)
            for name in token_cols:
                i = batch.schema.get_field_index(name)
                tokens = batch.column(i)
                # The column may be a slice; nulls take no part of the flat tokens. Each distinct token is looked up.
                flat = tokens.flatten().dictionary_encode()
                at = pc.index_in(flat.dictionary, value_set=changed)
                flat = pc.coalesce(into.take(at), flat.dictionary.cast(pa.string())).take(flat.indices)
                lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
                ends = np.concatenate([[0], np.cumsum(lengths)])
                offsets = pa.array(ends, pa.int32(), mask=np.append(np.array(tokens.is_null()), False))
                columns[i] = pa.ListArray.from_arrays(offsets, flat)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return records.mapInArrow(run, records.schema)


def _joined(records: DataFrame, lemmas: DataFrame, token_cols: Sequence[str]) -> DataFrame:
    row = "_row"
    while row in records.columns:
        row += "_"
    rows = through_table(records.withColumn(row, F.monotonically_increasing_id()), "numbered")
    all_tokens = F.array_distinct(F.flatten(F.array(*(F.coalesce(c, F.array()) for c in token_cols))))
    changes = (
        rows.select(row, F.explode(all_tokens).alias("token"))
        .join(lemmas, "token")
        .groupBy(row)
        .agg(F.map_from_entries(F.collect_list(F.struct("token", "lemma"))).alias("_lemmas"))
    )
    lemma = lambda t: F.coalesce(F.try_element_at("_lemmas", t), t)
    return (
        rows.join(changes, row, "left")
        .withColumns(
            {c: F.when(F.col("_lemmas").isNotNull(), F.transform(c, lemma)).otherwise(F.col(c)) for c in token_cols}
        )
        .select(*records.columns)
    )


def clean_fields(
    records: DataFrame,
    fields: Sequence[str] = TEXT_FIELDS,
    lexicon: DataFrame | None = None,
    exceptions: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Adds ``<field>_clean`` for every text field; nulls read ``Missing`` and vanish.

    With a lexicon and exceptions the tokens are lemmatized before they are joined.
    """
    names = {f: f"{f}_clean" for f in fields}
    tokens = records.withColumns({n: _field_tokens(f, options) for f, n in names.items()})
    tokens = _with_lemmas(tokens, list(names.values()), lexicon, exceptions)
    return tokens.withColumns({n: tx.join_tokens(F.col(n)) for n in names.values()})


def _field_tokens(field: str, options: dict) -> Column:
    return tx.clean_tokens(F.coalesce(F.col(field), F.lit("Missing")), **options)


def _with_lemmas(
    tokens: DataFrame, columns: list[str], lexicon: DataFrame | None, exceptions: DataFrame | None
) -> DataFrame:
    """Lemmas in one pass over all columns; without a lexicon tokens stay as they are."""
    if lexicon is None:
        return tokens
    stored = through_table(tokens, "tokens")
    lemmas = lemma_table(
        stored.select(F.explode(F.flatten(F.array(*columns))).alias("token")), lexicon, exceptions
    )
    return replace_tokens(stored, lemmas, columns)


def field_tokens(
    records: DataFrame,
    fields: Sequence[str] = TEXT_FIELDS,
    lexicon: DataFrame | None = None,
    exceptions: DataFrame | None = None,
    **options,
) -> DataFrame:
    """(record_id, one token column per field): lemmas in one pass over all fields."""
    fields = list(fields)
    tokens = records.select("record_id", *[_field_tokens(f, options).alias(f) for f in fields])
    return _with_lemmas(tokens, fields, lexicon, exceptions)


def clean_text_table(
    records: DataFrame,
    compat: bool = False,
    lexicon: DataFrame | None = None,
    exceptions: DataFrame | None = None,
    **options,
) -> DataFrame:
    """(record_id, message, tokens, text): the text side of the clean table.

    With a lexicon and exceptions the tokens are lemmatized.
    """
    joined = (
        message_compat(["record_id", *TEXT_FIELDS, "duplicate_of"])
        if compat
        else message()
    )
    with_message = records.select("record_id", joined.alias("message"))
    with_tokens = with_message.withColumn("tokens", tx.clean_tokens(F.col("message"), **options))
    with_tokens = _with_lemmas(with_tokens, ["tokens"], lexicon, exceptions)
    return with_tokens.withColumn("text", tx.join_tokens(F.col("tokens")))


def clean_category_table(records: DataFrame, as_of: Column) -> DataFrame:
    """(record_id, project, product, manager, severity, submit_age, pin)."""
    text = [
        F.coalesce(F.col(c).cast("string"), F.lit(str(MISSING_VALUE))).alias(c)
        for c in CATEGORY_FIELDS
    ]
    age = F.coalesce(age_in_weeks(F.col("submitted_on"), as_of), F.lit(MISSING_VALUE))
    pin = F.coalesce(prefix_before_dash(F.col("component")), F.lit(str(MISSING_VALUE)))
    return records.select("record_id", *text, age.alias("submit_age"), pin.alias("pin"))
