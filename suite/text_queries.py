"""Text cleaning, step by step and as a whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.config import TEXT_FIELDS
from kindred.functions import text as tx
from kindred.operators import cleaning, vocabulary
from kindred.session import spread, through_table
from suite import sql as s
from suite import views
from suite.registry import query
from suite.sql import with_ctes


def _on_documents(name, spark_fn, sql_fn, out="text"):
    """Registers a step that maps one text to one text, on ``documents``."""

    @query(name, f"SELECT doc_id, {sql_fn('text')} AS {out} FROM documents")
    def run(spark, sf):
        return spread(views.table(spark, sf, "documents"), "doc_id").select(
            "doc_id", spark_fn(F.col("text")).alias(out)
        )


_on_documents("lower_trim", tx.lower_trim, s.lower_trim)
_on_documents("mask_url", tx.mask_urls, s.mask_url)
_on_documents("mask_email", tx.mask_emails, s.mask_email)
_on_documents("mask_phone", tx.mask_phones, s.mask_phone)
_on_documents("ascii_only", tx.ascii_only, s.ascii_only)
_on_documents("punct_space", tx.space_punctuation, s.punct_space)
_on_documents(
    "tokenize",
    lambda t: F.array_join(tx.tokenize(t), " "),
    lambda x: f"array_to_string({s.tokenize(x)}, ' ')",
    "tokens",
)
_on_documents(
    "stopwords",
    lambda t: F.array_join(tx.remove_stop_words(tx.tokenize(t)), " "),
    lambda x: f"array_to_string({s.stopwords(s.tokenize(x))}, ' ')",
    "tokens",
)
_on_documents(
    "token_filter",
    lambda t: F.array_join(tx.valid_tokens(tx.whitespace_tokens(F.lower(t))), " "),
    lambda x: f"array_to_string({s.valid(s.ws_tokens(f'lower({x})'))}, ' ')",
    "tokens",
)
_on_documents(
    "rejoin",
    lambda t: tx.join_tokens(tx.remove_stop_words(tx.tokenize(t))),
    lambda x: s.join_tokens(s.stopwords(s.tokenize(x))),
)


def _dictionary(spark, sf):
    """Lexicon and exceptions from the items of ``benchmark``."""
    bench = views.table(spark, sf, "benchmark").select(tx.clean_tokens(F.col("text")).alias("tokens"))
    exceptions = bench.select(F.get("tokens", 0).alias("token"), F.get("tokens", 1).alias("lemma"))
    return {
        "lexicon": vocabulary.vocabulary(bench).select("token"),
        "exceptions": exceptions.distinct(),
    }


def _denoised(texts, key, dictionary):
    """Clean text with lemmas of (key, text)."""
    tokens = through_table(texts.select(key, tx.clean_tokens(F.col("text")).alias("tokens")), "tokens")
    lemmas = cleaning.lemmatize(tokens, **dictionary)
    return lemmas.select(key, tx.join_tokens(F.col("tokens")).alias("text"))


def _denoise_sql(table, key, column):
    return f"""WITH RECURSIVE base AS (SELECT {key}, {s.clean_tokens(column)} AS tokens FROM {table}),
        {s.lemmatized('base', key)}
        SELECT {key}, {s.join_tokens('tokens')} AS text FROM lemmatized"""


@query("denoise", _denoise_sql("documents", "doc_id", "text"))
def denoise(spark, sf):
    documents = spread(views.table(spark, sf, "documents"), "doc_id")
    return _denoised(documents, "doc_id", _dictionary(spark, sf))



@query("strip_html", f"SELECT page_id, {s.strip_html('html')} AS text FROM pages")
def strip_html(spark, sf):
    return views.table(spark, sf, "pages").select(
        "page_id", tx.strip_html(F.col("html")).alias("text")
    )


@query("decode_entities", f"SELECT page_id, {s.entities('html')} AS text FROM pages")
def decode_entities(spark, sf):
    return views.table(spark, sf, "pages").select(
        "page_id", tx.decode_entities(F.col("html")).alias("text")
    )


@query("denoise_pages", _denoise_sql("pages", "page_id", "html"))
def denoise_pages(spark, sf):
    pages = views.table(spark, sf, "pages").withColumnRenamed("html", "text")
    return _denoised(pages, "page_id", _dictionary(spark, sf))


@query(
    "ws_tokens",
    f"""SELECT conv_id, turn, array_to_string({s.ws_tokens('text')}, '|') AS tokens
    FROM conversations""",
)
def ws_tokens(spark, sf):
    return views.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.array_join(tx.whitespace_tokens(F.col("text")), "|").alias("tokens")
    )


@query(
    "light_clean",
    f"""SELECT conv_id, turn, array_to_string({s.light_tokens('text')}, ' ') AS tokens
    FROM conversations""",
)
def light_clean(spark, sf):
    return views.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.array_join(tx.light_tokens(F.col("text")), " ").alias("tokens")
    )


@query(
    "field_clean",
    with_ctes(
        "field_long",
        f"""
        , base AS (SELECT record_id || '/' || field AS key, tokens FROM field_long),
        {s.lemmatized('base', 'key')}
        SELECT record_id, {", ".join(
            f"max(text) FILTER (field = '{f}') AS {f}_clean" for f in TEXT_FIELDS)}
        FROM (SELECT string_split(key, '/')[1] AS record_id, string_split(key, '/')[2] AS field,
                {s.join_tokens('tokens')} AS text FROM lemmatized) GROUP BY record_id""",
    ),
)
def field_clean(spark, sf):
    cleaned = cleaning.clean_fields(views.records(spark, sf), **_dictionary(spark, sf))
    return cleaned.select("record_id", *[f"{f}_clean" for f in TEXT_FIELDS])


@query(
    "clean_tables",
    with_ctes(
        "messages records",
        f"""
        , base AS (SELECT record_id, {s.clean_tokens('message')} AS tokens FROM messages),
        {s.lemmatized('base', 'record_id')}
        SELECT m.record_id, message, {s.join_tokens('l.tokens')} AS text,
               project, product, manager, severity,
               CAST(trunc(floor((epoch_us(TIMESTAMP '{views.AS_OF}') - epoch_us(submitted_on))
                   / 86400000000.0) / 7) AS INTEGER) AS submit_age,
               string_split(component, '-')[1] AS pin
        FROM messages m JOIN records r ON m.record_id = r.record_id
        JOIN lemmatized l ON l.record_id = m.record_id""",
    ),
)
def clean_tables(spark, sf):
    """Text side and category side of the record table, joined for the comparison."""
    records = views.records(spark, sf)
    as_of = F.lit(views.AS_OF).cast("timestamp")
    return (
        cleaning.clean_text_table(records, **_dictionary(spark, sf))
        .drop("tokens")
        .join(cleaning.clean_category_table(records, as_of), "record_id")
    )


@query(
    "lemmatize",
    with_ctes(
        "tokens",
        f"""
        , {s.lemmatized('tokens', 'record_id')}
        SELECT record_id, array_to_string(tokens, ' ') AS text FROM lemmatized""",
    ),
)
def lemmatize(spark, sf):
    docs = views.tokens(spark, sf).select("record_id", "tokens")
    return cleaning.lemmatize(docs, **_dictionary(spark, sf)).select(
        "record_id", F.array_join("tokens", " ").alias("text")
    )
