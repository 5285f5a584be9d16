"""Word counts and the keyword report on the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.operators import vocabulary as voc
from kindred.session import scratch_path
from kindred.sources import reports
from suite import views
from suite.registry import query
from suite.sql import with_ctes


@query("vocab_count", with_ctes("vocab", "SELECT token, n AS count FROM vocab"))
def vocab_count(spark, sf):
    return voc.vocabulary(views.tokens(spark, sf))


@query("vocab_minfreq", with_ctes("vocab", "SELECT token, n AS count FROM vocab WHERE n > 2"))
def vocab_minfreq(spark, sf):
    return voc.frequent(voc.vocabulary(views.tokens(spark, sf)))


@query(
    "vocab_order",
    with_ctes("vocab", "SELECT token, n AS count FROM vocab WHERE n > 2 ORDER BY n DESC, token"),
)
def vocab_order(spark, sf):
    return voc.by_frequency(voc.frequent(voc.vocabulary(views.tokens(spark, sf))))


@query(
    "wordcount_lists",
    """SELECT token, count(*) AS count FROM (
        SELECT unnest(list_filter(string_split(text, ' '), lambda t: t <> '')) AS token FROM conversations)
    GROUP BY token ORDER BY count DESC, token""",
)
def wordcount_lists(spark, sf):
    lists = views.table(spark, sf, "conversations").select(
        F.filter(F.split("text", " "), lambda t: t != "").alias("tokens")
    )
    return voc.by_frequency(voc.vocabulary(lists))


@query(
    "keyword_docs",
    with_ctes("containing", "SELECT keyword, count(*) AS n_records FROM containing GROUP BY keyword"),
)
def keyword_docs(spark, sf):
    docs = views.tokens(spark, sf)
    return voc.keyword_records(docs, views.keyword_list(docs))


@query(
    "cooccur_top5",
    with_ctes("top5", "SELECT keyword, word, n, CAST(rank AS INTEGER) AS rank FROM top5"),
)
def cooccur_top5(spark, sf):
    docs = views.tokens(spark, sf)
    return voc.cooccurring_words(docs, views.keyword_list(docs))


@query(
    "representative",
    with_ctes(
        "scored",
        """SELECT keyword, arg_min(record_id, (-score, record_id)) AS record_id, max(score) AS score
        FROM scored GROUP BY keyword""",
    ),
)
def representative(spark, sf):
    docs = views.tokens(spark, sf)
    scored = voc.scored_records(docs, views.keyword_list(docs))
    return voc.representative_record(scored)


@query(
    "kwic",
    with_ctes(
        "phrases", "SELECT keyword, CAST(rank AS INTEGER) AS rank, record_id, phrase FROM phrases"
    ),
)
def kwic(spark, sf):
    docs = views.tokens(spark, sf)
    scored = voc.scored_records(docs, views.keyword_list(docs))
    return voc.context_phrases(scored)


def _report(spark, sf):
    docs = views.tokens(spark, sf)
    return voc.keyword_report(docs, views.keyword_list(docs))


@query(
    "keyword_report",
    with_ctes(
        "report",
        """SELECT keyword, count, array_to_string(phrases, ';') AS phrases,
               array_to_string(words, ';') AS words, n_records FROM report""",
    ),
)
def keyword_report(spark, sf):
    """The report for the keywords of all sources, the only ones that are looked up."""
    return _report(spark, sf).withColumns(
        {"phrases": F.array_join("phrases", ";"), "words": F.array_join("words", ";")}
    )


@query(
    "report_lines",
    with_ctes(
        "report",
        """SELECT keyword, concat_ws(',', keyword, CAST(count AS VARCHAR), array_to_string(phrases, ';'),
               array_to_string(words, ';'), CAST(n_records AS VARCHAR)) AS line FROM report""",
    ),
)
def report_lines(spark, sf):
    return reports.keyword_report_lines(_report(spark, sf))


@query(
    "report_file",
    with_ctes(
        "report",
        """SELECT 0::BIGINT AS place, 'keyword,count,related phrase,related keyword,number of related bugs' AS line
        UNION ALL SELECT row_number() OVER (ORDER BY count DESC, keyword), concat_ws(',', keyword,
            CAST(count AS VARCHAR), array_to_string(phrases, ';'), array_to_string(words, ';'),
            CAST(n_records AS VARCHAR)) FROM report""",
    ),
)
def report_file(spark, sf):
    """The written report, read back with the places of its lines."""
    path = scratch_path(spark, "keyword-report")
    reports.write_keyword_report(_report(spark, sf), path)
    return reports.read_lines(spark, path)
