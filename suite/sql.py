"""SQL building blocks for DuckDB, written apart from the Spark code.

``with_ctes`` puts the named views in front of a statement, with the views they need.
Every step of the text pipeline is its own expression here.
"""

from __future__ import annotations

from html.entities import html5

from kindred.config import TEXT_FIELDS
from kindred.functions.text import (
    ENGLISH_STOP_WORDS,
    STOP_WORDS,
    WHITESPACE,
)


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _replace(x: str, pattern: str, by: str) -> str:
    return f"regexp_replace({x}, {literal(pattern)}, {literal(by)}, 'g')"


def lower_trim(x: str) -> str:
    return f"trim(lower({x}), {literal(WHITESPACE)})"


def entities(x: str) -> str:
    """Character references decoded: the text between them and the characters, in turns."""
    known = ", ".join(f"{literal(n)}: {literal(c)}" for n, c in sorted(html5.items()))
    bare = "|".join(sorted((n for n in html5 if ";" not in n), reverse=True))
    windows = ", ".join(
        f"{n}: {literal(bytes([n]).decode('cp1252'))}" for n in range(128, 160) if n not in (129, 141, 143, 144, 157)
    )
    reference = literal(f"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]{{0,31}};|(?:{bare}))")
    number = """CASE WHEN r[3] IN ('x', 'X') THEN try_cast('0x' || regexp_extract(r, '^&#.([0-9a-fA-F]+)', 1) AS BIGINT)
        ELSE try_cast(regexp_extract(r, '[0-9]+') AS BIGINT) END"""
    character = f"""CASE WHEN MAP {{{windows}}}[n] IS NOT NULL THEN MAP {{{windows}}}[n]
        WHEN n BETWEEN 1 AND 8 OR n = 11 OR n BETWEEN 14 AND 31 OR n = 127 OR n BETWEEN 64976 AND 65007
            OR (n <= 1114111 AND n % 65536 >= 65534) THEN ''
        WHEN n IS NULL OR n = 0 OR n > 1114111 OR n BETWEEN 55296 AND 57343 THEN chr(65533)
        ELSE chr(n::INTEGER) END"""
    begun = f"regexp_extract(r, '^&({bare})', 1)"
    one = f"""CASE WHEN r IS NULL THEN '' WHEN r[2] = '#' THEN list_transform([{number}], lambda n: {character})[1]
        ELSE coalesce(MAP {{{known}}}[r[2:]], MAP {{{known}}}[{begun}] || r[length({begun}) + 2:], r) END"""
    return f"""CASE WHEN {x} LIKE '%&%' THEN list_aggregate(list_transform(
        list_zip(regexp_split_to_array({x}, {reference}),
                 list_transform(regexp_extract_all({x}, {reference}), lambda r: {one})),
        lambda z: z[1] || coalesce(z[2], '')), 'string_agg', '') ELSE {x} END"""


def strip_html(x: str) -> str:
    x = _replace(x, r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>", "")
    x = _replace(x, r"(?s)<!--.*?-->", "")
    x = _replace(x, r"</?[a-zA-Z][^>]*>|<[!?][^>]*>", "")
    x = entities(f"replace({x}, '&nbsp;', ' ')")
    x = _replace(x, "<[^>]+>", "")
    x = f"replace({x}, '&nbsp;', ' ')"
    x = _replace(x, "<[^>]+", "")
    x = f"replace({x}, '&lt;', ' ')"
    return f"replace({x}, '&gt;', ' ')"


_W = r"\p{L}\p{N}_"


def mask_url(x: str) -> str:
    return _replace(
        x,
        rf"(http|ftp|https)://[{_W}\-]+(\.[{_W}\-]+)+"
        rf"([{_W}\-.,@?^=%&;:/~+#]*[{_W}\-@?^=%&;/~+#])?",
        " url ",
    )


def mask_email(x: str) -> str:
    return _replace(x, rf"[{_W}\-]+(\.[{_W}\-]+)*@[{_W}\-]+(\.[{_W}\-]+)+", " email ")


def mask_phone(x: str) -> str:
    return _replace(x, r"[@+*].?[014789][0-9+\-.~() ]+.{6,}", " phone ")


def ascii_only(x: str) -> str:
    return _replace(x, r"[^\x00-\x7F]", " ")


def punct_space(x: str) -> str:
    x = _replace(x, r"""["'(),;=?@<>\[\]^`{|}~:+]""", " ")
    x = _replace(x, "-", " ")
    return _replace(x, r"\.", " ")


def tokenize(x: str) -> str:
    return (
        rf"list_filter(regexp_extract_all(lower({x}), '[\p{{L}}\p{{Nl}}\p{{No}}_]+'), "
        "lambda t: length(t) BETWEEN 2 AND 15 AND NOT starts_with(t, '_'))"
    )


def _in(words: list[str]) -> str:
    return "(" + ", ".join(literal(w) for w in words) + ")"


def stopwords(x: str, words: list[str] = STOP_WORDS) -> str:
    return f"list_filter({x}, lambda t: t NOT IN {_in(words)})"


def valid(x: str) -> str:
    bad = r"""[^a-z0-9,.?:;"'\[\]{}=+\-_)(\^&$%#@!`~ ]"""
    return (
        f"list_filter({x}, lambda t: NOT regexp_matches(t, {literal(bad)}) "
        "AND NOT regexp_full_match(t, '[0-9]+') AND length(t) >= 2)"
    )


def clean_tokens(x: str) -> str:
    masked = mask_phone(mask_email(mask_url(strip_html(lower_trim(x)))))
    return valid(stopwords(tokenize(punct_space(ascii_only(masked)))))


def join_tokens(x: str) -> str:
    return f"CASE WHEN len({x}) = 0 THEN ' ' ELSE array_to_string({x}, ' ') END"


def ws_tokens(x: str) -> str:
    return (
        f"list_filter(regexp_split_to_array({x}, {literal('[' + WHITESPACE + ']+')}), "
        "lambda t: t <> '')"
    )


def light_tokens(x: str) -> str:
    return stopwords(tokenize(lower_trim(x)), ENGLISH_STOP_WORDS)


RID = "printf('R%07d', doc_id)"
_LINES = "string_split(d.text, chr(10))"
_FIELD_TOKENS = ", ".join(clean_tokens(f"coalesce({f}, 'Missing')") + f" AS {f}" for f in TEXT_FIELDS)

_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "records": (
        (),
        f"""
        SELECT printf('R%07d', d.doc_id) AS record_id,
               d.source || '-' || d.lang AS component, d.source AS project, d.lang AS product,
               'm' || CAST(d.doc_id % 17 AS VARCHAR) AS manager,
               coalesce(CAST(l.quality AS VARCHAR), 'none') AS severity,
               CAST(DATE '2024-01-01' + CAST(d.doc_id % 365 AS INTEGER) AS TIMESTAMP) AS submitted_on,
               {_LINES}[1] AS headline, {_LINES}[2] AS attribute, d.text AS description,
               {_LINES}[3] AS symptoms, {_LINES}[4] AS conditions,
               {_LINES}[5] AS workarounds, {_LINES}[6] AS release_note,
               nullif(printf('R%07d', min(d.doc_id) OVER (PARTITION BY d.text)),
                      printf('R%07d', d.doc_id)) AS duplicate_of,
               'e' || CAST(d.doc_id % 23 AS VARCHAR) AS engineer
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    ),
    "flagged": ((), f"SELECT {RID} AS record_id FROM labels WHERE toxic = 1"),
    "messages": (
        ("records",),
        "SELECT record_id, concat_ws(' ', "
        + ", ".join(f"coalesce({f}, 'Missing')" for f in TEXT_FIELDS)
        + ") AS message FROM records",
    ),
    "tokens": (
        (),
        f"SELECT {RID} AS record_id, source AS cluster_id, {clean_tokens('text')} AS tokens FROM documents",
    ),
    "vocab": (
        ("tokens",),
        "SELECT token, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM tokens) GROUP BY token",
    ),
    "words": (
        ("vocab",),
        """
        SELECT token AS word,
               [CAST(length(token) AS DOUBLE), CAST(ascii(token) AS DOUBLE),
                CAST(ascii(right(token, 1)) AS DOUBLE),
                CAST(length(token) - length(replace(token, 'e', '')) AS DOUBLE)] AS vector
        FROM vocab""",
    ),
    "corpus": (
        ("tokens", "words"),
        """
        SELECT t.record_id,
               t.cluster_id || '-' || CAST(CAST(substr(t.record_id, 2) AS BIGINT) // 400 AS VARCHAR) AS cluster_id,
               coalesce(m.vec, [0.0, 0.0, 0.0, 0.0]::DOUBLE[]) AS vec
        FROM tokens t LEFT JOIN (
            SELECT record_id, [avg(vector[1]), avg(vector[2]), avg(vector[3]), avg(vector[4])] AS vec
            FROM (SELECT record_id, unnest(tokens) AS word FROM tokens) JOIN words USING (word)
            GROUP BY record_id) m USING (record_id)""",
    ),
    "emb": (
        (),
        """SELECT vec_id AS record_id, label AS cluster_id, CAST(embedding AS DOUBLE[]) AS vec
        FROM embeddings""",
    ),
    "emb_dims": (
        ("emb",),
        "SELECT record_id, cluster_id, unnest(vec) AS x, unnest(range(len(vec))) AS pos FROM emb",
    ),
    "emb_centroids": (
        ("emb_dims",),
        """SELECT cluster_id, list(m ORDER BY pos) AS centroid FROM
        (SELECT cluster_id, pos, avg(x) AS m FROM emb_dims GROUP BY cluster_id, pos)
        GROUP BY cluster_id""",
    ),
    # Cluster labels.
    "ct": (
        ("tokens",),
        """SELECT cluster_id, token, count(*) AS cluster_df FROM
        (SELECT DISTINCT record_id, cluster_id, unnest(tokens) AS token FROM tokens)
        GROUP BY cluster_id, token""",
    ),
    "df": (("ct",), "SELECT token, CAST(sum(cluster_df) AS BIGINT) AS df FROM ct GROUP BY token"),
    "sizes": (("tokens",), "SELECT cluster_id, count(*) AS size FROM tokens GROUP BY cluster_id"),
    "parts": (
        ("ct", "df", "sizes"),
        """SELECT cluster_id, token, CAST(cluster_df AS DOUBLE) AS c, CAST(df AS DOUBLE) AS d,
               CAST(size AS DOUBLE) AS s, (SELECT CAST(count(*) AS DOUBLE) FROM documents) AS n
        FROM ct JOIN df USING (token) JOIN sizes USING (cluster_id)""",
    ),
    "scores": (
        ("parts",),
        """
        SELECT cluster_id, token,
               round(2 * (c / d) * (c / s) / (c / d + c / s), 12) AS f1,
               round(d / n * (c / d) * ln(c / d + 1e-10)
                     + (n - d) / n * b * ln(b + 1e-10), 12) AS gain
        FROM (SELECT *, CASE WHEN n - s - (d - c) = 0 THEN 0.0 ELSE (n - s - (d - c)) / (n - d) END AS b
              FROM parts)""",
    ),
    "top_f1": (
        ("scores",),
        """SELECT cluster_id, token, f1 AS score,
               row_number() OVER (PARTITION BY cluster_id ORDER BY f1 DESC, token) AS rank
        FROM scores QUALIFY rank <= 10""",
    ),
    "top_gain": (
        ("scores",),
        """SELECT cluster_id, token, gain AS score,
               row_number() OVER (PARTITION BY cluster_id ORDER BY gain DESC, token) AS rank
        FROM scores QUALIFY rank <= 10""",
    ),
    "fused": (
        ("top_f1", "top_gain"),
        """
        SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY score DESC, word) AS rank
        FROM (SELECT cluster_id, token AS word,
                     round(sum(CAST(2.0 AS DOUBLE) - CAST(0.1 AS DOUBLE) * (rank - 1)), 3) AS score
              FROM (SELECT * FROM top_f1 UNION ALL SELECT * FROM top_gain)
              GROUP BY cluster_id, token)""",
    ),
    "keywords": (
        ("fused",),
        r"""
        SELECT cluster_id, word,
               row_number() OVER (PARTITION BY cluster_id ORDER BY rank) AS pos
        FROM fused WHERE NOT regexp_full_match(word, '\p{Nd}+') QUALIFY pos <= 3""",
    ),
    # Keyword report for the cluster keywords.
    "kw": (("keywords",), "SELECT DISTINCT word AS keyword FROM keywords"),
    "containing": (
        ("kw", "tokens"),
        "SELECT keyword, record_id, tokens FROM kw JOIN tokens ON list_contains(tokens, keyword)",
    ),
    "top5": (
        ("containing",),
        """SELECT keyword, word, n, row_number() OVER (PARTITION BY keyword ORDER BY n DESC, word) AS rank
        FROM (SELECT keyword, word, count(*) AS n
              FROM (SELECT keyword, unnest(tokens) AS word FROM containing) GROUP BY keyword, word)
        QUALIFY rank <= 5""",
    ),
    "top5_lists": (
        ("top5",),
        "SELECT keyword, list(word ORDER BY rank) AS words FROM top5 GROUP BY keyword",
    ),
    "scored": (
        ("containing", "top5_lists"),
        """
        SELECT keyword, record_id,
               CAST(len(list_filter(words, lambda w: list_contains(tokens, w))) AS INTEGER) AS score,
               array_to_string(tokens[greatest(list_position(tokens, keyword) - 2, 1):
                                      list_position(tokens, keyword) + 2], ' ') AS phrase
        FROM containing JOIN top5_lists USING (keyword)""",
    ),
    "phrases": (
        ("scored",),
        """SELECT keyword, record_id, phrase,
               row_number() OVER (PARTITION BY keyword ORDER BY score DESC, record_id) AS rank
        FROM scored QUALIFY rank <= 5""",
    ),
    "report": (
        ("vocab", "kw", "phrases", "top5_lists", "containing"),
        """
        SELECT k.keyword, v.n AS count, p.phrases, w.words, c.n_records
        FROM kw k JOIN vocab v ON v.token = k.keyword AND v.n > 2
        JOIN (SELECT keyword, list(phrase ORDER BY rank) AS phrases FROM phrases GROUP BY keyword) p
             ON p.keyword = k.keyword
        JOIN top5_lists w ON w.keyword = k.keyword
        JOIN (SELECT keyword, count(*) AS n_records FROM containing GROUP BY keyword) c
             ON c.keyword = k.keyword""",
    ),
    "named": (
        ("keywords", "report"),
        """
        SELECT cluster_id, list(word ORDER BY pos) AS key_word,
               flatten(list(coalesce(phrases, []) ORDER BY pos)) AS key_phrase
        FROM keywords LEFT JOIN report ON keyword = word GROUP BY cluster_id""",
    ),
    # Related records for the flagged records.
    "queries": (
        ("corpus", "flagged"),
        """SELECT record_id AS query_id, cluster_id, vec AS query_vec
        FROM corpus WHERE record_id IN (SELECT record_id FROM flagged)""",
    ),
    "members": (
        ("queries", "corpus"),
        """SELECT query_id, record_id AS related_id,
               round(list_distance(query_vec, vec), 9) AS distance
        FROM queries q JOIN corpus c ON q.cluster_id = c.cluster_id AND q.query_id <> c.record_id""",
    ),
    "outside": (
        ("queries", "corpus"),
        """SELECT query_id, record_id AS related_id, distance FROM (
            SELECT q.query_id, c.record_id, q.cluster_id AS qc, c.cluster_id AS cc,
                   round(list_distance(query_vec, vec), 9) AS distance,
                   row_number() OVER (PARTITION BY q.query_id
                       ORDER BY round(list_distance(query_vec, vec), 9), c.record_id) AS rank
            FROM queries q JOIN corpus c ON q.query_id <> c.record_id)
        WHERE rank <= 20 AND qc <> cc""",
    ),
    "candidates": (
        ("members", "outside"),
        "SELECT * FROM members UNION ALL SELECT * FROM outside",
    ),
    "centroids": (
        ("corpus",),
        """SELECT cluster_id, [avg(vec[1]), avg(vec[2]), avg(vec[3]), avg(vec[4])] AS centroid
        FROM corpus GROUP BY cluster_id""",
    ),
    "decisions": (
        ("queries", "corpus", "centroids"),
        """
        SELECT query_id,
               CASE WHEN min(dist) < round(max(far), 9)
                    THEN arg_min(record_id, (dist, record_id)) END AS duplicate_id,
               coalesce(min(dist), 0.0) AS nearest_distance
        FROM (SELECT q.query_id, c.record_id, round(list_distance(query_vec, vec), 9) AS dist,
                     list_distance(vec, centroid) AS far
              FROM queries q LEFT JOIN (SELECT * FROM corpus JOIN centroids USING (cluster_id)) c
                ON q.cluster_id = c.cluster_id AND q.query_id <> c.record_id)
        GROUP BY query_id""",
    ),
    "field_tokens": (("records",), f"SELECT record_id, {_FIELD_TOKENS} FROM records"),
    "field_long": (
        ("field_tokens",),
        " UNION ALL ".join(
            f"SELECT record_id, {literal(f)} AS field, {f} AS tokens FROM field_tokens"
            for f in TEXT_FIELDS
        ),
    ),
    "fields": (
        ("field_long", "words"),
        """
        SELECT f.record_id, f.field, coalesce(m.vec, [0.0, 0.0, 0.0, 0.0]::DOUBLE[]) AS vec
        FROM field_long f LEFT JOIN (
            SELECT record_id, field, [avg(vector[1]), avg(vector[2]), avg(vector[3]), avg(vector[4])] AS vec
            FROM (SELECT record_id, field, unnest(tokens) AS word FROM field_long)
            JOIN words USING (word) GROUP BY record_id, field) m
        ON f.record_id = m.record_id AND f.field = m.field""",
    ),
    "text_scores": (
        ("candidates", "fields"),
        """
        SELECT c.query_id, c.related_id, a.field AS name,
               CAST(list_position(['"""
        + "', '".join(TEXT_FIELDS)
        + """'], a.field) AS BIGINT) AS pos,
               round(list_inner_product(a.vec, b.vec)
                     / ((sqrt(list_inner_product(a.vec, a.vec)) + 1e-10)
                        * (sqrt(list_inner_product(b.vec, b.vec)) + 1e-10)), 9) AS score
        FROM candidates c JOIN fields a ON a.record_id = c.query_id
        JOIN fields b ON b.record_id = c.related_id AND b.field = a.field""",
    ),
    "feature_values": (
        ("records",),
        """
        SELECT record_id, 'pin' AS name, 1 AS pos, string_split(component, '-')[1] AS v FROM records
        UNION ALL SELECT record_id, 'manager', 2, manager FROM records
        UNION ALL SELECT record_id, 'product', 3, product FROM records
        UNION ALL SELECT record_id, 'project', 4, project FROM records
        UNION ALL SELECT record_id, 'severity', 5, severity FROM records""",
    ),
    "category_scores": (
        ("candidates", "feature_values"),
        """
        SELECT c.query_id, c.related_id, a.name, CAST(a.pos AS BIGINT) AS pos,
               CASE WHEN a.v = b.v THEN 1.0 ELSE 0.0 END::DOUBLE AS score
        FROM candidates c JOIN feature_values a ON a.record_id = c.query_id
        JOIN feature_values b ON b.record_id = c.related_id AND b.name = a.name""",
    ),
    "explained": (
        ("text_scores", "category_scores"),
        """
        SELECT query_id, related_id, array_to_string(list_concat(
            CASE WHEN len(kept) > 0 THEN kept WHEN len(cats) = 0 THEN best[1:2]
                 WHEN len(cats) = 1 THEN best[1:1] ELSE [] END, cats), ',') AS key_feature
        FROM (SELECT query_id, related_id,
                     coalesce(list(name ORDER BY score DESC, pos) FILTER (score > 0.6), []) AS kept,
                     list(name ORDER BY score DESC, pos) AS best
              FROM text_scores GROUP BY query_id, related_id)
        JOIN (SELECT query_id, related_id,
                     coalesce(list(name ORDER BY rn) FILTER (score > CASE WHEN rn = 1 THEN 0 ELSE 0.9 END), [])[1:3] AS cats
              FROM (SELECT *, row_number() OVER (PARTITION BY query_id, related_id
                                                 ORDER BY score DESC, pos) AS rn
                    FROM category_scores)
              GROUP BY query_id, related_id) USING (query_id, related_id)""",
    ),
    "flat": (
        ("candidates", "explained", "decisions", "records", "named"),
        """
        SELECT c.query_id, q.duplicate_of, q.severity AS query_severity,
               q.manager AS query_manager, q.engineer AS query_engineer, c.related_id,
               coalesce(c.related_id = d.duplicate_id, false) AS is_duplicate, c.distance,
               r.description, r.severity AS related_severity,
               r.manager AS related_manager, e.key_feature, n.key_word, n.key_phrase
        FROM candidates c
        JOIN explained e ON e.query_id = c.query_id AND e.related_id = c.related_id
        JOIN decisions d ON d.query_id = c.query_id
        JOIN records r ON r.record_id = c.related_id
        JOIN records q ON q.record_id = c.query_id
        JOIN named n ON n.cluster_id = r.project""",
    ),
}


def with_ctes(names: str, statement: str) -> str:
    """``statement`` preceded by the listed views and the views they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _CTES[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    views = ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in ordered)
    return f"WITH RECURSIVE {views}\n{statement}"


def lemmatized(base: str, key: str) -> str:
    """CTEs after which ``lemmatized`` has ``key`` and the lemmas of ``base``'s tokens as ``tokens``.

    The items of ``benchmark`` are the dictionary: their tokens the lexicon, the first two tokens
    of each an exception. ``base`` has ``key`` and ``tokens``.
    """
    from kindred.operators.cleaning import VERB_ENDINGS

    endings = ", ".join(f"({i}, '{e}', '{by}')" for i, (e, by) in enumerate(VERB_ENDINGS))
    return f"""
        endings(number, ending, instead) AS (VALUES {endings}),
        bench AS (SELECT item_id, {clean_tokens('text')} AS tokens FROM benchmark),
        lexicon AS (SELECT DISTINCT unnest(tokens) AS token FROM bench),
        exceptions AS (SELECT DISTINCT tokens[1] AS token, tokens[2] AS lemma FROM bench),
        toks AS (SELECT DISTINCT unnest(tokens) AS token FROM {base}),
        rest AS (SELECT token FROM toks WHERE token NOT IN (SELECT token FROM exceptions WHERE token IS NOT NULL)),
        forms AS (
            SELECT token, token AS form, 0 AS round, 0::BIGINT AS pos FROM rest
            UNION ALL
            SELECT token, left(form, length(form) - length(ending)) || instead, round + 1, pos * 8 + number
            FROM forms JOIN endings ON ends_with(form, ending)
            WHERE length(form) - length(ending) + length(instead) > 0),
        candidates AS (
            SELECT token, greatest(round, 1) AS round, CASE round WHEN 0 THEN -1 ELSE pos END AS pos, form FROM forms
            UNION ALL SELECT token, 0, 0, lemma FROM exceptions WHERE token IN (SELECT token FROM toks)
            UNION ALL SELECT DISTINCT token, 0, 0, token FROM exceptions WHERE token IN (SELECT token FROM toks)),
        lemmas AS (
            SELECT token, arg_min(form, (round, length(form), pos, form)) AS lemma
            FROM candidates WHERE form IN (SELECT token FROM lexicon) GROUP BY token),
        exploded AS (SELECT {key}, unnest(tokens) AS token, unnest(range(len(tokens))) AS i FROM {base}),
        lemmatized AS (
            SELECT b.{key}, coalesce(x.tokens, []) AS tokens FROM {base} b LEFT JOIN (
                SELECT {key}, list(coalesce(lemma, token) ORDER BY i) AS tokens
                FROM exploded LEFT JOIN lemmas USING (token) GROUP BY {key}) x ON b.{key} = x.{key})"""
