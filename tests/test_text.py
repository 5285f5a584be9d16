import html
import html.entities
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from kindred.functions import text as tx
from kindred.operators import cleaning
from suite import sql


def apply(spark, fn, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    return [r.x for r in rows.select("i", fn(F.col("t")).alias("x")).orderBy("i").collect()]


def test_lower_trim_strips_unicode_space(spark):
    text = "　  \x1c A b\x85\n"
    assert apply(spark, tx.lower_trim, text) == [text.lower().strip()]


def test_html_bare_less_than_loses_the_rest(spark):
    assert apply(spark, tx.strip_html, "a < b <i>c</i>", "x &lt; y > z", "<p>k&nbsp;l</p>") == [
        "a ",
        "x  z",
        "k l",
    ]


REFERENCES = [
    "&eacute;&#233;&#xE9;&#XE9 &copy &copy; &notit; &notin; &ampx; &amp;lt; &amp=1",
    "&#0; &#x80; &#150; &#xD800; &#x110000; &#99999999999999999999; &#x1F600; &#11; &#xFFFE; &#13;",
    "& &; &# &#; &#x; &nosuch; &nosuch &" + "a" * 40 + "; &NotEqualTilde; &&amp;& &#0000000000233;",
    "no reference", "", "&amp;", "a&lt;b&gt;", "&#129; &#x9f &#1; &#x1FFFF; &#xFDD0;",
]


def test_entities_equal_the_standard_decoder(spark):
    every = ["".join(f"[&{name}]" for name in html.entities.html5)]
    texts = REFERENCES + every + ["&eacute" * 20_000]
    assert apply(spark, tx.decode_entities, *texts, None) == [html.unescape(t) for t in texts] + [None]


def test_entities_in_sql_equal_the_standard_decoder():
    rows = duckdb.sql(f"SELECT {sql.entities('t')} FROM (SELECT unnest($1) AS t)", params=[REFERENCES]).fetchall()
    assert [r[0] for r in rows] == [html.unescape(t) for t in REFERENCES]


def test_html_decodes_every_entity(spark):
    got = apply(spark, tx.strip_html, "<p title='a'>&eacute;&#8364;&#xE9;</p><script>x</script>", None)
    assert got == ["é€é", None]


# Patterns as public documentation of the behaviour states them, for Python.
URL = (
    r"(http|ftp|https)://[\w\-_]+(\.[\w\-_]+)+"
    r"([\w\-\.,@?^=%&;:/~\+#]*[\w\-\@?^=%&;/~\+#])?"
)
EMAIL = r"([\w-]+(\.[\w-]+)*@[\w-]+(\.[\w-]+)+)"
PHONE = r"[\@\+\*].?[014789][0-9+\-\.\~\(\) ]+.{6,}"
SAMPLES = [
    "see http://a.b.c/d?e=f, or https://é.example.org.",
    "ftp://host/only http://x..y http://one.two. end",
    "a..b@c.d and x.y@z.w. a@b.c@d.e .q@r.s u@v",
    "-a-@b-.c- a_b@c_d.e_f é@è.ê",
    "call +1 408 555 1234 now\nnext",
    "call +1 408\rstill the same line 12\nnext *9 12",
]


@pytest.mark.parametrize(
    "fn, pattern, word",
    [
        (tx.mask_urls, URL, " url "),
        (tx.mask_emails, EMAIL, " email "),
        (tx.mask_phones, PHONE, " phone "),
    ],
)
def test_masks_equal_python(spark, fn, pattern, word):
    assert apply(spark, fn, *SAMPLES) == [re.sub(pattern, word, s) for s in SAMPLES]


def test_masks_survive_long_unbroken_text(spark):
    long = "a." * 200_000 + "b" * 200_000 + " x@y.zz"
    assert apply(spark, tx.mask_emails, long)[0].endswith("  email ")
    host = "http://" + "a." * 100_000 + "b"
    assert apply(spark, tx.mask_urls, host) == [" url "]


def test_punctuation_keeps_backslash(spark):
    import string

    kept = apply(spark, tx.space_punctuation, string.punctuation)[0]
    assert kept.replace(" ", "") == "!#$%&*/\\_"


def test_tokens(spark):
    got = apply(spark, tx.tokenize, "a bc _de f1gh été " + "x" * 15 + " " + "y" * 16)
    assert got == [["bc", "gh", "été", "x" * 15]]


def test_fused_cleaning_equals_the_separate_steps(spark):
    def steps(c):
        c = tx.mask_phones(tx.mask_emails(tx.mask_urls(tx.strip_html(tx.lower_trim(c)))))
        c = tx.tokenize(tx.space_punctuation(tx.ascii_only(c)))
        return tx.valid_tokens(tx.remove_stop_words(c))

    texts = SAMPLES + ["<b>Héllo</b> wörld_x Missing a1b2 __c", "", "the of and", "x&lt;y&gt;z"]
    assert apply(spark, steps, *texts) == apply(spark, tx.clean_tokens, *texts)


def test_blank_text_is_one_space(spark):
    assert apply(spark, tx.clean_text, "", "the and of", "printer") == [" ", " ", "printer"]


def test_whitespace_tokens(spark):
    assert apply(spark, tx.whitespace_tokens, " a b\n\nc ") == [["a", "b", "c"]]


def test_lemmas(spark):
    records = spark.createDataFrame(
        [("r1", ["crashes", "went", "running", "flies", "crashes", "need", "zzzs"]), ("r2", [])],
        "record_id STRING, tokens ARRAY<STRING>",
    )
    words = ["crash", "go", "run", "fly", "need", "crashe"]
    lexicon = spark.createDataFrame([(w,) for w in words], "token STRING")
    exceptions = spark.createDataFrame(
        [("went", "go"), ("running", "run")], "token STRING, lemma STRING"
    )
    got = {
        r.record_id: r.tokens
        for r in cleaning.lemmatize(records, lexicon, exceptions).collect()
    }
    assert got == {"r1": ["crash", "go", "run", "fly", "crash", "need", "zzzs"], "r2": []}


@pytest.mark.parametrize("most_bytes", [10**6, 0])
def test_lemmas_of_repeated_and_null_ids(spark, most_bytes):
    rows = [("a", ["walked", "x"], 1), ("a", ["walked", "talks"], 2), (None, ["walked", None], 3), ("b", None, 4), (None, [], 5)]
    records = spark.createDataFrame(rows, "record_id STRING, tokens ARRAY<STRING>, _row INT")
    lemmas = spark.createDataFrame([("walked", "walk"), ("talks", "talk")], "token STRING, lemma STRING")
    got = cleaning.replace_tokens(records, lemmas, ["tokens"], most_bytes)
    assert got.columns == records.columns
    want = [("a", ["walk", "x"], 1), ("a", ["walk", "talk"], 2), (None, ["walk", None], 3), ("b", None, 4), (None, [], 5)]
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[2]) == want
    none = cleaning.replace_tokens(records, lemmas.limit(0), ["tokens"], most_bytes)
    assert sorted((tuple(r) for r in none.collect()), key=lambda r: r[2]) == rows


def test_clean_fields_keeps_rows_apart(spark):
    rows = [("a", "They walked.", 1), ("a", "Walked home", 2), (None, "walked", 3), (None, None, 4)]
    records = spark.createDataFrame(rows, "record_id STRING, f STRING, n INT")
    lexicon = spark.createDataFrame([("walk",)], "token STRING")
    none = spark.createDataFrame([], "token STRING, lemma STRING")
    got = cleaning.clean_fields(records, ["f"], lexicon, none).collect()
    assert {r.n: r.f_clean.split() for r in got} == {1: ["walk"], 2: ["walk", "home"], 3: ["walk"], 4: []}


def test_second_round_of_endings(spark):
    tokens = spark.createDataFrame([("bookings",)], "token STRING")
    lexicon = spark.createDataFrame([("book",)], "token STRING")
    none = spark.createDataFrame([], "token STRING, lemma STRING")
    assert [tuple(r) for r in cleaning.lemma_table(tokens, lexicon, none).collect()] == [
        ("bookings", "book")
    ]


def test_cleaning_stays_in_the_jvm(spark, capsys):
    rows = spark.createDataFrame([("x",)], "t STRING")
    rows.select(tx.clean_text(F.col("t"))).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Exchange" not in plan


def test_masks_are_skipped_only_where_nothing_can_begin(spark, capsys):
    def masked(c):
        lowered = tx.lower_trim(c)
        plain = F.when(c.contains("<") | c.contains("&"), tx.strip_html(lowered)).otherwise(lowered)
        runs = F.regexp_extract_all(tx.mask_phones(tx.mask_emails(tx.mask_urls(plain))), F.lit("[a-z_]+"), 0)
        return tx.remove_stop_words(F.filter(runs, tx._token_length_ok))

    texts = ["HTTP://Ab.Cd/ef gh", "mail joe.doe@ab.cd now", "call +4412345678 abcdef", "call *1 23456 abcdef\nnext"]
    texts += ["a&#64;b joe&#64;ab.cd &#43;4412345678 abc", "http&#58;//ab.cd/x yes", "plain words only", "", None, "Kelvin @ 0abc"]
    assert apply(spark, tx.clean_tokens, *texts) == apply(spark, masked, *texts)
    spark.createDataFrame([("x",)], "t STRING").select(tx.clean_tokens(F.col("t"))).explain()
    plan = capsys.readouterr().out
    assert all(f"Contains(t#" in plan and f", {sign})" in plan for sign in ("://", "@", "+", "*"))


def test_valid_tokens_take_one_look_at_a_token(spark, capsys):
    def three(c):
        return F.filter(c, lambda t: ~t.rlike(f"[^{tx.TOKEN_CHARACTERS}]") & ~t.rlike("^[0-9]+$") & (F.length(t) >= 2))

    tokens = ["ab", "a", "12", "1", "1a", "a1", "12\n", "ab\n", "1\n2", "", "ét", "a b", "--", "-", "1.", "\U0001f600a", "&&", "9" * 5000 + "x", None]
    rows = spark.createDataFrame([(tokens,), (None,), ([],)], "t ARRAY<STRING>")
    got = rows.select(tx.valid_tokens(F.col("t")).alias("got"), three(F.col("t")).alias("want"))
    assert all(r.got == r.want for r in got.collect())
    got.select("got").explain()
    assert capsys.readouterr().out.count("RLIKE") == 1


def test_lemmas_are_looked_up_in_parts_of_a_batch(spark, monkeypatch):
    import pyarrow as pa

    rows = [["a", "b", None], None, [], ["a"] * 9, ["b", "a"], ["a"]]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], ["tokens"])
    monkeypatch.setattr(cleaning, "PART_TOKENS", 4)
    parts = [p.column("tokens").to_pylist() for p in cleaning._parts([batch.slice(0)], ["tokens"])]
    assert [r for p in parts for r in p] == rows
    assert all(len(p) == 1 or sum(len(r or ()) for r in p) <= 4 for p in parts) and len(parts) == 3
    records = spark.createDataFrame([(r,) for r in rows], "tokens ARRAY<STRING>")
    lemmas = spark.createDataFrame([("a", "x")], "token STRING, lemma STRING")
    got = [r.tokens for r in cleaning.replace_tokens(records.coalesce(1), lemmas, ["tokens"]).collect()]
    assert got == [r and ["x" if t == "a" else t for t in r] for r in rows]
