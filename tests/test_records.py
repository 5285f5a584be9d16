import collections
import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from kindred.functions import scalars as sc
from kindred.functions import vectors as v
from kindred.operators import categories as cat
from kindred.operators import explain, labels, related, rows
from kindred.operators import vocabulary as voc
from kindred.session import scratch_path
from kindred.sources import csv_files, json_docs, reports


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def vec(*xs):
    return F.array(*[F.lit(float(x)) for x in xs])


def test_vector_functions(spark):
    got = one(
        spark,
        euclid=v.euclidean(vec(0, 3), vec(4, 0)),
        zero=v.cosine(vec(0, 0), vec(1, 0)),
        text=v.cosine_of_text(F.lit("[0, 1]"), F.lit("[1, 1]")),
        written=v.vector_text(F.array(F.lit(0), F.lit(1))),
    )
    assert got.euclid == 5.0 and got.zero == 0.0 and got.written == "[0, 1]"
    assert got.text == pytest.approx(math.sqrt(0.5))


def test_age_rounds_days_down_and_weeks_to_zero(spark):
    as_of = F.lit("2024-01-15 12:00:00").cast("timestamp")

    def age(text):
        return sc.age_in_weeks(F.lit(text).cast("timestamp"), as_of)

    got = one(
        spark,
        old=age("2024-01-01 13:00:00"),
        two=age("2024-01-01 12:00:00"),
        future=age("2024-01-20 12:00:00"),
        # -6 days 23 hours: days round down to -7.
        far=age("2024-01-22 11:00:00"),
        bad=sc.parse_timestamp(F.lit("not a time")),
    )
    assert (got.old, got.two, got.future, got.far, got.bad) == (1, 2, 0, -1, None)


def test_fill_nulls_by_type(spark):
    df = spark.createDataFrame(
        [(None, None, None, None)], "a STRING, b STRING, c INT, d DOUBLE"
    )
    got = rows.fill_nulls(df, text_columns=["a"]).first()
    assert tuple(got) == ("Missing", "999", 999, 999.0)


def test_multi_token_and_unseen_categories(spark):
    df = spark.createDataFrame(
        [(1, "High"), (2, "Very High"), (3, None)], "record_id INT, severity STRING"
    )
    dictionary = cat.category_dictionary(df, ["severity"])
    assert sorted((r.category, r.idx) for r in dictionary.collect()) == [
        ("High", 0),
        ("Very High", 1),
    ]
    new = spark.createDataFrame(
        [(1, "High"), (2, "Very High"), (3, None), (4, "c")], "record_id INT, severity STRING"
    )

    def coded(mode):
        out = cat.encode(new, dictionary, ["severity"], mode)
        return {r.record_id: r.severity for r in out.collect()}

    assert coded("value") == {1: [1, 0], 2: [0, 1], 3: [0, 0], 4: [0, 0]}
    assert coded("words") == {1: [1, 0], 2: [1, 0], 3: [0, 0], 4: [0, 0]}


def scores(**named):
    return F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(float(s)).alias("score")) for n, s in named.items()]
    )


@pytest.mark.parametrize(
    "text, category, want",
    [
        # Nothing counts: the two best text fields.
        (dict(h=0.1, d=0.3, s=0.2), dict(pin=0, man=0), "d,s"),
        # One category only: the best text field joins it.
        (dict(h=0.1, d=0.3, s=0.2), dict(pin=0.5, man=0.8), "d,man"),
        # Two categories: no text needed.
        (dict(h=0.1, d=0.3, s=0.2), dict(pin=1, man=1), "pin,man"),
        # The second category needs more than 0.90; equal scores keep their order.
        (dict(h=0.7, d=0.7, s=0.6), dict(pin=0.9, man=0.95), "h,d,man"),
        # At most three categories.
        (dict(h=0.9, d=0, s=0), dict(a=1, b=1, c=1, d=1), "h,a,b,c"),
    ],
)
def test_key_feature(spark, text, category, want):
    assert one(spark, k=explain.key_feature(scores(**text), scores(**category))).k == want


def token_frame(spark, lists):
    return spark.createDataFrame(
        [(f"r{i}", c, t) for i, (c, t) in enumerate(lists)],
        "record_id STRING, cluster_id INT, tokens ARRAY<STRING>",
    )


def test_label_scores_equal_the_formulas(spark):
    docs = [(0, ["a", "b", "b"]), (0, ["a", "c"]), (1, ["a", "d"]), (1, ["d", "12"]), (1, ["a"])]
    got = {
        (r.cluster_id, r.token): (r.f1, r.gain)
        for r in labels.token_scores(token_frame(spark, docs)).collect()
    }
    n = len(docs)
    for (cluster, token), (f1, gain) in got.items():
        size = sum(c == cluster for c, _ in docs)
        df = sum(token in t for _, t in docs)
        count = sum(token in t for c, t in docs if c == cluster)
        p, r = count / df, count / size
        assert f1 == pytest.approx(2 * p * r / (p + r))
        rest = n - size - (df - count)
        other = rest / (n - df) if rest else 0
        want = df / n * p * math.log(p + 1e-10) + (n - df) / n * other * math.log(other + 1e-10)
        assert gain == pytest.approx(want)
    words = labels.cluster_keywords(
        labels.candidate_lists(labels.fused_ranking(labels.token_scores(token_frame(spark, docs))))
    )
    assert all("12" not in r.key_word and len(r.key_word) <= 3 for r in words.collect())


def test_token_of_every_record_has_no_second_term(spark):
    docs = [(0, ["a"]), (0, ["a"]), (1, ["a"])]
    got = {
        r.cluster_id: r.gain
        for r in labels.token_scores(token_frame(spark, docs)).collect()
    }
    assert got[0] == pytest.approx(2 / 3 * math.log(2 / 3))


def test_full_keyword_report_equals_brute_force(spark):
    import random

    rng = random.Random(5)
    lists = [[rng.choice("abcdefghij") * 2 for _ in range(rng.randrange(0, 12))] for _ in range(40)]
    docs = token_frame(spark, [(0, t) for t in lists])
    ids = {f"r{i}": t for i, t in enumerate(lists)}
    got = {r.keyword: r for r in voc.keyword_report(docs).collect()}
    counts = collections.Counter(w for t in lists for w in t)
    assert set(got) == {w for w, c in counts.items() if c > 2}
    for word, row in got.items():
        containing = {i: t for i, t in ids.items() if word in t}
        together = collections.Counter(w for t in containing.values() for w in t)
        top = [w for w, _ in sorted(together.items(), key=lambda x: (-x[1], x[0]))[:5]]
        best = sorted(containing, key=lambda i: (-len(set(top) & set(containing[i])), i))[:5]
        phrases = []
        for i in best:
            at = containing[i].index(word)
            phrases.append(" ".join(containing[i][max(0, at - 2) : at + 3]))
        assert (row["count"], row.n_records) == (counts[word], len(containing))
        assert row.words == top and row.phrases == phrases


def test_report_line(spark):
    df = spark.createDataFrame(
        [("k", 3, ["a k", "k b"], ["k", "a"], 2)],
        "keyword STRING, count LONG, phrases ARRAY<STRING>, words ARRAY<STRING>, n_records LONG",
    )
    assert reports.keyword_report_lines(df).first().line == "k,3,a k;k b,k;a,2"


def test_reports_are_written_under_their_headers(spark):
    rows = [(f"k{i}", i % 7, [f"p{i}", "x y"], [f"w{i}"], i) for i in range(500)]
    df = spark.createDataFrame(
        rows, "keyword STRING, count LONG, phrases ARRAY<STRING>, words ARRAY<STRING>, n_records LONG"
    ).repartition(5)
    path = scratch_path(spark, "keywords")
    reports.write_keyword_report(df, path)
    got = reports.read_lines(spark, path).orderBy("place").collect()
    ordered = sorted(rows, key=lambda r: (-r[1], r[0]))
    want = [f"{k},{n},{';'.join(p)},{';'.join(w)},{m}" for k, n, p, w, m in ordered]
    assert [r.place for r in got] == list(range(501))
    assert [r.line for r in got] == [reports.KEYWORD_HEADER, *want]

    path = scratch_path(spark, "candidates")
    df = spark.createDataFrame(
        [(2, [(1, "b", 0.5)]), (1, [(1, "a", 2.0), (2, "c", 1.9)])],
        "cluster_id LONG, candidates ARRAY<STRUCT<rank: INT, word: STRING, score: DOUBLE>>",
    )
    reports.write_candidates(df, path)
    got = [r.line for r in reports.read_lines(spark, path).orderBy("place").collect()]
    assert got == [reports.CANDIDATE_HEADER, "1 : [('a', 2.0), ('c', 1.9)]", "2 : [('b', 0.5)]"]
    reports.write_candidates(df.limit(0), f"{path}-empty")
    assert [r.line for r in reports.read_lines(spark, f"{path}-empty").collect()] == [reports.CANDIDATE_HEADER]


def test_csv_keeps_quotes_breaks_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, 'a "q", b\nc'), (2, None), (3, ""), (4, " x "), (5, "back\\slash")], "i INT, t STRING"
    )
    path = scratch_path(spark, "csv")
    csv_files.write_csv(df, path)
    assert sorted(csv_files.read_csv(spark, path, df.schema).collect()) == sorted(df.collect())


@pytest.mark.parametrize("double_encoded", [False, True])
def test_json_documents(spark, double_encoded):
    schema = json_docs.SCHEMAS["users"]
    df = spark.createDataFrame(
        [("b1", [Row(user_email='x"y\\z@é.org'), Row(user_email=None)]), ("b2", [])], schema
    )
    path = scratch_path(spark, "json")
    json_docs.write_documents(df, path, double_encoded)
    got = json_docs.read_documents(spark, path, "users", double_encoded)
    assert sorted(got.collect()) == sorted(df.collect())
    with pytest.raises(KeyError):
        json_docs.read_documents(spark, path, "unknown")


def test_long_lists_are_split_into_documents(spark):
    row = dict(
        query_id="q", duplicate_of=None, query_severity="1", query_manager="m", query_engineer="e",
        is_duplicate=False, description="d", key_feature="k", key_word=["w"], key_phrase=["p"],
    )
    df = spark.createDataFrame(
        [Row(**row, related_id=f"r{i}", distance=float(i)) for i in range(50)],
        "query_id STRING, duplicate_of STRING, query_severity STRING, query_manager STRING,"
        "query_engineer STRING, is_duplicate BOOLEAN, description STRING, key_feature STRING,"
        "key_word ARRAY<STRING>, key_phrase ARRAY<STRING>, related_id STRING, distance DOUBLE",
    )
    docs = related.nested_report(df, page_rows=10).collect()
    docs.sort(key=lambda d: d.page)
    assert [len(d.list_of_rel_bugs) for d in docs] == [10] * 5
    assert [i.related_id for d in docs for i in d.list_of_rel_bugs] == [f"r{i}" for i in range(50)]
    assert docs[0].list_of_rel_bugs[0].bug_distance.count(".") == 1


def test_unknown_ids_are_reported(spark):
    records = spark.createDataFrame([("a",), ("b",)], "record_id STRING")
    queries = spark.createDataFrame([("a",), ("z",)], "record_id STRING")
    assert [r.record_id for r in rows.known_ids(queries, records).collect()] == ["a"]
    assert [r.record_id for r in rows.unknown_ids(queries, records).collect()] == ["z"]


def test_words_mode_skips_values_that_set_nothing(spark, capsys):
    known = F.array(F.lit("red"), F.lit("blue one"), F.lit("two"))
    values = ["red", "blue one", " two red ", "x", "", None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    coded = rows.select("i", cat.multi_hot(F.col("v"), known, "words").alias("hot"))
    got = [r.hot for r in coded.orderBy("i").collect()]
    assert got == [[1, 0, 0], [0, 0, 0], [1, 0, 1], [0, 0, 0], [0, 0, 0], [0, 0, 0]]
    coded.explain()
    assert "arrays_overlap" in capsys.readouterr().out


def test_frequent_words_settle_keywords_and_the_rest_is_counted_in_full(spark, monkeypatch):
    import random

    rng = random.Random(7)
    words = [f"w{i:02d}" for i in range(60)]
    lists = [[words[int(rng.random() ** 3 * 60)] for _ in range(rng.randrange(0, 30))] for _ in range(80)]
    docs = token_frame(spark, [(0, t) for t in lists])
    keywords = spark.createDataFrame([(w,) for w in words], "keyword STRING")
    monkeypatch.setattr(voc, "FREQUENT", 50)
    monkeypatch.setattr(voc, "_TOKENS", 40)
    got = collections.defaultdict(list)
    for r in voc.cooccurring_words(docs, keywords).orderBy("keyword", "rank").collect():
        got[r.keyword].append((r.word, r.n))
    for word in words:
        together = collections.Counter(w for t in lists if word in t for w in t)
        assert got[word] == sorted(together.items(), key=lambda x: (-x[1], x[0]))[:5]


def test_records_that_share_an_id_share_their_keywords(spark):
    docs = spark.createDataFrame(
        [("a", ["k", "x"]), ("a", ["y"]), ("b", ["k", "z"]), (None, ["k"])], "record_id STRING, tokens ARRAY<STRING>"
    )
    keywords = spark.createDataFrame([("k",)], "keyword STRING")
    got = {r.word: r.n for r in voc.cooccurring_words(docs, keywords).collect()}
    assert got == {"k": 2, "x": 1, "y": 1, "z": 1}
    scored = sorted(map(tuple, voc.scored_records(docs, keywords).select("record_id", "score").collect()))
    assert scored == [("a", 1)] * 2 + [("a", 2)] * 2 + [("b", 2)]


def test_scored_records_shuffle_no_tokens(spark):
    docs = token_frame(spark, [(0, ["a", "b", "c", "k", "d"]), (0, ["k"])])
    words = spark.createDataFrame([("k", ["k", "a"])], "keyword STRING, words ARRAY<STRING>")
    scored = voc.scored_records(docs, words, words)
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.score, r.phrase) for r in scored.collect()) == [(1, "k"), (2, "b c k d")]
