"""Odd ids, names and texts in the operators on documents and pages, and in the pipeline."""

import datetime
import math
import os
import re
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kindred.llm import decontaminate, lm, mixing, shards, urls
from kindred.llm.common import free_name, kept_names
from kindred.llm.lm import fit, score

SF = "/root/testdata/sf0.001"


def test_names():
    assert free_name("a", ["a", "A_", "b"]) == "a__" and free_name("c", ["a"]) == "c"
    assert kept_names(["size", "size_", "x"], ["size", "shard"]) == ["size__", "size_", "x"]


def test_missing_model_files_raise(spark):
    docs = spark.createDataFrame([("a b c a b",), ("c b a",)], "text string")
    model = fit(docs)
    texts = docs.select(F.lit(1).alias("doc_id"), F.col("text").cast("binary").alias("text"))
    assert score(texts, model).count() == 2
    word = next(f for f in sorted(os.listdir(model.folder)) if f.startswith("bigram-count-"))
    gone = lm.Model(**{**model.__dict__, "folder": model.folder + "-elsewhere"})
    with pytest.raises(Exception, match="No such file"):
        score(texts, gone).collect()
    os.remove(f"{model.folder}/{word}")
    with pytest.raises(Exception, match="No such file"):
        score(texts, model).collect()


def test_runs_of_ranges():
    import numpy as np

    where = np.array([2, 2, 5, 9, 9, 9], np.uint64)
    assert lm._runs(where) == [(2, 0, 2), (5, 2, 3), (9, 3, 6)] and lm._runs(where[:0]) == []


@pytest.mark.parametrize(
    "kind, ids",
    [
        ("smallint", [1, 2]),
        ("decimal(10,2)", [Decimal("1.50"), Decimal("2.00")]),
        ("date", [datetime.date(2024, 1, 2), datetime.date(2024, 1, 3)]),
        ("binary", [b"a", b"b"]),
        ("string", ["a", None]),
    ],
)
def test_item_ids_of_any_type(spark, kind, ids):
    docs = spark.createDataFrame([(1, "Oh yes, of course"), (2, "my eyes"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(ids[0], "yes"), (ids[1], "nothing of this")], f"item_id {kind}, text string")
    rows = [(r.doc_id, bytes(r.item_id) if kind == "binary" else r.item_id) for r in decontaminate.contaminated(docs, items).collect()]
    assert rows == [(1, ids[0])]
    assert sorted(r.doc_id for r in decontaminate.clean(docs, items).collect()) == [2, 3]


def test_short_items_stand_as_words():
    text = b"eyes yes, y42 42\xc3\xa9 42"
    assert decontaminate.standing(b"yes", text, 0, len(text)) == 8
    assert decontaminate.standing(b"42", text, 0, len(text)) == len(text)
    assert decontaminate.standing(b"42", text, 0, len(text) - 1) == -1
    assert decontaminate.standing(b"(x)", b"a(x)b", 0, 5) == 4


def test_path_words_in_any_case(spark):
    """Naive Bayes against counting by hand, with capital and other letters in paths."""
    rules = (urls.Rule("good.com", "/", "allow"), urls.Rule("bad.com", "/", "block"))
    rows = ["http://good.com/Garden/\u00c9t\u00e9", "http://good.com/garden", "http://bad.com/CASINO/1", "http://bad.com/casino/Bonus22"]
    rows += ["http://x.net/CaSiNo", "http://x.net/\u00e9t\u00e9/7", "http://y.org/", None]
    pages = spark.createDataFrame([(i, u, "good bad casino x net") for i, u in enumerate(rows)], "page_id long, url string, html string")
    got = {r.page_id: r for r in urls.judge(pages, rules).collect()}
    words = {w: n for w, n in Counter(re.findall("[a-z]{2,}", "good bad casino net" * 1)).items()}
    tokens, block, allow = [], Counter(), Counter()
    for url in rows:
        host, _, path = (url or "").partition("://")[2].partition("/")
        runs = [w for run in re.findall("[a-z]+", host) for w in urls.viterbi(run, dict.fromkeys(words, len(rows)), 4 * len(rows))]
        mine = ["h:" + w for w in runs]
        mine += ["p:" + ("#" + str(len(w)) if w.isdigit() else w) for w in re.findall(r"[^\W\d_]+|[0-9]+", path.lower())]
        tokens.append(mine)
    for i, label in enumerate((allow, allow, block, block)):
        label.update(tokens[i])
    size = len(set(block) | set(allow))
    for i in range(4, len(rows)):
        odds = math.log(3 / 3)
        for t in tokens[i]:
            odds += math.log((block[t] + 1) / (allow[t] + 1))
            odds += math.log((sum(allow.values()) + size + 1) / (sum(block.values()) + size + 1))
        assert got[i].log_odds == pytest.approx(odds, abs=1e-9)
        assert got[i].verdict == ("block" if odds > 0 else "allow") and got[i].rule is None
    assert got[4].verdict == "block" and got[5].path == "/\u00e9t\u00e9/7"


def test_open_tags_take_linear_time(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", "<" * 400_000 + "word")], "page_id long, url string, html string")
    assert urls.word_counts(pages, "html").collect() == [("word", 1)]


def test_kept_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "s", "a b", 5, 6), (2, "s", None, 7, 8)], "doc_id long, source string, text string, size int, size_ int")
    mixed = mixing.mix(docs, keep=("size", "size_"))
    assert mixed.columns[-2:] == ["size__", "size_"] and {tuple(r)[-2:] for r in mixed.collect()} == {(5, 6), (7, 8)}
    out = shards.shard(docs, keep=tuple(docs.columns))
    assert out.columns[:5] == ["doc_id", "source", "text", "size__", "size_"]
    assert {(r.size__, r.size_) for r in out.collect()} == {(5, 6), (7, 8)}


NAMES = ("its_row", "row", "copies", "size", "size_", "shard", "place", "key", "part", "label", "stats", "of", "kept")


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_any_names_and_empty_tables(spark, stage):
    run = dict(corpus_pipeline.STAGES)[stage]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    longest = spark.createDataFrame([(10**9, "word " * 200_000, "en", "web", 1)], docs.schema)
    docs = docs.limit(60).unionByName(longest)
    wide = docs
    for name in NAMES:
        wide = wide.withColumn(name, F.lit(name))
    plain, got = run(spark, docs, SF), run(spark, wide, SF)
    if stage != "sharding":
        assert got.columns == wide.columns and plain.columns == docs.columns
        assert all(r[n] == n for r in got.select(*NAMES).distinct().collect() for n in NAMES)
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in plain.collect())
    assert run(spark, wide.limit(0), SF).collect() == []
