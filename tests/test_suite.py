import pytest

from suite import QUERIES, SQL
from suite.check import compare, duck

SMALL = "/root/testdata/sf0.001"
# The cheaper queries; ``python -m suite.check`` runs all of them.
CHECKED = """
euclid_pairs cosine_eps cosine_text knn_top20 cluster_radius dup_decision nearest_centroid
silhouette calinski_harabasz standardize covariance csv_roundtrip null_fill message_concat
age_weeks known_id_gate mask_email tokenize denoise strip_html light_clean vocab_order
keyword_report rank_fusion candidate_lines multihot encode_new doc_embedding json_write
json_scan_log related_flat
""".split()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL[name], SMALL) == ""


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_jobs(spark):
    from pyspark.sql import functions as F

    from kindred.config import Config
    from kindred.plans import jobs
    from kindred.session import scratch_path
    from kindred.sources.artifacts import ArtifactStore
    from suite import views
    QUICK = Config(
        vector_size=16, word2vec_iterations=1, pca_components=10, kmeans_iterations=10, kmeans_inits=2
    )

    store = ArtifactStore(spark, scratch_path(spark, "jobs"))
    as_of = F.lit(views.AS_OF).cast("timestamp")
    records = views.records(spark, SMALL)
    jobs.fit(records, store, QUICK, as_of)
    assert store.table("tags").count() == records.count()

    ids = views.flagged(spark, SMALL).unionByName(
        views.new_records(spark, SMALL).select("record_id")
    )
    report, unknown = jobs.relate(ids, store, QUICK)
    report = store.save_table("report", report)
    assert unknown.count() == views.new_records(spark, SMALL).count()
    # Every query gets at least its nearest records, never itself.
    counts = report.groupBy("query_id").count()
    assert counts.count() == views.flagged(spark, SMALL).count()
    assert counts.agg(F.min("count")).first()[0] >= QUICK.neighbours
    assert report.where("query_id = related_id").count() == 0
    assert report.groupBy("query_id", "related_id").count().where("count > 1").count() == 0

    # Reports of several runs may be read later, in any order.
    fresh = views.new_records(spark, SMALL)
    some = jobs.score(fresh.limit(11), store, QUICK, as_of)
    scored = jobs.score(fresh, store, QUICK, as_of)
    assert some.select("query_id").distinct().count() == 11
    assert store.table("quality").count() == 1
    path = scratch_path(spark, "out")
    jobs.write_vocabulary(store, path)
    for name, table in (("keywords", "keyword_report"), ("candidates", "candidates")):
        assert spark.read.text(f"{path}/{name}").count() == store.table(table).count() + 1
    jobs.write_report(scored, path)
    documents = spark.read.json(f"{path}/json")
    assert documents.count() == views.new_records(spark, SMALL).count()


def test_lemmas_reach_the_fit(spark):
    """Two forms of a verb get one vector and one token."""
    from pyspark.sql import functions as F

    from kindred.config import TEXT_FIELDS, Config
    from kindred.plans import jobs
    from kindred.session import scratch_path
    from kindred.sources.artifacts import ArtifactStore

    rows = [
        {"record_id": f"r{i}", "headline": ("crashes", "crashed", "boots", "reboots")[i % 4]} for i in range(24)
    ]
    schema = "record_id STRING, headline STRING"
    records = spark.createDataFrame([(r["record_id"], r["headline"]) for r in rows], schema)
    for column in (*TEXT_FIELDS[1:], "component", "project", "product", "manager", "severity", "duplicate_of", "engineer"):
        records = records.withColumn(column, F.lit(None).cast("string"))
    records = records.withColumn("submitted_on", F.lit("2024-01-01").cast("timestamp"))
    lexicon = spark.createDataFrame([("crash",), ("boot",)], "token STRING")
    exceptions = spark.createDataFrame([("reboots", "boot")], "token STRING, lemma STRING")
    config = Config(vector_size=4, word2vec_iterations=1, pca_components=2, kmeans_inits=1, min_frequency=1)
    store = ArtifactStore(spark, scratch_path(spark, "lemmas"))
    jobs.fit(records, store, config, F.lit("2025-01-01").cast("timestamp"), lexicon, exceptions)
    words = {r.word for r in store.table("word_vectors").collect()}
    assert words == {"crash", "boot"}
    fields = {r.record_id: r.headline for r in store.table("field_vectors").collect()}
    assert fields["r0"] == fields["r1"] != fields["r2"] == fields["r3"]


def test_record_ids_are_never_cut(spark):
    from suite import views

    ids = spark.createDataFrame([(7,), (10_000_001,)], "doc_id LONG")
    assert [r[0] for r in ids.select(views.record_id()).collect()] == ["R0000007", "R10000001"]


def test_clusters_need_a_shared_folder():
    from types import SimpleNamespace

    from kindred.session import scratch_path

    def session(master):
        empty = SimpleNamespace(get=lambda *a: None)
        context = SimpleNamespace(master=master, getConf=lambda: empty)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None, set=lambda *a: None), sparkContext=context)

    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError):
            scratch_path(session(master), "x")
    for master in ("local", "local[*]", "local[8]"):
        assert scratch_path(session(master), "x")
