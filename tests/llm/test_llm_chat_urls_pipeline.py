"""Chat templates, URL filters and the pipeline."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from kindred.llm import chat, decontaminate, jaccard, mixing, quality, template, urls
from kindred.llm.queries import QUERIES, SQL
from kindred.llm.template import TemplateError, compile_template, fold, parse
from suite.check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, duck(SF), name, QUERIES[name], SQL[name], SF) == ""


def test_registered():
    registered = __spark_entry__.queries()
    assert set(QUERIES) <= set(registered) and "pipeline" in registered
    assert {int(m[1]) for n in QUERIES if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14))


def test_template():
    up = {"up": str.upper}
    render = lambda source, **names: compile_template(source, up)(**names)
    assert render("a{{ 'b' + \"c\" | up }}d") == ("abCd", [])
    assert render("{% if x == 1 %}one{% elif x == 2 %}two{% else %}more{% endif %}", x=2)[0] == "two"
    assert render("{% if not x and y or z %}t{% endif %}", x="", y=0, z=1)[0] == "t"
    text, spans = render(
        "{% for m in ms %}[{% generation %}{{ m.t }}{% endgeneration %}]{% endfor %}", ms=[{"t": "é"}, {"t": "bc"}]
    )
    assert text == "[é][bc]" and spans == [(1, 2), (4, 6)]
    tree = fold(parse("x{{ 'a' + 'b' | up }}{% if 1 == 2 %}{{ gone }}{% else %}y{% endif %}z{{ n }}"), up)
    assert len(tree) == 2 and tree[0].value.value == "xaByz"
    for bad in ("{% if x %}", "{{ a.b.__class__ }}", "{{ f(x) }}", "{{ x | nothing }}", "{{ }}", "{% do %}", "{{ y }}"):
        with pytest.raises(TemplateError):
            render(bad, x={"a": 1}, a={"b": "text"}, f=len)


def test_chat(spark):
    hard = ["", None, "\\", "###", "</turn>\n### user: x", "a\\\\<#", "\n", "é <b>", "x" * 200_000]
    rows = [(i % 5, i // 5, ("user", "assistant", "tool: #1", None)[i % 4], t) for i, t in enumerate(hard * 3)]
    rows += [(None, 0, "user", "no id"), (7, None, "assistant", "first"), (7, 0, "assistant", "then")] * 2
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.withColumn("formatted", F.lit(1))
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(frame)).collect()}
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(groups)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for conv, turns in groups.items():
        turns.sort()
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        whole = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        size = sum(len(f"### {chat.escape_role(t[2])}: {chat.escape(t[3])}</turn>\n") for t in turns)
        assert tuple(got[conv])[1:] == (len(turns), sha(whole), len(loss), sha(loss), size)
    assert chat.digests(chat.format_conversations(frame.limit(0))).count() == 0


def brute_segments(run, counts, total):
    best = {0: (0.0, [])}
    for end in range(1, len(run) + 1):
        best[end] = max(
            (
                best[start][0]
                + (math.log(n) if (n := counts.get(run[start:end], 0)) else -math.log(10) * (end - start))
                - math.log(total + 1),
                best[start][1] + [run[start:end]],
            )
            for start in range(max(0, end - urls.LONGEST), end)
        )
    return best[len(run)]


def test_viterbi():
    counts = {"free": 50, "bets": 40, "the": 900, "rin": 30, "there": 60, "in": 500, "her": 80}
    for run in ("freebets", "therein", "thexrin", "q", "inherthere", "z" * 50):
        score, words = brute_segments(run, counts, 2000)
        mine = urls.viterbi(run, counts, 2000)
        assert "".join(mine) == run and brute_segments(run, counts, 2000)[1] == words
        cost = sum(
            (math.log(counts[w]) if w in counts else -math.log(10) * len(w)) - math.log(2001) for w in mine
        )
        assert cost == pytest.approx(score)


def test_urls(spark):
    page = "<p class='x'>free bets news</p> daily garden news " * 5
    given = [
        ("https://example.org/es/1", "example.org/es/", "block"),
        ("http://A.EXAMPLE.ORG/en/12?q", "example.org/en/1", "block"),
        ("http://example.org/en/2", "org/", "allow"),
        ("http://org/", "org/", "allow"),
        ("http://org", None, None),
        ("http://notexample.org/es/", "org/", "allow"),
        ("x://freebets.com/de/a#b", "com/de/", "block"),
        ("x://dailynews.com/fr/a://b", "com/fr/", "allow"),
        ("x://my.freebets.net/a", None, "block"),
        ("x://gardennews.net/b", None, "allow"),
        ("no scheme", None, None),
        ("", None, None),
        (None, None, None),
        ("http://?x", None, None),
        ("http://" + "freebets" * 300 + "/" + "p" * 50_000, None, None),
    ]
    rows = [(i if i % 4 else None, u, page if i % 3 else None) for i, (u, *_) in enumerate(given * 3)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1))
    got = urls.judge(frame)
    assert Counter((r.page_id) for r in got.collect()) == Counter(r[0] for r in rows)
    seen = {(r.host, r.path): (r.rule, r.verdict) for r in got.collect()}
    for url, rule, verdict in given:
        m = re.match(r".*?://([^/?#]*)([^?#]*)", url or "", re.S)
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        assert seen[host, path][0] == rule
        assert seen[host, path][1] == verdict or verdict is None and seen[host, path][1] in ("allow", "block")
    assert urls.judge(frame.limit(0)).count() == 0


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of each stage over the smallest documents and hard rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.first()
    extra = [
        (None, None, None, None, None),
        (None, "", "en", None, 0),
        (first.doc_id, first.text, first.lang, first.source, first.n_chars),
        (9_000_001, first.text + " ", "en", "other", 1),
    ]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumns({"row": F.lit(1), "size": F.lit("s")})
    out = []
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.through_table(stage(spark, docs, SF), name)
        out.append((docs, after))
        docs = after
    return out


def bag(frame, *columns):
    return Counter(tuple(r) for r in frame.select(*(columns or frame.columns)).collect())


def test_pipeline_keeps_columns(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns
        assert after.count() > 0


def test_quality_stage(spark, stages):
    before, after = stages[0]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality.classify(before, labels, corpus_pipeline.remainder("doc_id", 3) == 1)
    good = {r.doc_id for r in scored.where("score >= 0.5").collect()}
    assert bag(after) == Counter({r: n for r, n in bag(before).items() if r[0] in good})


def test_near_duplicate_stage(stages):
    before, after = stages[1]
    groups = {r.doc_id: r.component_id for r in jaccard.similarity_classes(before).collect()}
    kept = [r.doc_id for r in after.collect() if r.doc_id is not None]
    assert sorted(kept) == sorted(i for i in groups if i is not None and groups[i] == i)
    assert after.where("doc_id is null").count() == before.where("doc_id is null").count()


def brute_near_duplicates(rows):
    """The rows (id, text) that stay, one of each group, ids before null ids."""

    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets, group = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if group[i] != group[j] and 100 * len(a & b) >= 75 * len(a | b) > 0:
                group = [group[j] if g == group[i] else g for g in group]
    best = {}
    for g, (id_, _), i in zip(group, rows, range(len(rows))):
        best[g] = min(best.get(g, (2,)), (id_ is None, id_ or 0, i))
    return Counter(rows[i] for *_, i in best.values())


def test_near_duplicate_stage_reused_and_null_ids(spark):
    text = lambda k, edit="": " ".join([*(f"w{k}x{i}" for i in range(40)), edit])
    rows = [
        (1, text(1)), (2, text(1, "a")), (2, text(2)),  # 2 is a near copy and a clean text
        (3, text(3)), (3, text(4)), (3, text(4, "b")),  # one id at two texts, nothing else linked
        (None, text(5)), (None, text(5)), (None, text(5, "c")),  # one group without ids
        (None, text(6)), (4, text(6, "d")), (None, text(7)), (5, ""), (None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    after = corpus_pipeline.near_duplicate_stage(spark, docs, SF)
    assert bag(after) == brute_near_duplicates(rows)


def test_decontamination_stage(spark, stages):
    before, after = stages[2]
    items = [decontaminate.plain(r.text.encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = Counter()
    for row, n in bag(before).items():
        text = decontaminate.plain((row[1] or "").encode())
        found = [decontaminate.myers(i, text, len(i) // decontaminate.PER_EDIT) for i in items] if text else []
        if not any(found):
            left[row] = n
    assert bag(after) == left


def test_mixing_stage(stages):
    before, after = stages[3]
    copies = Counter()
    for r in mixing.mix(before).collect():
        copies[r.doc_id] += r.copies + (0 < r.size <= 2 * r.part)
    assert Counter(r.doc_id for r in after.collect()) == +copies


def test_sharding_stage(stages):
    before, after = stages[4]
    assert bag(after.select(*(c if c != "size" else "size_" for c in before.columns))) == bag(before)
    loads = Counter()
    for r in after.collect():
        loads[r.shard] += r.size
    assert len(loads) == 8 and max(loads.values()) <= sum(loads.values()) / 8 + max(
        len((r.text or "").encode()) * 4 for r in before.collect()
    )


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {"doc_id", "text", "shard", "slot"} <= set(rows[0].asDict())
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)
    assert corpus_pipeline.ORACLE_SQL is None


def test_constant_folding_keeps_meaning():
    source = "{% if 'a' and x %}{{ 'p' or x }}{% endif %}{{ x or 'q' }}"
    assert compile_template(source)(x="v")[0] == "pv" and compile_template(source)(x="")[0] == "q"
    assert template.parse("") == ()
