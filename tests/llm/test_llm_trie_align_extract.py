"""Conversation trie, tokenizer alignment and main texts of pages."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.llm import align, extract, layouts, trie

SF = "/root/testdata/sf0.001"
sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


def plain(rows):
    """Conversations as lists of (role, text), in the operator's order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
        out[conv].append((turn is not None, turn or 0, mark, role, text))
    return {c: [(t[3], t[4]) for t in sorted(turns)] for c, turns in out.items()}


def brute_rebuild(convs):
    out = {}
    for c, own in convs.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 9
        base = [] if c is None else convs.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])
        out[c] = base[:h] + own[h:]
    return out


def brute_trie(convs):
    """Nodes of a list of (id, turns)."""
    members = defaultdict(list)
    for c, turns in convs:
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append((c, len(turns)))
    least = {p: min((c for c, _ in m if c is not None), default=None) for p, m in members.items()}
    children, leaves, saved = Counter(), Counter(), Counter()
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    rows = []
    for p, m in members.items():
        ends = sorted(c for c, n in m if n == len(p) and c is not None)
        parent = least[p[:-1]] if p else None
        rows.append(
            (least[p], len(p), parent, len(m), children[p], leaves[p], saved[p], sha(",".join(map(str, ends))))
        )
    return sorted(rows, key=repr)


COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def got_trie(convs, block):
    frame = trie.trie(convs, block)
    assert frame.columns == COLUMNS
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def turns_frame(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("block", "seq", "key", "n"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame


def test_trie(spark):
    r = random.Random(3)
    texts = ["", None, "é", "yes", "no", "a" * 300]
    rows = []
    for c in range(60):
        length = r.choice((0, 1, 2, 2, 3, 5, 9, 12))
        rows += [(c, t, ("user", "assistant")[t % 2], r.choice(texts[:3])) for t in range(length)]
    rows += [(100 + c, t, "user", "same") for c in range(40) for t in range(4)]
    rows += [(-c, t, None, texts[t % 6]) for c in range(1, 8) for t in range(c)]
    rows += [(None, 0, "user", "no id"), (200, None, "user", "first"), (200, 0, "user", "then"), (200, 0, "user", "then")]
    rows += [(300, t, "user", str(t)) for t in range(300)] + [(301, t, "user", str(t)) for t in range(299)]
    sequences = trie.sequences(turns_frame(spark, rows))
    convs = plain(rows)
    assert {x.conv_id: len(x.seq) // 16 for x in sequences.collect()} == {c: len(t) for c, t in convs.items()}
    for block in (7, 60, 10**6):
        assert got_trie(sequences, block) == brute_trie(list(convs.items()))
    rebuilt = brute_rebuild(convs)
    assert any(not t for t in rebuilt.values()) and any(t != convs[c] for c, t in rebuilt.items())
    for block in (40, 10**6):
        assert got_trie(trie.rebuild(sequences), block) == brute_trie(list(rebuilt.items()))
    again = sequences.unionByName(sequences)
    assert got_trie(again, 50) == brute_trie([*convs.items()] * 2)


def test_trie_edges(spark):
    empty = trie.sequences(turns_frame(spark, []))
    assert trie.trie(trie.rebuild(empty)).collect() == []
    # Conversations that lose all their turns meet in the root.
    bare = spark.createDataFrame([(5, b"", b""), (3, b"", b"")], "conv_id long, seq binary, sizes binary")
    assert [tuple(x) for x in trie.trie(bare).collect()] == [(3, 0, None, 2, 0, 1, 0, sha("3,5"))]


def test_long_id_lists(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 3)
    ids = [(i, b"x" * 16, b"\0" * 8) for i in range(50)] + [(None, b"x" * 16, b"\0" * 8)]
    frame = spark.createDataFrame(ids, "conv_id long, seq binary, sizes binary")
    rows = {x.depth: x for x in trie.trie(frame, 5).collect()}
    assert rows[1].n_convs == 51 and rows[1].ends_sha256 == sha(",".join(map(str, range(50))))


def test_range_minimum():
    r = np.random.default_rng(1)
    for n in (1, 2, 7, 64, 100):
        values = r.integers(0, 4, n)
        table = trie.RangeMinimum(values)
        at, least = np.repeat(np.arange(n), 5), np.tile(np.arange(5), n)
        for i, d, j, k in zip(at, least, table.right(at, least), table.left(at, least)):
            assert (values[i + 1 : j + 1] >= d).all() and (j == n - 1 or values[j + 1] < d)
            assert (values[k + 1 : i + 1] >= d).all() and (k == 0 or values[k] < d)
        i, j = np.triu_indices(n)
        assert (table.least(i, j) == [values[a : b + 1].min() for a, b in zip(i, j)]).all()


# Tokenizers

HARD = [
    "", None, " ", "plain words here", "Ünïcödé ß straße", "漢字かな交じり文", "emoji 👩‍👩‍👧 ok", "a\x00b", "▁underline", "tab\tline\r\n  end ",
    "<s>special</s> <|endoftext|> <unk>", "x" * 5000, " " * 300, "don't they'll I'm 12345 3.14", "ｆｕｌｌ ﬁ", " \x85\xa0\x1c", "ab " * 2000,
    "Étion dans, çouelle un éonierç", "supercalifragilistic" * 5, "퟿",
]


def brute_alignment(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(f"{align.FOLDER}/byte_bpe_50k.json")
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=f"{align.FOLDER}/piece_bpe_32k.model")
    letters = align.byte_letters()
    rows, counts = [], Counter()
    for text in texts:
        links, groups, a, b = [], [], [], []
        if text:
            whole = (" " + text).encode()
            a = first.encode(" " + text, add_special_tokens=False).ids
            b = second.encode(text)
            x = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
            y = [second.id_to_piece(i) for i in b]
            y = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, y)]
            if b"".join(x) != whole or b"".join(y) != whole:
                a, b = [], []
            else:
                ends = [list(np.cumsum([len(t) for t in side])) for side in (x, y)]
                cuts = [0, *sorted(set(ends[0]) & set(ends[1]))]
                for low, high in zip(cuts, cuts[1:]):
                    sides = [[i for i, e in zip(ids, es) if low < e <= high] for ids, es in zip((a, b), ends)]
                    groups.append("|".join(",".join(map(str, s)) for s in sides))
                spans = [list(zip([0, *es], es, ids)) for es, ids in zip(ends, (a, b))]
                start = 0
                for l1, h1, i in spans[0]:
                    while spans[1][start][1] <= l1:
                        start += 1
                    k = start
                    while k < len(spans[1]) and spans[1][k][0] < h1:
                        links.append((i, spans[1][k][2]))
                        k += 1
        counts.update(links)
        rows.append((len(a), len(b), len(groups), links, sha(";".join(groups)) if a else ""))
    best = Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return [
        (na, nb, ng, len(ls), sum(counts[x] == best[x[1]] for x in ls), sum(counts[x] for x in ls), digest)
        for na, nb, ng, ls, digest in rows
    ]


def test_alignment(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(120).collect()
    texts = HARD + [d.text for d in docs] + ["plain words here", None]
    rows = [(i if i % 7 else i // 2, t) for i, t in enumerate(texts)] + [(None, "plain words here")]
    texts.append("plain words here")
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for name in ("chunk", "place", "total", "links", "groups"):
        frame = frame.withColumn(name, F.lit(1))
    expected = sorted(((i, *x) for (i, _), x in zip(rows, brute_alignment(texts))), key=repr)
    names = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    for chunk in (2000, align.CHUNK):
        got = align.alignment_report(frame, chunk=chunk)
        assert sorted(got.columns) == sorted(names)
        assert sorted((tuple(r) for r in got.select(*names).collect()), key=repr) == expected
    assert align.alignment_report(frame.limit(0)).collect() == []


def test_meet():
    r = random.Random(5)
    for _ in range(300):
        end = r.randint(1, 60)
        share = r.choice((0.1, 0.5, 0.95))
        a, b = ([e for e in range(1, end) if r.random() < share] + [end] for _ in range(2))
        if r.random() < 0.3:
            b = list(a)
        left, right = align.meet(a, b)
        spans = [list(zip([0, *x], x)) for x in (a, b)]
        links = [(i, j) for i, (p, q) in enumerate(spans[0]) for j, (s, t) in enumerate(spans[1]) if p < t and s < q]
        assert list(zip(left, right)) == links


def test_packed():
    r = np.random.default_rng(2)
    for top in (1, 200, 1 << 20, 1 << 40):
        values = r.integers(0, top, 500)
        assert (align.unpacked(align.packed(values)) == values).all()
    assert align.packed(np.empty(0, np.int64)) == b"" and len(align.unpacked(b"")) == 0


def test_both_byte_encoders_agree():
    bpe = align.ByteBpe(align.tokenizers().first)
    r = random.Random(9)
    settled = [chr(c) for c in range(0x250)] + list("‘’“”–—…  ")
    settled = [c for c in settled if not align._SETTLED.search(c)]
    for _ in range(300):
        text = "".join(r.choices(settled, k=40))
        assert bpe.encode(text).tolist() == bpe.exact.encode(text, add_special_tokens=False).ids


# Pages


@pytest.fixture(scope="module")
def model(spark):
    return extract.fit(layouts.labelled_pages(spark))


def test_potentials_are_frequencies(spark):
    page = "<div class='a b'><p data-label=1>One two three.</p><p>x</p></div>"
    model = extract.fit(spark.createDataFrame([(page,), (page,), (None,)], "html string"))
    # Per page: the page and the div are mixtures, one leaf and one paragraph of each kind.
    leaves = np.array([2, 2, 0])
    assert np.allclose(model.tags[True, "p"], np.log((leaves + 0.5) / (leaves + 30)))
    elements = np.array([2, 2, 4])
    assert np.allclose(model.names["a"], np.log((np.array([0, 0, 2]) + 0.5) / (elements + 1)))
    above = model.edges["p"]
    assert np.allclose(np.exp(above).sum(1), 1) and np.exp(above)[2, 0] == pytest.approx(np.exp(above)[2, 1])


def test_marginals_equal_enumeration(model):
    """Sum-product against the sum over all assignments."""
    pages = [
        "<div class=content><p>One is here. Two is there.</p><ul><li><a href=x>menu</a></ul></div>",
        "<nav><a>a</a></nav>text, and more.",
        "<div><div><div id=x>Some.</div></div></div>",
    ]
    chunk = extract.Chunk([extract.Page(p) for p in pages])
    got = extract.marginals(chunk, model)
    last = [i for i in range(chunk.n) if chunk.of[i] == 2]
    inert = last[1:3]
    assert [chunk.tags[i] for i in last] == ["#page"] + ["div"] * 4 and chunk.leaf[last[4]]

    def own(i):
        leaf, out = bool(chunk.leaf[i]), np.zeros(3)
        for (factor, of_leaf), table in model.factors.items():
            if of_leaf == leaf and i not in inert:
                out += table[min(chunk.factors[factor][i], len(table) - 1)]
        if i not in inert:
            out += model.tags.get((leaf, chunk.tags[i]), 0)
        for at, word in chunk.names:
            if at == i and word in model.names:
                out += model.names[word]
        return out

    for tree in range(3):
        nodes = [i for i in range(chunk.n) if chunk.of[i] == tree]
        total = np.zeros((chunk.n, 3))
        for code in range(3 ** len(nodes)):
            states = {i: code // 3**k % 3 for k, i in enumerate(nodes)}
            if any(chunk.leaf[i] and states[i] == extract.MIXED for i in nodes):
                continue
            weight = 0.0
            for i in nodes:
                tag = "#text" if chunk.leaf[i] else chunk.tags[i]
                edge = model.root if chunk.parent[i] < 0 else model.edges.get(tag, model.edge)[states[chunk.parent[i]]]
                if chunk.parent[i] in inert:
                    edge = np.where(np.arange(3) == states[chunk.parent[i]], 0, -np.inf)
                weight += own(i)[states[i]] + edge[states[i]]
            for i in nodes:
                total[i, states[i]] += np.exp(weight)
        for i in nodes:
            assert np.allclose(got[i], total[i] / total[i].sum(), atol=1e-9)


def test_labelled_pages_held_out(model):
    pages = [layouts._Writer(10**9 + i).page() for i in range(400)]
    chunk = extract.Chunk([extract.Page(p) for p in pages])
    found = extract.marginals(chunk, model)[:, extract.CONTENT] >= 0.5
    leaf = chunk.leaf
    right = (found == chunk.label)[leaf].mean()
    assert right > 0.985, right


def article(html):
    """The text of a page of the test data, whose articles hold only headings, paragraphs, b and br."""
    inner = re.search(r"<article>(.*?)(?:</article>|$)", html or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", inner[1]) if inner else []
    blocks = [" ".join(unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_pages(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = pages.collect()
    got = Counter(map(tuple, extract.extract(pages, model).collect()))
    assert got == Counter((r.page_id, r.url, article(r.html), len(article(r.html))) for r in rows)


LONG = "The text, at last, which says what the page is for. It goes on for some more words than the rest does."


def test_odd_pages(spark, model):
    pages = [
        None,
        "",
        "plain text only, no tags at all",
        "<p>Just one paragraph of text &amp; nothing&nbsp;else,\n\t here.",
        "<article><p>One is <b>bold</b> and <a href='a>b'>linked</a>, here.<script>if (a < b) '</p>'</script><p>Two<br>lines.</article><!-- <p>no",
        f"<div id=cookies><p>We use cookies. Please accept them.</p></div><div class=post><p>{LONG}</p><p>{LONG}</p>"
        "<div class=advert>Buy this now.</div></div><div class=comments><p>Nice text, I think. Thanks.</p></div>",
        "<article><p>" + "word word, word. " * 100_000 + "</article>",
        "<article><p>Kept, it is.</p>" + "<div>" * 3000 + "<p>deep text is here, too.",
    ]
    frame = spark.createDataFrame([(i // 2 or None, "u", p, 1, "x") for i, p in enumerate(pages)], "page_id long, url string, html string, n_chars int, text string")
    got = extract.extract(frame, model)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    texts = sorted(r.text for r in got.collect())
    assert texts == sorted([
        "",
        "",
        pages[2],
        "Just one paragraph of text & nothing else, here.",
        "One is bold and linked, here.\nTwo lines.",
        f"{LONG}\n{LONG}",
        ("word word, word. " * 100_000).strip(),
        "Kept, it is.\ndeep text is here, too.",
    ])
    assert extract.extract(frame.limit(0), model).collect() == []
    assert extract.extract(frame, model, keep=("page_id",)).columns == ["page_id", "text", "n_chars"]


def test_unending_markup(model):
    """Long broken pages take time in proportion to their length."""
    for page in ("<" * 300_000, "<b>" * 50_000 + "<li>x</li>" * 20_000, "<div " + "class='a \"" * 50_000, "</p><div>" * 50_000, "<a b='\"'>" * 30_000):
        assert len(extract.main_texts([page], model)) == 1
