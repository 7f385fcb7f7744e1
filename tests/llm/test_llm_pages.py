"""Operators on vectors, pages and conversations, and the registered queries."""

import random
import time

import numpy as np
import pytest
from compare import connect, duck_rows, spark_rows
from pyspark.sql import functions as F

from salesloom.llm import chat, html, urls, vectors
from salesloom.llm.queries import ORACLE, QUERIES

BASE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    got, want = spark_rows(QUERIES[name](spark, BASE)), duck_rows(connect(BASE), ORACLE[name])
    assert got == want


def test_entry_registers_all():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {"pipeline", *QUERIES} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def own_links(rows, threshold=0.9):
    def usable(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = [np.array(v) / np.linalg.norm(np.array(v)) if usable(v) else None for _, v in rows]
    n = len(rows)
    links, label = [0] * n, list(range(n))
    pairs = [
        (a, b)
        for a in range(n)
        for b in range(a)
        if unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold
    ]
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    ids = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            ids[c] = min(ids.get(c, i), i)
    return sorted(((i, k, ids.get(c)) for (i, _), k, c in zip(rows, links, label)), key=repr)


@pytest.mark.parametrize("tile", [2048, 7])
def test_near_vectors_match_brute_force(spark, tile):
    rng = np.random.default_rng(3)
    heads = rng.normal(size=(9, 12))
    rows = [(i, (heads[i % 9] + rng.normal(size=12) * rng.choice([0.05, 0.35])).tolist()) for i in range(90)]
    rows += [(200 + i, rows[4][1]) for i in range(5)] + [(300, [10 * x for x in rows[4][1]])]
    rows += [(400, None), (401, [0.0] * 12), (402, [float("nan")] + [1.0] * 11), (403, [float("inf")] * 12)]
    rows += [(404, [None] + [1.0] * 11), (405, []), (406, [1.0, 2.0]), (407, [1.0, 2.1]), (None, rows[4][1]), rows[0]]
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "vec_id bigint, embedding array<double>, id int, node int")
    got = [tuple(r) for r in vectors.near_vectors(df, tile=tile).collect()]
    assert sorted(got, key=repr) == own_links(rows)
    assert vectors.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("same", [True, False])
def test_tiles_lose_no_pair(same):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(70, 40)) + 2 * rng.normal(size=(70, 1))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x if same else x[::-1].copy()
    got = {(int(i), int(j)) for a, b in vectors.linked_pairs(x, y, 0.6, same, rows=16) for i, j in zip(a, b)}
    want = {(i, j) for i in range(70) for j in range(70) if x[i] @ y[j] >= 0.6 and (i < j or not same)}
    assert got == want


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home of all the things that we have</a></li></ul></nav>
<div class="cookie-notice">We use the cookies that you have</div><div class=ad>Buy it now and for the rest of it</div>
%s<aside>About the man who wrote this and that</aside><section id="comments"><p>I think that this is the best of it
and it was as good as it is.</p></section><form><label>Your name and the rest</label><input></form>
<footer>&copy; 2020 by us all</footer><script>var a = "</p><p>no";</script></body></html>"""
LONG = "The cat is on the mat and it was in the house with all of us when we came. " * 4


@pytest.mark.parametrize("holder", ["article", "main", "div"])
def test_article_alone_is_left(holder):
    body = f"<{holder}><h2>The&nbsp;title &amp; more</h2><p>{LONG}<p>Short\n one.<!-- no --><p>a &lt;b&gt; {LONG}</{holder}>"
    text = " ".join(LONG.split())
    assert html.main_text(PAGE % body) == f"The title & more\n{text}\nShort one.\na <b> {text}"


def test_odd_pages(spark):
    rows = [(1, None), (2, ""), (3, "<p>"), (4, "<article>" + "<p>word" * 5000), (5, "<article><p>x<script>never closed"), (6, PAGE % ""), (6, PAGE % "")]
    df = spark.createDataFrame([(*r, "old") for r in rows], "page_id bigint, html string, text string")
    got = html.extract_pages(df)
    assert got.columns == ["page_id", "text"]
    found = {r.page_id: r.text for r in got.collect()}
    assert found[4] == "\n".join(["word"] * 5000)
    assert [found[i] for i in (1, 2, 3, 5, 6)] == ["", "", "", "x", ""]
    assert got.count() == 7 and html.extract_pages(df.limit(0)).count() == 0


ADVERT = (
    "Buy cheap running shoes today! Fifty percent discount, free worldwide shipping, five star customer "
    "support, limited offer, order online before midnight, top brands, guaranteed lowest prices!"
)
WHOLE = " ".join(LONG.split())


def test_text_outside_an_article_is_kept():
    card = "<article><h3>Other news</h3><p>This is what it is about.</p></article>"
    for page in (f"<div><p>{LONG}</p><p>{LONG}</p></div>{card}{card}", f"{card}<div><p>{LONG}</p><p>{LONG}</p></div>"):
        assert html.main_text(f"<body>{page}</body>").split("\n").count(WHOLE) == 2


def test_plain_advert_in_an_article_goes():
    body = f"<article><h1>The title</h1><p>{LONG}</p><div>{ADVERT}</div><p>Short.</p><p>{LONG}</p></article>"
    assert html.main_text(f"<body>{body}</body>") == f"The title\n{WHOLE}\nShort.\n{WHOLE}"
    # Nothing else on the page has stop words: there is no telling, and the article counts.
    assert html.main_text(f"<article><p>{ADVERT}</p></article>") == ADVERT


def test_links_in_an_article():
    linked = f'<a href="/x">{LONG[:60]}</a> {LONG[60:125]}'
    more = "".join(f'<li><a href="/{i}">This is one of the other stories</a></li>' for i in range(4))
    body = f"<article><p>{LONG}</p><p>{linked}</p><p>{LONG}</p><ul>{more}</ul></article>"
    assert html.main_text(body) == f"{WHOLE}\n{' '.join(LONG[:125].split())}\n{WHOLE}"


@pytest.mark.parametrize(
    "page",
    [
        "<div class='layout has-sidebar'>{}</div>",
        "<main class='content no-sidebar'>{}</main>",
        "<article class='entry has-share'>{}</article>",
        "<article class='related'>{}</article>",
        "<div class='social'><article>{}</article></div>",
        "<div class='search'><div>{}</div></div><p>Short.</p>",
        "<head><title>T</title><meta charset=utf-8><body><article>{}</article>",
        "<head><meta charset=utf-8><div><p>{}</div>",
        "<html><head><title>T</title><script>'<div>'</script><h1></h1><main>{}</main>",
    ],
)
def test_layout_names_and_open_heads_lose_nothing(page):
    assert WHOLE in html.main_text(page.format(f"<p>{LONG}</p><p>{LONG}</p>")).split("\n")


def test_names_set_aside_as_roles_only():
    aside = ["ad", "x ad-slot", "cookie_notice", "sidebar-left", "site-footer", "related-posts", "ad2", "post-comments"]
    stays = ["has-share", "no-ads", "search-algorithms", "read-more", "adaptive", "with-sidebar", "menu-planning"]
    page = "<div class='{}'><p>{}</p></div><article><p>{}</p></article>"
    other = WHOLE.replace("cat", "dog")
    assert all(html.main_text(page.format(n, other, LONG)) == WHOLE for n in aside)
    assert all(html.main_text(page.format(n, other, LONG)) == f"{other}\n{WHOLE}" for n in stays)
    assert html.main_text(f"<article><h2 id='search'>Search</h2><p>{LONG}</p></article>") == f"Search\n{WHOLE}"


@pytest.mark.parametrize(
    "unit",
    ["<script ", "<a ", '<a href="', "<a x='>", "<a b=\"'>", "<!", "<!--", "<![CDATA[", "<p =", "</script ", "<title", "<meta "],
)
def test_unclosed_markup_is_read_once(unit):
    start = time.time()
    assert html.main_text(unit * (1_000_000 // len(unit))) == ""
    assert time.time() - start < 2


def test_deep_pages_are_read_once():
    start = time.time()
    for page in ("<div>" * 20000 + "</p>" * 20000, "<h1>x" * 20000, "<article>x</article>" * 10000):
        html.main_text(page)
    html.main_text('<div class="' + "top-" * 5000 + 'z">x</div><p class="ad' + "-comment-list" * 5000 + '-z">y')
    assert time.time() - start < 20


def test_scanner_on_odd_tags():
    text = f"<p>{LONG}</p>"
    for page in (
        f"<div title='a > b'>{text}</div>",
        f'<div title="5" tall">{text}</div>',
        f"<div title=it's>{text}</div>",
        f"<!-- {ADVERT} --><![CDATA[ <p>{ADVERT} ]]>{text}<!-- open {ADVERT}",
        f"{text}<svg/><script src=x>{ADVERT}</SCRIPT >",
        f"{text}<div class='never closed",
    ):
        assert html.main_text(page) == WHOLE
    assert html.main_text(f'<p>2 < 3 and 4 <5. {LONG}<a href="x>') == f"2 < 3 and 4 <5. {WHOLE}"
    tags = [(t.name, t.closes, t.attributes) for t in html.markup("<P A=1></p ><br/><title>x</title><x-y z>")]
    assert tags == [("p", False, " A=1"), ("p", True, " "), ("br", False, "/"), ("", False, ""), ("x-y", False, " z")]


def test_second_pass_inherits():
    good, bad, near, short = html.GOOD, html.BAD, html.NEAR, html.SHORT
    assert html.settle([good, short, good, short, bad, near, bad], [1] * 7) == [True, True, True, False, False, False, False]
    assert html.settle([bad, short, good, short], [1, 2, 2, 2]) == [False, True, True, True]
    assert html.settle([near, short], [1, 1]) == [True, False]
    assert html.settle([bad, short, near, good], [1, 2, 3, 4]) == [False, False, True, True]


def test_chat_roundtrip_of_odd_texts(spark):
    rng = random.Random(7)
    bits = ["<|", "|>", "<", "|", "[", "INST]", "/INST]", "s>", "/s>", "\\", "turn", "body", "end", "\n", "é", "<|end|>", "$1", "<|image:0|>"]
    rows = [(i // 5, i % 5, rng.choice(["user", "assistant", "<|turn|>", None]), "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))) for i in range(400)]
    rows += [(0, 0, "user", "again"), (0, 0, "user", "again"), (None, None, "assistant", None), (None, 1, "user", "x")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id bigint, turn bigint, role string, text string, f string")
    done = chat.format_conversations(df.withColumn("parts", chat.text_parts(F.col("text"))))
    back = done.select("conv_id", chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("l"), "formatted")
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        want.setdefault(c, []).append((role or "", text or ""))
    found = {r.conv_id: r for r in back.collect()}
    assert found.keys() == want.keys()
    for c, turns in want.items():
        assert sorted(tuple(t) for t in found[c].t) == sorted(turns)
        assert found[c].l == "".join(t.text for t in found[c].t if t.role == "assistant")
        assert found[c].formatted.count(chat.TURN) == len(turns)
    assert chat.format_conversations(df.withColumn("parts", chat.text_parts(F.col("text"))).limit(0)).count() == 0


def test_typed_parts_become_placeholders(spark):
    parts = [("text", "a <", None, None), ("text", "|turn|>", None, None), ("image", None, "i.png", None), ("audio", None, None, 7), (None, "b", None, None), ("my kind", None, "r", None), None]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", None), (1, 2, "assistant", [("document", None, "d", 3)])]
    df = spark.createDataFrame(rows, f"conv_id bigint, turn bigint, role string, parts {chat.PARTS}")
    row = chat.format_conversations(df).first()
    assert row.formatted == (
        r"<|turn|>user<|body|>a <\|turn|><|image:0|><|audio:1|>b<|my_kind:2|><|end|>"
        "<|turn|>assistant<|body|><|end|><|turn|>assistant<|body|><|document:0|><|end|>"
    )
    assert [tuple(a) for a in row.attachments] == [(0, 0, "image", "i.png", 256), (0, 1, "audio", None, 7), (0, 2, "my kind", "r", 1), (2, 0, "document", "d", 3)]
    assert row.expanded_tokens == 256 + 7 + 1 + 3


def test_long_conversations_and_texts(spark):
    turns = [(1, i, ("user", "assistant")[i % 2], f"é<|end|>{i}" * (1 + i % 3)) for i in range(16000)]
    turns += [(2, 0, "user", "x" * 255 + "<|" * 300_000), (2, 1, "assistant", "y<|end|>é" * 100_000), (3, 0, "assistant", "")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    start = time.time()
    done = chat.format_conversations(df.withColumn("parts", chat.text_parts(F.col("text"))))
    got = {r.conv_id: r.l for r in done.select("conv_id", chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("l")).collect()}
    assert time.time() - start < 15
    assert got == {c: "".join(t[3] for t in turns if t[0] == c and t[2] == "assistant") for c in (1, 2, 3)}


def test_chat_stays_native(spark):
    assert "Python" not in QUERIES["op9_chat"](spark, BASE)._jdf.queryExecution().toString()


def test_url_decisions_reach_aliases(spark):
    link = '<link rel="canonical" href="%s">'
    rows = [
        (1, "http://a.org/x", link % "http://www.example.com/en/7"),
        (2, "http://b.org/y?utm_source=f", link % "https://s.example.com/en/1"),
        (3, "https://b.org/y#q", None),
        (4, "http://c.org/z", '<META content="0; url=https://b.org/y" http-equiv=refresh>'),
        (5, None, ""),
        (6, "nothing", "x"),
        (7, "HTTP://WWW.Example.COM/en/1?a", ""),
        (8, "http://a.net/es/", f"<!-- {link % 'http://www.example.com/en/'} --><script>{link % 'http://q/'}</script>"),
        (9, "http://d.org", link % "/k"),
        (10, "http://d.org/k", ""),
        (11, "http://e.org/1", link % "http://www.example.com/en/a"),
        (12, "http://e.org/2", link % "http://e.org/1"),
        (13, "http://e.org/2", link % "http://t.example.com/en/b"),
        (None, "http://x.com:80/", ""),
        (1, "http://a.org/x", None),
    ]
    rules = spark.createDataFrame(
        [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block")],
        "host string, path string, verdict string",
    )
    pages = spark.createDataFrame([(*r, "old") for r in rows], "page_id bigint, url string, html string, rule string")
    got = urls.judge(pages, rules).collect()
    assert len(got) == len(rows)
    found = {r.page_id: r for r in got}
    verdicts = {i: found[i].verdict for i in range(1, 14)}
    blocked = {2, 3, 4, 8}
    assert verdicts == {i: "block" if i in blocked else "allow" for i in range(1, 14)}
    assert (found[7].host, found[7].path, found[7].rule) == ("www.example.com", "/en/1", "www.example.com/en/")
    assert (found[5].host, found[5].path, found[6].host, found[None].host, found[None].rule) == ("", "", "", "x.com:80", None)
    redirect = spark.createDataFrame([("http://d.org/k", "http://n.net/es/1"), (None, "x")], "source string, target string")
    passed = {r.page_id: r.verdict for r in urls.judge(pages, rules, links=redirect).collect()}
    assert passed[9] == passed[10] == "block"
    assert urls.judge(pages, rules, links=redirect, default="block").where("verdict = 'allow' AND rule IS NULL").count() == 5
    assert urls.judge(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in urls.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_long_hosts_and_unclosed_tags(spark):
    host = "a." * 50_000 + "example.com"
    odd = [u * 40_000 for u in ("<script ", "<link ", "<meta rel=", "<!-- ", "<link rel=")]
    rows = [(1, f"http://{host}/en/", ""), *((i, "http://x.net/es/", h) for i, h in enumerate(odd, 2))]
    rules = spark.createDataFrame([("example.com", "/en/", "block"), ("net", "/es/", "block")], "host string, path string, verdict string")
    start = time.time()
    got = urls.judge(spark.createDataFrame(rows, "page_id bigint, url string, html string"), rules).collect()
    assert time.time() - start < 20
    assert [(r.rule, r.verdict) for r in sorted(got)] == [("example.com/en/", "block"), *[("net/es/", "block")] * 5]


def test_pipeline_keeps_what_it_should(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    columns = docs.columns
    odd = docs.limit(1).selectExpr("CAST(-5 AS BIGINT) AS doc_id", "CAST(NULL AS STRING) AS text", "lang", "source", "n_chars")
    docs = docs.unionByName(odd).withColumn("copies", F.lit(1))
    left = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, BASE)
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert ids <= left
        if name != "packing":
            assert out.columns == [*columns, "copies"]
            docs = spark.createDataFrame(out.collect(), out.schema)
            left = ids
        else:
            assert ids == left
        assert stage(spark, docs.limit(0), BASE).count() == 0
    assert -5 not in left and len(left) > 100
