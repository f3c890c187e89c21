"""Quality rules, URL filters, decontamination and toxicity against plain results."""

import math
import random
import re
import time
import unicodedata
import zlib
from collections import Counter
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pytest
from pyspark.sql import functions as F

from tallywright.llm import toxicity
from tallywright.llm.components import connected_components
from tallywright.llm.decontaminate import contained_items
from tallywright.llm.quality_rules import quality_rules
from tallywright.llm.queries import URL_RULES
from tallywright.llm.url_filter import alias_edges, judge_pages

from . import brute
from .conftest import SMALL

# --- quality ---------------------------------------------------------------------------------------


def check_quality(rows, df, most, least=0.5):
    got = {r.doc_id: r for r in quality_rules(df, max_families=most).collect()}
    gone = brute.boilerplate([(d, s, t) for d, t, s in rows], most)
    for doc, text, _ in rows:
        want = brute.quality(text)
        r = got[doc]
        assert {k: r[k] for k in want} == want
        assert r.n_boilerplate_words == gone[doc]
        kept = not want["base_failed"] and want["n_words"] - gone[doc] >= least * want["n_words"]
        assert r.kept == kept
    return got


@pytest.mark.parametrize("most", [1, 2, 20])
def test_quality_of_the_small_table(spark, small, most):
    df = spark.createDataFrame(small, "doc_id bigint, text string, source string")
    check_quality(small, df, most)


def test_frequent_lines_reject_depleted_documents_but_not_copies(spark):
    draw = random.Random(2)
    prose = lambda n: " ".join("".join(draw.choices("abcdefghij", k=6)) for _ in range(n))
    menu, copied = prose(60), prose(80)
    rows = [(i, f"{menu}\n{prose(55)}\n{prose(2)}", "a") for i in range(30)]
    rows += [(100 + i, f"{copied}\n{copied[::-1]}", "a") for i in range(60)]
    rows += [(200, f"{menu}\n{prose(30)}", "b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = check_quality(rows, df, 20)
    assert not any(got[i].kept for i in range(30))
    assert all(got[100 + i].kept for i in range(60)) and got[200].kept


@pytest.mark.parametrize("shared", [1, 2, 5, 10])
def test_lines_that_occur_together_count_each_document(spark, shared):
    draw = random.Random(shared)
    prose = lambda n: " ".join("".join(draw.choices("abcdefghij", k=6)) for _ in range(n))
    rows = []
    for host, n in (("over", 21), ("at", 20)):
        menu = "\n".join(prose(4) for _ in range(shared))
        docs = [f"{menu}\n{prose(60)}" for _ in range(n)]
        # copies are no further witnesses, whatever the order of their lines
        docs += [docs[0], "\n".join(docs[1].split("\n")[::-1])]
        rows += [(len(rows) + i, t, host) for i, t in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id: r for r in quality_rules(df).collect()}
    for doc, _, host in rows:
        assert got[doc].n_boilerplate_words == (4 * shared if host == "over" else 0)


def test_quality_of_odd_rows(odd_docs, no_docs):
    got = quality_rules(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r.base_failed and not r.kept for r in got if r.doc_id in (1, 2, 3, 4))
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    for r in got:
        if r.doc_id and r.doc_id > 4:
            want = brute.quality(texts[r.doc_id])
            assert {k: r[k] for k in want} == want
    assert quality_rules(no_docs).count() == 0


# --- urls ------------------------------------------------------------------------------------------

URLS = [
    None,
    "",
    "no scheme",
    "http://Example.ORG/es/a?x#y",
    "http://example.org/en/12",
    "http://a.example.org/es/",
    "http://notexample.org/es/",
    "http://org/x",
    "http://x.com/fr/a/b",
    "http://x.com/de/",
    "http://com/de",
    "https://x.net?q=http://y.com/de/",
    "x://h#f/p",
    "http://É.ORG/é?",
    "a://b://c.org/",
    "http://x.com/de/\n/z",
]


def test_url_rules(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)]
    got = judge_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string"), URL_RULES)
    for r in got.collect():
        host, path, rule = brute.url(URLS[r.page_id], URL_RULES)
        assert (r.host, r.path) == (host, path)
        assert (r.rule, r.verdict) == (rule or (None, "allow"))


def test_decisions_follow_aliases(spark):
    link = '<link data-x="1" rel="canonical" href="{}">'
    hop = "<META HTTP-EQUIV=refresh content='0; URL={}'>"
    rows = [
        (1, "http://a.net/1", link.format("http://x.com/de/1")),
        (2, "http://b.net/2", hop.format("http://a.net/1/")),
        (3, "http://c.net/3", link.format("//d.net/4")),
        (4, "https://d.net/4#top", hop.format("https://e.org/ok")),
        (5, "http://f.net/5", link.format("http://x.com/de/5")),
        (6, "http://f.net/5?q=1", None),
        (7, "http://x.com/de/1", "<p>canonical refresh</p>"),
        (8, "http://g.net/8", link.format("/deep/9")),
        (9, "http://g.net/deep/9", hop.format("../x.com")),
        (10, "http://i.org/10", link.format("http://x.com/de/10")),
        (11, "http://h.net/11", link.format("http://i.org/10")),
        (12, "http://j.net/12", None),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    seen = spark.createDataFrame(
        [("http://j.net/12", "http://b.net/2"), (None, "http://b.net/2")], "source string, target string"
    )
    got = {r.page_id: (r.rule, r.verdict) for r in judge_pages(pages, URL_RULES, seen).collect()}
    assert got == {
        1: (None, "block"),
        2: (None, "block"),
        3: (None, "allow"),
        4: (None, "allow"),
        5: (None, "block"),
        6: (None, "allow"),
        7: ("com/de/", "block"),
        8: (None, "allow"),
        9: (None, "allow"),
        10: ("org/", "allow"),
        11: (None, "allow"),
        12: (None, "block"),
    }
    assert judge_pages(pages.limit(0), URL_RULES).count() == 0


PAD = 'data-pad="' + "x" * 2_100 + '" '
LINKS = {
    '<link rel="canonical" href="http://x.com/de/1">': ["x.com/de/1"],
    f'<link {PAD}rel="canonical" {PAD}href="http://x.com/de/1">': ["x.com/de/1"],
    '<LINK HREF=http://x.com/de/1 REL=Canonical>': ["x.com/de/1"],
    '<link rel="alternate canonical" href="/m">': ["a.net/m"],
    '<link\nrel = \'x\tcanonical\'\nhref = "m?p=2&amp;r=x">': ["a.net/s/m?p=2&r=x"],
    '<link rel=canonical href="../m">': ["a.net/m"],
    '<link rel=canonical href="./../../../m/./n/../o/">': ["a.net/m/o"],
    '<link rel=canonical href="//b.org/..">': ["b.org"],
    '<link rel=canonical href="http:&#47;&#x2F;b.org/&#233;">': ["b.org/é"],
    '<link rel=canonical title="a>b" href="http://b.org/c">': ["b.org/c"],
    '<link rel=canonical href="http://b.org/1"><p><link rel=canonical href="http://b.org/2">': ["b.org/1", "b.org/2"],
    '<base href="http://c.org/k/"><link rel=canonical href="m">': ["c.org/k/m"],
    '<meta http-equiv="refresh" content="0; url=http://b.org/1">': ["b.org/1"],
    "<meta content='5;URL=\"http://b.org/1\"' http-equiv=Refresh>": ["b.org/1"],
    '<meta http-equiv="refresh" content="0; /x"><meta http-equiv=refresh content="3;url=/y">': ["a.net/x", "a.net/y"],
    # none of these is a link to another page
    '<link rel="stylesheet" data-note="rel=canonical" href="http://x.com/de/1">': [],
    '<link rel="canonical-ish" href="http://x.com/de/1">': [],
    '<link data-rel="canonical" href="http://x.com/de/1">': [],
    '<!-- <link rel="canonical" href="http://x.com/de/1"> -->': [],
    '<script>"<link rel=canonical href=http://x.com/de/1>"</script>': [],
    '<meta http-equiv="refresh" content="30">': [],
    '<link rel="canonical">': [],
    '<link rel="canonical" href="">': [],
    '<link rel="canonical" href="#top">': [],
    '<link rel="canonical" href="mailto:x@y.z">': [],
    '<link rel="canonical" href=http://x.com/de/1': [],
    "refresh canonical": [],
}


def test_each_link_is_found(spark):
    rows = [(f"http://a.net/s/p?i={i}", h) for i, h in enumerate(LINKS)]
    got = {u: [] for u, _ in rows}
    for r in alias_edges(spark.createDataFrame(rows, "url string, html string")).collect():
        got["http://" + r.a].append(r.b)
    assert {h: sorted(got[u]) for u, h in rows} == LINKS


def plain_links(url, html):
    """By the standard library's parser of markup and of URLs."""
    found, base = [], []

    class Parser(HTMLParser):
        def handle_starttag(self, tag, attrs):
            given = {}
            for k, v in attrs:
                given.setdefault(k, v or "")
            if tag == "base" and "href" in given:
                base.append(given["href"])
            if tag == "link" and "canonical" in given.get("rel", "").lower().split():
                found.append(given.get("href", ""))
            if tag == "meta" and given.get("http-equiv", "").lower() == "refresh":
                found.append(re.split("(?i)url=", given.get("content", ""))[-1].strip(" '\""))

    parser = Parser()
    parser.feed(html)
    start = urljoin(url, base[0]) if base else url
    out = []
    for target in found:
        if target:
            p = urlsplit(urljoin(start, target))
            out.append(p.netloc.lower() + p.path.rstrip("/") + ("?" + p.query if p.query else ""))
    return sorted(out)


def test_links_of_made_up_pages(spark):
    draw = random.Random(8)
    urls = ["http://B.org/x", "/r/s", "t", "../u", "./v/../w/", "?q=1&amp;z=2", "//c.org", "/a&#47;b", "http://d.net/é"]
    rels = ["canonical", "CANONICAL nofollow", "stylesheet", "next canonical", "canonicals"]
    rows = []
    for i in range(300):
        tags = []
        for _ in range(draw.randint(0, 4)):
            q = draw.choice("\"'")
            attrs = [f"rel={q}{draw.choice(rels)}{q}", f"href={q}{draw.choice(urls)}{q}", draw.choice(["", "hidden", PAD, f"alt={q}rel=canonical > {q}"])]
            draw.shuffle(attrs)
            meta = f"<meta {draw.choice(['', 'a=b '])}http-equiv=refresh content={q}{draw.choice(['0', '3.5'])}; url={draw.choice(urls)}{q} />"
            tags.append(draw.choice([f"<link {' '.join(attrs)}>", f"<Link  {' '.join(attrs)}/>", meta, "<p>canonical</p>", f"<!-- <link {attrs[0]}> -->"]))
        if draw.random() < 0.2:
            tags.insert(0, f"<base href='{draw.choice(urls[:4])}'>")
        rows.append((f"http://a.net/f/g/{i}", "canonical<html>" + "\n".join(tags)))
    got = {u: [] for u, _ in rows}
    for r in alias_edges(spark.createDataFrame(rows, "url string, html string")).collect():
        got["http://" + r.a].append(r.b)
    assert {u: sorted(v) for u, v in got.items()} == {u: plain_links(u, h) for u, h in rows}


def test_verdicts_reach_aliases_of_every_form(spark):
    rows = list(enumerate(["http://x.com/de/1", *[f"http://a.net/s/p?i={i}" for i in range(len(LINKS))]]))
    html = ["", *LINKS]
    pages = spark.createDataFrame([(i, u, h) for (i, u), h in zip(rows, html)], "page_id int, url string, html string")
    got = {r.page_id: r.verdict for r in judge_pages(pages, URL_RULES).collect()}
    for i, targets in enumerate(LINKS.values(), 1):
        # b.org is allowed by a rule, x.com/de/ is blocked
        assert got[i] == ("block" if "x.com/de/1" in targets else "allow")


def test_urls_of_the_small_table(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    urls = {r.page_id: r.url for r in pages.collect()}
    for r in judge_pages(pages, URL_RULES).collect():
        host, path, rule = brute.url(urls[r.page_id], URL_RULES)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, *(rule or (None, "allow")))


def test_components(spark):
    draw = random.Random(4)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(40)]
    edges += [(5, 5), (None, 3), (7, None)]
    linked = {frozenset(e) for e in edges}
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    nodes = {x for a, b in edges if None not in (a, b) and a != b for x in (a, b)}
    want = brute.components(nodes, lambda a, b: frozenset((a, b)) in linked)
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- decontamination -------------------------------------------------------------------------------


def test_items_in_the_small_table(spark, small):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    # nearly whole items: some are above the bar, some below
    cut = [(9000 + i, "before " + t[: len(t) * k // 20]) for k in range(12, 20) for i, t in items]
    rows = [(d, t) for d, t, _ in small] + [(d + 100 * n, t) for n, (d, t) in enumerate(cut)]
    # short items: the first words of some documents
    items += [(500 + n, " ".join(brute.tokens(t)[: 1 + n % 6])) for n, (_, t) in enumerate(rows[:12])]
    items += [(600, "no such words anywhere"), (601, ""), (602, None)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [(r.doc_id, r.item_id, r.n_shingles, r.n_held) for r in contained_items(df, bench).collect()]
    assert sorted(got) == sorted(brute.contained(rows, items)) and len(got) > 40


def test_odd_items_and_documents(spark, odd_docs, no_docs):
    items = spark.createDataFrame(
        [(1, None), (2, ""), (3, "one two"), (None, "with some words in it"), (4, "word word word word word")] * 2
        + [(5, "One!"), (6, "two words"), (7, "a null id with"), (8, "...")],
        "item_id bigint, text string",
    )
    got = Counter((r.doc_id, r.item_id) for r in contained_items(odd_docs, items).collect())
    assert got == {(None, None): 2, (10, 4): 2, (4, 5): 2, (4, 6): 1, (None, 7): 1}
    assert contained_items(no_docs, items).count() == 0
    assert contained_items(odd_docs, items.limit(0)).count() == 0


# --- toxicity --------------------------------------------------------------------------------------


def test_folding():
    assert toxicity.words_of("You 1d10t, m0r0n! Ѕсum pathétic 2024 @ss") == [
        "you", "idiot", "moron", "scum", "pathetic", "ass",
    ]


def test_signatures_select_the_candidates(spark, monkeypatch):
    """Only what hits a signature is verified, and a document beyond the bar always does."""
    from tallywright.llm import decontaminate

    draw = random.Random(6)
    word = lambda: "".join(draw.choices("abcdefgh", k=4))
    items = [(i, " ".join(word() for _ in range(draw.randint(2, 60)))) for i in range(60)]
    docs = []
    for n in range(400):
        ws = brute.tokens(draw.choice(items)[1])
        start = draw.randrange(len(ws))
        docs.append((n, " ".join([word(), *ws[start : start + draw.randint(1, len(ws))], word()])))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = sorted((d, i) for d, i, _, _ in brute.contained(docs, items))
    got = sorted((r.doc_id, r.item_id) for r in contained_items(df, bench).collect())
    assert got == want and 10 < len(want) < 400
    # the same by a shuffled join
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert sorted((r.doc_id, r.item_id) for r in contained_items(df, bench).collect()) == want
    # without signatures nothing is a candidate
    index = decontaminate.item_index
    monkeypatch.setattr(decontaminate, "item_index", lambda *a: index(*a).withColumn("signed", F.lit(False)))
    assert contained_items(df, bench).count() == 0


def test_folding_of_long_runs_takes_little_time():
    for run in ("a" * 1_000_000, "é" * 300_000, "a" * 500_000 + "1", ("a" * 1000 + " ") * 1000, "!" * 500_000):
        start = time.perf_counter()
        toxicity.fold(run)
        assert time.perf_counter() - start < 2


def test_folding_is_as_by_plain_runs():
    draw = random.Random(2)
    for _ in range(3000):
        text = "".join(draw.choices("ab1@$!|ан _-\té0", k=draw.randint(0, 25)))
        runs = re.split(r"([^\w@$!|]+)", text.lower())
        want = "".join(
            r if i % 2 or not re.search(r"[\d@$!|\u0370-\u052f]", r) else toxicity._plain(re.match("(?s).*", r))
            for i, r in enumerate(unicodedata.normalize("NFKD", x) for x in runs)
        )
        assert toxicity.fold(text) == toxicity._ACCENTS.sub("", want)


def test_one_id_with_many_texts_keeps_to_the_bound(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("IF(id < 2000, 1, id) AS doc_id", "concat('text number ', id) AS text")
    docs = docs.union(docs)
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS toxic").distinct()
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda rows: seen.append(rows))
    toxicity.learn(docs, labels, max_rows=100)
    assert 0 < len(seen[0]) <= 100 and len(set(seen[0])) == len(seen[0])


def plain_score(text, model):
    """Every entry is looked for at every word."""
    words = toxicity.words_of(text)
    total = 0.0
    for i, w in enumerate(words):
        held = [
            (v, e.strip()) for e, v in model.entries.items() if (w == e[:-1] if e.endswith(" ") else w.startswith(e))
        ]
        if not held:
            continue
        value, entry = max(held, key=lambda x: x[0])
        beside = {(words[i - 1], entry)} if i else set()
        beside |= {(entry, words[i + 1])} if i + 1 < len(words) else set()
        total += 0.0 if beside & model.exceptions else value
    a, b, c = model.curve
    z = a + b * math.log1p(total) + c * math.log1p(100 * total / (len(words) + 20) if words else 0.0)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def test_scores_are_as_by_plain_search(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels)
    assert model.entries
    rows = {r.doc_id: r.text for r in docs.collect()}
    for r in toxicity.toxicity(docs, model).collect():
        assert r.score == pytest.approx(plain_score(rows[r.doc_id] or "", model), abs=1e-9)


def test_exceptions_and_length():
    draw = random.Random(8)
    filler = lambda n: " ".join(f"w{chr(97 + draw.randrange(26))}{chr(97 + draw.randrange(26))}" for _ in range(n))
    rows = [(f"{filler(40)} clown {filler(5)} badword {filler(40)}", 1) for _ in range(60)]
    rows += [(f"{filler(40)} badword fish {filler(40)}", 0) for _ in range(40)]
    rows += [(filler(80), 0) for _ in range(500)]
    model = toxicity.fit(rows)
    auto = model.automaton()
    # an entry is the shortest opening that tells
    assert any("badword".startswith(e) and after == "fish" for e, after in model.exceptions)
    score = lambda t: toxicity.features(toxicity.words_of(t), auto, model.exceptions)
    assert score("a badword fish swims") == (0.0, 0.0)
    assert score("you cl0wn") > (0.0, 0.0)
    assert score("you clown")[1] > score("you clown " + filler(500))[1]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.learn(docs, labels)
    rows = toxicity.toxicity(docs, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    test = [(r.score, r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    hit = sum(p == y for _, p, y in test) / len(test)
    good = [s for s, _, y in test if y]
    bad = [s for s, _, y in test if not y]
    auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert hit > 0.93 and auc > 0.93


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.learn(odd_docs, labels)
    got = toxicity.toxicity(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score < 0.5 for r in got)
    assert toxicity.toxicity(no_docs, model).count() == 0
