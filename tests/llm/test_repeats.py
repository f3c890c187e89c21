"""Line dedup and removal of repeated strings against plain results."""

import random
from collections import Counter

import numpy as np
import pytest

from tallywright.llm import line_dedup
from tallywright.llm.line_dedup import dedup_lines, line_links, lines_of, within
from tallywright.llm.common import with_key
from tallywright.llm.suffix_array import longest_earlier, suffix_array
from tallywright.llm.suffix_dedup import remove_repeats

from . import brute

TEXT = "doc_id bigint, text string"


def test_banded_edit_distance():
    draw = random.Random(1)
    for _ in range(20_000):
        a = "".join(draw.choice("abc") for _ in range(draw.randint(0, 14)))
        b = list(a)
        for _ in range(draw.randint(0, 5)):
            i = draw.randint(0, len(b))
            b[i : i + draw.randint(0, 1)] = draw.choice(["", "a", "b", "c"])
        b = "".join(b)
        for most in (1, 2, 3):
            assert within(a, b, most) == (brute.edits(a, b) <= most), (a, b, most)


def variants(draw, line, n, most):
    out = []
    for _ in range(n):
        x = list(line)
        for _ in range(draw.randint(0, most)):
            i = draw.randrange(len(x))
            x[i : i + draw.randint(0, 1)] = draw.choice(["", *"xyzé"])
        out.append("".join(x))
    return out


@pytest.fixture(scope="module")
def varied():
    draw = random.Random(12)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 7)))
    lines = [" ".join(word() for _ in range(draw.randint(4, 9))) for _ in range(12)]
    lines += ["aaaaaaaaaaaaaaaaaaaaaaaaa", "abababababababababababab", "short", ""]
    many = [v for x in lines if x for v in variants(draw, x, 30, 3)] + lines
    draw.shuffle(many)
    docs = []
    while many:
        n = draw.randint(1, 6)
        docs.append("\n".join(f"{draw.choice(['', ' ', chr(9)])}{x} " for x in many[:n]))
        many = many[n:]
    return list(enumerate(docs))


@pytest.mark.parametrize(("most", "crowd"), [(1, 64), (1, 3), (2, 64), (3, 64)])
def test_links_of_lines(spark, varied, most, crowd):
    df = spark.createDataFrame(varied, TEXT)
    lines = lines_of(with_key(df), 20)
    known = {tuple(r.id): r.line for r in lines.collect()}
    pairs = {frozenset(known[tuple(x)] for x in r) for r in line_links(lines, most, crowd).collect()}
    assert all(brute.edits(*p) <= most for p in pairs)
    texts = sorted(known.values())
    near = lambda a, b: brute.edits(a, b) <= most
    assert brute.components(texts, lambda a, b: frozenset((a, b)) in pairs) == brute.components(texts, near)
    if crowd == 64:
        assert pairs == {frozenset((a, b)) for a in texts for b in texts if a < b and near(a, b)}


def within_edits(a, b, most):
    """Characters that only one of two lines has need an edit each: few pairs are left to compare in full."""
    x, y = Counter(a), Counter(b)
    if max((x - y).total(), (y - x).total()) > most:
        return False
    return brute.edits(a, b) <= most


def by_length(a, b):
    """Edits that two lines may differ by: one, two from 80 characters of the shorter, three from 120."""
    n = min(len(a), len(b))
    return 1 if n < 80 else 2 if n < 120 else 3


@pytest.fixture(scope="module")
def long_lines():
    """Lines around the lengths at which the edits change, and crowds that share most of their text."""
    draw = random.Random(21)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))[:n].ljust(n, "z")
    sizes = [60, 78, 79, 80, 81, 82, 100, 118, 119, 120, 121, 122, 123, 179, 180, 182, 260]
    out = [v for n in sizes for v in variants(draw, prose(n), 12, 3)]
    for n in (90, 150):
        head, tail = prose(n // 3), prose(n // 3)
        out += [head + prose(n // 3) + tail for _ in range(30)]
        middle = prose(n // 3)
        out += [v for _ in range(4) for v in variants(draw, head + middle + prose(n // 3), 10, 3)]
        out += [v for _ in range(4) for v in variants(draw, prose(n // 3) + middle + tail, 10, 3)]
    draw.shuffle(out)
    return [(i, x) for i, x in enumerate(out)]


@pytest.mark.parametrize(("crowd", "depth"), [(10_000, 4), (3, 4), (3, 0)])
def test_edits_follow_the_length(spark, long_lines, crowd, depth):
    lines = lines_of(with_key(spark.createDataFrame(long_lines, TEXT)), 20)
    known = {tuple(r.id): r.line for r in lines.collect()}
    found = line_links(lines, crowd=crowd, depth=depth).collect()
    pairs = {frozenset(known[tuple(x)] for x in r) for r in found}
    assert len(found) == len(pairs)
    texts = sorted(known.values())
    near = lambda a, b: within_edits(a, b, by_length(a, b))
    want = {frozenset((a, b)) for i, a in enumerate(texts) for b in texts[i + 1 :] if near(a, b)}
    assert {by_length(*p) for p in want} == {1, 2, 3}
    assert pairs <= want
    if crowd > 3:
        assert pairs == want
    together = lambda links: brute.components(texts, lambda a, b: frozenset((a, b)) in links)
    assert together(pairs) == together(want)


@pytest.mark.parametrize(("gather", "tiles"), [(1, 1), (1, 10_000), (100, 1)])
def test_crowds_of_all_sizes(spark, long_lines, monkeypatch, gather, tiles):
    """Hubs and further segments, tiles that meet by twos, and one group each: links are whole."""
    monkeypatch.setattr(line_dedup, "GATHER", gather)
    monkeypatch.setattr(line_dedup, "TILES", tiles)
    lines = lines_of(with_key(spark.createDataFrame(long_lines, TEXT)), 20)
    known = {tuple(r.id): r.line for r in lines.collect()}
    pairs = {frozenset(known[tuple(x)] for x in r) for r in line_links(lines, crowd=3).collect()}
    texts = sorted(known.values())
    near = lambda a, b: within_edits(a, b, by_length(a, b))
    assert all(near(*p) for p in pairs)
    assert brute.components(texts, lambda a, b: frozenset((a, b)) in pairs) == brute.components(texts, near)


@pytest.mark.parametrize("copies", [60, 400])
def test_crowds_are_not_paired_row_by_row(spark, monkeypatch, copies):
    """Lines that share much and are far from each other: no table grows with the square of their number."""
    draw = random.Random(copies)
    half = "".join(draw.choice("abcdefgh ") for _ in range(100))
    texts = [half + "".join(draw.choice("abcdefgh ") for _ in range(99)) + "." for _ in range(copies)]
    texts.append(texts[0][:150] + "??" + texts[0][150:])
    written, write = {}, line_dedup.scratch

    def counted(df, name):
        made = write(df, name)
        written[name] = max(written.get(name, 0), made.count())
        return made

    monkeypatch.setattr(line_dedup, "scratch", counted)
    lines = lines_of(with_key(spark.createDataFrame(list(enumerate(texts)), TEXT)), 20)
    links = line_links(lines).collect()
    known = {tuple(r.id): r.line for r in lines.collect()}
    assert [{known[tuple(x)] for x in r} for r in links] == [{texts[0], texts[-1]}]
    assert max(written.values()) <= 25 * copies, written


def plain_dedup(docs, least):
    lines = [(d, i, x.strip(" \t\r\v\f")) for d, t in docs for i, x in enumerate((t or "").split("\n"))]
    texts = sorted({x for _, _, x in lines if len(x) >= least})
    near = lambda a, b: within_edits(a, b, by_length(a, b))
    root = brute.components(texts, near)
    seen, gone = set(), set()
    for d, i, x in sorted(lines):
        if x in root:
            if root[x] in seen:
                gone.add((d, i))
            seen.add(root[x])
    return {
        d: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone)
        for d, t in docs
    }


@pytest.mark.parametrize("crowd", [64, 3])
def test_lines_that_stay(spark, varied, crowd, partitions):
    partitions(3)
    docs = [*varied, (10_000, None), (10_001, ""), (10_002, varied[0][1])]
    got = dedup_lines(spark.createDataFrame(docs, TEXT), crowd=crowd).collect()
    assert {r.doc_id: r.text for r in got} == plain_dedup(docs, 20)


def test_lines_of_odd_rows(odd_docs, no_docs):
    got = dedup_lines(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert list(got[0].asDict())[-2:] == ["__row_key", "n_gone"]  # in place of the columns called so
    assert set(odd_docs.columns) == set(got[0].asDict())
    texts = {r.doc_id: r.text for r in got}
    before = {r.doc_id: r.text for r in odd_docs.collect()}
    assert texts[5] == before[5] and texts[6] == "" and texts[1] is None and texts[2] == ""
    assert len([r for r in got if r.doc_id == 4 and r.text == "one"]) == 2
    assert dedup_lines(no_docs).count() == 0


# --- repeated strings ------------------------------------------------------------------------------


def test_suffix_array_and_longest_earlier_match():
    draw = random.Random(1)
    for _ in range(4_000):
        k = draw.choice([1, 2, 3, 5])
        x = [draw.randint(1, k) for _ in range(draw.randint(0, 24))]
        if draw.random() < 0.3:
            x = (x[:4] * 6)[: draw.randint(0, 24)]
        x.append(0)
        order = suffix_array(np.array(x))
        assert order == sorted(range(len(x)), key=lambda i: x[i:])
        for s, (length, start) in enumerate(longest_earlier(x, order)):
            same = lambda e: next(n for n in range(len(x)) if x[e + n : s + n + 1][:1] != x[s + n : s + n + 1] or s + n >= len(x) or x[e + n] != x[s + n])
            assert length == max((same(e) for e in range(s)), default=0)
            assert start < 0 or start < s


def check_repeats(spark, docs, **options):
    got = remove_repeats(spark.createDataFrame(docs, TEXT), **options).collect()
    want = brute.repeats(sorted(docs))
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id
        assert r.n_bytes - r.n_removed == len(r.kept)
    assert len(got) == len(docs)


@pytest.mark.parametrize("crowd", [256, 2, 0])
def test_repeats_of_the_small_table(spark, small, crowd):
    check_repeats(spark, [(d, t) for d, t, _ in small], crowd=crowd)


@pytest.mark.parametrize("crowd", [256, 3])
def test_repeats_of_made_up_texts(spark, crowd):
    draw = random.Random(21)
    letters = lambda n, of="abcdefghij é😀": "".join(draw.choice(of) for _ in range(n))
    passages = [letters(draw.randint(90, 260)) for _ in range(6)]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(draw.randint(1, 5)):
            p = draw.choice(passages)
            a, b = sorted((draw.randint(0, len(p)), draw.randint(0, len(p))))
            parts += [letters(draw.randint(0, 60)), draw.choice([p, p, p[a:b], p[: b], p[a:]])]
        docs.append((i, "".join(parts)))
    docs += [(100, "x" * 700), (101, "x" * 350), (102, "ab" * 300), (103, "ba" * 120 + "c"), (104, "abc" * 90)]
    docs += [(105, None), (106, ""), (107, "y" * 100), (108, "y" * 99), (109, "y" * 100)]
    docs += [(110 + i, passages[0][:150] + letters(3)) for i in range(12)]
    check_repeats(spark, docs, crowd=crowd)


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    from tallywright.llm import suffix_dedup

    whole = suffix_dedup.chunks
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 150)
    data = np.arange(1000)
    starts = [at + i for at, part in whole(data, 100) for i in range(len(part) - 99)]
    assert starts == list(range(901))


def test_repeats_of_odd_rows(odd_docs, no_docs):
    got = remove_repeats(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[6].n_removed == by_id[6].n_bytes and by_id[5].n_removed == 0
    assert by_id[1].n_bytes == by_id[2].n_bytes == 0
    assert by_id[11].n_removed == 30_000 - 1
    assert remove_repeats(no_docs).count() == 0
