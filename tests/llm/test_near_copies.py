"""SimHash and packing against plain results."""

import random

import pytest

from tallywright.llm import simhash
from tallywright.llm.packing import Tokens, pack, pack_lengths, slots
from tallywright.llm.queries import vocabulary
from tallywright.llm.simhash import fingerprint, links, near_duplicates

from . import brute

TEXT = "doc_id bigint, text string"


def test_fingerprints_of_the_small_table(small):
    for _, text, _ in small:
        assert fingerprint(text) % (1 << 64) == brute.fingerprint(text)


def test_components_of_the_small_table(spark, small):
    rows = [(d, t) for d, t, _ in small]
    prints = {d: brute.fingerprint(t) for d, t in rows}
    want = brute.components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    got = near_duplicates(spark.createDataFrame(rows, TEXT)).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.fingerprint for r in got} == {d: f"{p:016x}" for d, p in prints.items()}


@pytest.mark.parametrize("crowd", [2, 64])
@pytest.mark.parametrize("bits", [1, 2])
def test_links_join_all_near_fingerprints(spark, crowd, bits):
    draw = random.Random(6)
    prints = {draw.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1}
    for center in draw.sample(sorted(prints), 12):
        for _ in range(25):
            x = center
            for _ in range(draw.randint(1, 4)):
                x ^= 1 << draw.randrange(64)
            prints.add(x)
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp bigint")
    pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in links(df, bits, crowd).collect()]
    assert all((a ^ b).bit_count() <= bits for a, b in pairs)
    found = {frozenset(p) for p in pairs}
    got = brute.components(prints, lambda a, b: frozenset((a, b)) in found)
    assert got == brute.components(prints, lambda a, b: (a ^ b).bit_count() <= bits)


def test_near_copies_of_odd_rows(odd_docs, no_docs):
    got = near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    zero = [r for r in got if r.fingerprint == "0" * 16]
    assert len(zero) == 4 and len({r.component_id for r in zero}) == 1
    # two rows without id, the texts of id 4, and the long text come twice or more
    assert sum(r.is_first for r in got) <= len({r.fingerprint for r in got}) < len(got)
    assert near_duplicates(no_docs).count() == 0


# --- packing ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokens():
    return Tokens(*vocabulary())


def exact(tokens, text):
    return [*tokens.exact.encode(text or "", add_special_tokens=False).ids, 1]


def test_pack_the_small_table(spark, small, tokens, partitions):
    partitions(5)
    rows = [(d, t) for d, t, _ in small]
    got = [r.asDict() for r in pack(spark.createDataFrame(rows, TEXT), *vocabulary()).collect()]
    ids = {d: exact(tokens, t) for d, t in rows}
    sequences = brute.pieces_are_whole(got, ids)
    total = sum(map(len, ids.values()))
    assert sequences <= total / 2048 / 0.97 + 1


def test_kept_ids(spark, small, tokens):
    rows = [(d, t) for d, t, _ in small[:30]]
    got = pack(spark.createDataFrame(rows, TEXT), *vocabulary(), limit=100, keep_ids=True).collect()
    for d, t in rows:
        mine = sorted((r.start, r.ids) for r in got if r.doc_id == d)
        assert [i for _, part in mine for i in part] == exact(tokens, t)


def test_same_ids_as_the_vocabulary_file(tokens):
    draw = random.Random(9)
    odd = ["", " ", "<|endoftext|>", "a<|endoftext|>b", "x" * 5000, "é" * 3000, "漢字😀 \r\n\t ١٢٣ 'll 'LL"]
    odd += ["".join(chr(draw.choice([32, 10, 39, 97, 233, 0x4E2D, 0x1F600, 49, 46, 0xA0, 0x2003])) for _ in range(300)) for _ in range(60)]
    for text in odd:
        assert [*tokens.ids(text), 1] == exact(tokens, text)


@pytest.mark.parametrize("limit", [1, 7, 64, 2048])
def test_patterns_place_every_piece(limit):
    draw = random.Random(limit)
    for _ in range(40):
        counts = {draw.randint(1, limit): draw.randint(1, 500) for _ in range(draw.randint(0, 60))}
        patterns = pack_lengths(counts, limit)
        assert all(sum(p) <= limit and n > 0 for n, p in patterns)
        placed = {}
        for length, first, last, _, _ in slots(patterns):
            placed.setdefault(length, []).append((first, last))
        for length, ranges in placed.items():
            ranges.sort()
            assert ranges[0][0] == 0 and ranges[-1][1] == counts[length] - 1
            assert all(a[1] + 1 == b[0] for a, b in zip(ranges, ranges[1:], strict=False))
        assert set(placed) == set(counts)
        assert len(patterns) <= 4 * limit + 4


def test_pack_odd_rows(odd_docs, no_docs):
    got = pack(odd_docs, *vocabulary()).collect()
    assert len([r for r in got if r.doc_id in (1, 2) and r.doc_tokens == 1]) == 2
    assert len([r for r in got if r.doc_id == 4]) == 3
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert pack(no_docs, *vocabulary()).count() == 0
