"""The pipeline, stage by stage, against plain results; and what is registered."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tallywright.llm.queries import QUERIES, vocabulary
from tallywright.llm.packing import Tokens
from tallywright.llm.quality_rules import quality_rules

from . import brute
from .conftest import SMALL
from .test_repeats import plain_dedup


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returns for what the one before it has written."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_stay(stages):
    assert len(corpus_pipeline.STAGES) == 5
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_quality(stages):
    rows = [(r.doc_id, r.source, r.text) for r in stages[0].collect()]
    gone = brute.boilerplate(rows, 20)
    want = set()
    for d, _, t in rows:
        q = brute.quality(t)
        if not q["base_failed"] and 2 * (q["n_words"] - gone[d]) >= q["n_words"]:
            want.add(d)
    assert set(texts(stages[1])) == want


def test_quality_cuts_boilerplate_lines(spark):
    own = lambda i: " ".join(f"word{chr(97 + i)}{chr(97 + j % 26)}{j}" for j in range(60))
    rows = [(i, f"Home\n{own(i)}\n\n HOME \nContact 24\nlast {own(i)[::-1]}", "a", 1) for i in range(21)]
    rows += [(50, f"Home\n{own(3)}\nContact 24", "b", 1), (51, "Home", "a", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars int")
    got = corpus_pipeline.quality(spark, df, SMALL)
    assert got.schema == df.schema
    want = {i: f"{own(i)}\n\nlast {own(i)[::-1]}" for i in range(21)} | {50: rows[21][1]}
    assert texts(got) == want
    assert all(r.n_chars == len(r.text) for r in got.collect())
    lost = {r.doc_id: r.removed_lines for r in quality_rules(df).collect()}
    assert lost == {i: [0, 3, 4] for i in range(21)} | {50: None, 51: [0]}


def test_lines(stages):
    got = texts(stages[2])
    assert got == plain_dedup(sorted(texts(stages[1]).items()), 20)
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_near_copies(stages):
    before = texts(stages[2])
    prints = {d: brute.fingerprint(t) for d, t in before.items()}
    root = brute.components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert texts(stages[3]) == {d: t for d, t in before.items() if root[d] == d}


def test_benchmark(spark, stages):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    before = texts(stages[3])
    bad = {d for d, *_ in brute.contained(before.items(), [(r.item_id, r.text) for r in bench])}
    assert texts(stages[4]) == {d: t for d, t in before.items() if d not in bad}


def test_packing(stages):
    tokens = Tokens(*vocabulary())
    ids = {d: [*tokens.exact.encode(t, add_special_tokens=False).ids, 1] for d, t in texts(stages[4]).items()}
    brute.pieces_are_whole([r.asDict() for r in stages[5].collect()], ids)


def test_run_gives_what_the_stages_give(spark, stages):
    got = corpus_pipeline.run(spark, SMALL).drop("sequence_id", "offset").collect()
    assert sorted(got) == sorted(stages[5].drop("sequence_id", "offset").collect())


def test_stages_of_odd_rows(spark, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd_docs, no_docs):
            got = stage(spark, docs, SMALL)
            if name != "packing":
                assert got.columns == docs.columns
            n, m = got.count(), docs.count()
            assert n <= m if name != "packing" else n >= m
            if name in ("lines", "benchmark"):
                assert n == m


def test_other_columns_come_through(spark, odd_docs):
    """Whatever they are called and hold; a key column of the caller's tells no rows apart."""
    rest = [c for c in odd_docs.columns if c not in ("text", "n_chars")]
    before = odd_docs.select(*[f"`{c}`" for c in rest]).collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, odd_docs, SMALL)
        assert got.schema.names == odd_docs.schema.names
        kept = [list(r) for r in got.select(*[f"`{c}`" for c in rest]).collect()]
        assert all(r in [list(x) for x in before] for r in kept)
        if name in ("lines", "benchmark"):
            assert sorted(map(str, kept)) == sorted(str(list(x)) for x in before)


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
