import random
from datetime import datetime

import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns with clashing names."""
    draw = random.Random(3)
    syllables = "the of an er ing ti on est ha ré ü 漢 😀 o".split()
    prose = lambda n: " ".join(
        "".join(draw.choice(syllables) for _ in range(draw.randint(1, 3))) for _ in range(n)
    )
    long = "\n".join(prose(30) for _ in range(120))
    shared = prose(40)
    rows = [
        (None, "a null id with some words in it", "s1"),
        (None, None, None),
        (1, None, "s1"),
        (2, "", "s1"),
        (3, " \t\n ", None),
        (4, "one", "s2"),
        (4, "one", "s2"),
        (4, "two words", "s2"),
        (5, long, "s1"),
        (6, long, "s1"),
        (7, long + "\n" + prose(5), "s1"),
        (8, prose(20) + "\n" + shared + "\n" + prose(20), "s2"),
        (9, prose(60) + "\n" + shared, "s2"),
        (10, "word " * 300, "s3"),
        (11, "x" * 30_000, "s3"),
        (12, "7" * 20_000 + " " + "1 " * 5_000 + "a@" * 3_000 + "+" * 2_000 + "." * 3_000, "s3"),
    ]
    clash = (7, 7, [7], True, 0, "t", (1, "x"), datetime(2020, 2, 29, 1, 2, 3), 5, "r")
    wide = [(*r, -1, "h", 0, "t", 9, 1, "k", 2, *clash) for r in rows]
    return spark.createDataFrame(
        wide,
        "doc_id bigint, text string, source string, n int, h string, fp int, kind string,"
        " length int, bucket int, __key string, start int, g_key int, n_gone int, __gone array<int>,"
        " __lost boolean, __row_key bigint, text2 string, nested struct<`a b`: int, c: string>,"
        " `seen at` timestamp, __at int, rest string",
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small(spark):
    """(doc_id, text, source) of the smallest tables, in order of id."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    return sorted((r.doc_id, r.text, r.source) for r in rows)
