"""Quality rules with cross-document line frequency.

Lines are normalised and hashed. For each host the distinct documents that hold a line are counted;
lines above the limit are boilerplate and are removed; a document that keeps too little of its words
is rejected. A document that only copies another is not a further witness against its lines:
documents that hold the same set of lines are one family and count once.
"""

import re
from collections import Counter, defaultdict
from hashlib import md5

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, cut_lines, scratch, texts, with_key

MAX_FAMILIES = 20
LEAST_KEPT = 0.5

_SYMBOL = re.compile(r"[#*$%&|<>]")
_DIGITS = re.compile(rb"[0-9]+")

BASE = (
    f"{KEY} bigint, doc_id bigint, host string, n_words bigint, word_chars bigint,"
    " n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, family string,"
    " lines array<struct<h:string,words:int,at:array<int>>>"
)


def line_hash(line: bytes) -> str:
    """Hash of a line in which a-z and A-Z, white space, and digits do not matter."""
    plain = _DIGITS.sub(b"0", b" ".join(line.lower().split()))
    return md5(plain).hexdigest()[:16]


def repeat_words(words: list) -> int:
    """Words in windows of three words that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    often = {w for w, n in Counter(windows).items() if n > 1}
    total = reach = 0
    for at, w in enumerate(windows):
        if w in often:
            total += at + 3 - max(at, reach)
            reach = at + 3
    return total


def measure(key, text, doc_id, host):
    """One row of base measures, with the lines that hold a word."""
    data = text.encode()
    words = data.split()
    lines = [(x, len(x.split())) for x in data.split(b"\n")]
    full = [(x, n) for x, n in lines if n]
    # distinct normalised lines of this document; words count for every place of a line
    held, places = Counter(), defaultdict(list)
    for no, (x, n) in enumerate(lines):
        if n:
            h = line_hash(x)
            held[h] += n
            places[h].append(no)
    family = md5("".join(sorted(held)).encode()).hexdigest()[:16]
    blanks = sum(text.count(c) for c in " \t\n\v\f\r")
    yield (
        key,
        doc_id,
        host,
        len(words),
        len(text) - blanks,
        len(_SYMBOL.findall(text)),
        len(full) - len({x for x, _ in full}),
        repeat_words(words),
        family,
        [{"h": h, "words": n, "at": places[h]} for h, n in held.items()],
    )


def quality_rules(
    docs: DataFrame,
    host: str = "source",
    max_families: int = MAX_FAMILIES,
    least_kept: float = LEAST_KEPT,
) -> DataFrame:
    """Measures and verdict per row of ``docs`` (doc_id, text and ``host``).

    Columns: __row_key, doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_boilerplate_words, kept, removed_lines (numbers of the boilerplate lines of the
    text, from 0, in order; null where there are none, see ``without_lines``). Null and empty texts have no words and so fail the base
    rules. A null host is a host of its own. Rows with repeated ids are judged one by one. An empty
    table gives no rows. Other columns of ``docs`` are not looked at.
    """
    keyed = with_key(docs)
    source = keyed.select(
        KEY, "text", F.col("doc_id").cast("bigint").alias("__id"), F.col(host).alias("__host")
    )
    base = scratch(texts(source, measure, BASE, ("__id", "__host")), "quality")
    lines = base.select(KEY, "host", "family", F.inline("lines"))
    # written, so that the join of a hot line can be split
    frequent = scratch(
        lines.select("host", "h", "family")
        .distinct()
        .groupBy("host", "h")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > max_families)
        .select(F.col("host").alias("host_2"), F.col("h").alias("h_2")),
        "frequent",
    )
    removed = (
        lines.join(frequent, F.col("host").eqNullSafe(F.col("host_2")) & (F.col("h") == F.col("h_2")))
        .groupBy(F.col(KEY).alias("key_2"))
        .agg(
            F.sum("words").alias("gone"),
            F.array_sort(F.flatten(F.collect_list("at"))).alias("removed_lines"),
        )
    )
    words, gone = F.col("n_words"), F.coalesce("gone", F.lit(0))
    failed = (words < 50) | (100 * F.col("n_repeat_words") > 50 * words)
    return (
        base.drop("family", "lines")
        .join(removed, F.col(KEY) == F.col("key_2"), "left")
        .select(
            *[c for c in base.columns if c not in ("family", "lines")],
            failed.alias("base_failed"),
            gone.cast("bigint").alias("n_boilerplate_words"),
            (~failed & (words - gone >= least_kept * words)).alias("kept"),
            "removed_lines",
        )
    )


def without_lines(docs: DataFrame, numbers: str) -> DataFrame:
    """``docs`` without the lines of ``text`` that the column ``numbers`` names, and without it."""
    return docs.withColumn("text", cut_lines(F.col("text"), F.col(numbers))).drop(numbers)
