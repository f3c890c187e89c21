"""Toxicity scores from a weighted lexicon that an Aho-Corasick automaton matches.

Texts are folded first: homoglyphs, accents and digits that stand for letters become plain letters.
The lexicon holds openings of words with weights learned from labelled rows. A score is a logistic
curve over the matched weight, once as it is and once for the text's length. Exception phrases
(two words in which the entry is harmless) take a match out.
"""

import math
import re
import unicodedata
from collections import Counter
from sys import intern

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, texts, with_key

MAX_ROWS = 12_000  # labelled rows that the lexicon is fitted on, those of the least hash
MIN_DOCS = 8  # toxic rows that must show an entry
MIN_WEIGHT = 2.5  # log odds of an entry, smoothed
PREFIX = (3, 8)  # letters in an entry that stands for a family of words

# Letters of other scripts, signs and digits that look like a Latin letter.
_LOOKALIKE = str.maketrans(
    "аеорсухкмтвнгіјѕԁӏαεορτυνικβ013457@$!|",
    "aeopcyxkmtbhrijsdlaeoptuvikboieastasii",
)
_WORD = re.compile(r"[^\W\d_]+")
_ACCENTS = re.compile("[\u0300-\u036f]+")
# a run that holds such a character; each run is looked through once, however long it is
_SUSPECT = re.compile(r"(?<![\w@$!|])(?=[\w@$!|]*?[\d@$!|\u0370-\u052f])[\w@$!|]+")


def _plain(match: re.Match) -> str:
    word = match[0].rstrip("!|")
    return word.translate(_LOOKALIKE) if re.search(r"[^\W\d_]", word) else " "


def fold(text: str) -> str:
    """Lower case without accents; look-alikes become letters inside words that hold a letter."""
    text = text.lower()
    if not text.isascii():
        text = _ACCENTS.sub("", unicodedata.normalize("NFKD", text))
    return _SUSPECT.sub(_plain, text)


def words_of(text: str) -> list[str]:
    return _WORD.findall(fold(text))


def _shared(words: list[str]) -> list[str]:
    """The same list, with one object per distinct word."""
    return [intern(w) for w in words]


class Model:
    """Lexicon, exceptions and curve; plain data, some thousand entries at most."""

    def __init__(self, entries: dict[str, float], exceptions: set, curve: tuple):
        self.entries, self.exceptions, self.curve = entries, exceptions, curve

    def automaton(self) -> ahocorasick.Automaton:
        auto = ahocorasick.Automaton()
        # a blank stands before every word, so entries match openings of words or whole words
        for entry, weight in self.entries.items():
            auto.add_word(f" {entry}", (len(entry), weight, entry.strip()))
        if self.entries:
            auto.make_automaton()
        return auto


def features(words: list[str], auto: ahocorasick.Automaton, exceptions: set) -> tuple[float, float]:
    """Matched weight, plain and per hundred words; a word counts its heaviest entry once."""
    if not words or not len(auto):
        return 0.0, 0.0
    line = f" {' '.join(words)} "
    best: dict[int, tuple[float, str]] = {}
    for end, (length, weight, entry) in auto.iter(line):
        start = end - length
        if weight > best.get(start, (0.0, ""))[0]:
            best[start] = (weight, entry)
    total = 0.0
    for start, (weight, entry) in best.items():
        if exceptions:
            stop = line.index(" ", start + 1)
            before = line[line.rfind(" ", 0, start) + 1 : start]
            after = line[stop + 1 : line.find(" ", stop + 1)]
            if (before, entry) in exceptions or (entry, after) in exceptions:
                continue
        total += weight
    return math.log1p(total), math.log1p(100.0 * total / (len(words) + 20))


def fit(rows: list[tuple[str, int]]) -> Model:
    """Learn from (text, label) rows: entries by smoothed log odds over documents, exception phrases
    by the rows in which an entry is harmless, and the curve by logistic regression."""
    # copies are one witness
    tokens = [(_shared(words_of(t)), y) for t, y in dict.fromkeys(rows)]
    n = [sum(1 for _, y in tokens if y == k) for k in (0, 1)]
    if not n[0] or not n[1]:
        share = n[1] / max(1, sum(n))
        return Model({}, set(), (math.log((share + 0.01) / (1.01 - share)), 0.0, 0.0))
    whole, opening = (Counter(), Counter()), (Counter(), Counter())
    for ws, y in tokens:
        distinct = set(ws)
        whole[y].update(distinct)
        opening[y].update({w[:k] for w in distinct for k in range(PREFIX[0], PREFIX[1] + 1) if len(w) >= k})

    def weight(counts, w):
        a, b = counts[1][w], counts[0][w]
        return math.log((a + 0.5) / (n[1] + 1)) - math.log((b + 0.5) / (n[0] + 1))

    entries: dict[str, float] = {}
    # the shortest opening that tells toxic rows apart stands for all longer ones
    for p in sorted((p for p, a in opening[1].items() if a >= MIN_DOCS), key=lambda p: (len(p), p)):
        if any(p[:k] in entries for k in range(PREFIX[0], len(p))):
            continue
        if (value := weight(opening, p)) >= MIN_WEIGHT:
            entries[p] = value
    for w, a in whole[1].items():
        if a >= MIN_DOCS and (value := weight(whole, w)) >= MIN_WEIGHT:
            if not any(w[:k] in entries for k in range(PREFIX[0], PREFIX[1] + 1)):
                entries[f"{w} "] = value

    auto = Model(entries, set(), ()).automaton()
    beside = (Counter(), Counter())
    for ws, y in tokens:
        for i, w in enumerate(ws):
            held = [w[:k] for k in range(PREFIX[0], len(w) + 1) if w[:k] in entries]
            held += [w] if f"{w} " in entries else []
            for e in held:
                beside[y].update([(ws[i - 1], e)] if i else [])
                beside[y].update([(e, ws[i + 1])] if i + 1 < len(ws) else [])
    exceptions = {p for p, a in beside[0].items() if a >= MIN_DOCS and a >= 9 * beside[1][p]}

    x = np.array([features(ws, auto, exceptions) for ws, _ in tokens])
    return Model(entries, exceptions, _curve(x, np.array([y for _, y in tokens])))


def _curve(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple:
    """Logistic regression with a small ridge, by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + 0.01 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled rows outside the held-out fold, those whose id hashes
    least. Conflicting labels of one id count as toxic; null labels and ids are left out. Copies of a
    row are one, and of an id with many texts no more than ``max_rows`` rows reach the driver."""
    marks = (
        labels.select(F.col("doc_id").alias("l_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("l_id is not null and toxic is not null")
        .where(~held_out("l_id"))
        .groupBy("l_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    chosen = marks.orderBy(F.xxhash64("l_id"), "l_id").limit(max_rows)
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id"))
        .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text")
        .limit(max_rows)
    )
    return fit(sorted((r.text, r.toxic) for r in rows.toLocalIterator()))


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """Score per row of ``docs`` (doc_id, text).

    Columns: __row_key, doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on). Null and empty
    texts score what a text without matches scores. Null ids are not held out. Repeated rows are
    scored one by one; an empty table gives no rows. Only the text is looked at.
    """
    keyed = with_key(docs)
    send = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    class Scorer:
        def __init__(self):
            self.model = send.value
            self.auto = self.model.automaton()

        def __call__(self, key, text, doc_id):
            a, b, c = self.model.curve
            x, z = features(words_of(text), self.auto, self.model.exceptions)
            yield key, doc_id, 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x + c * z))))

    scores = texts(
        keyed.select(KEY, "text", F.col("doc_id").alias("__id")),
        Scorer,
        f"{KEY} bigint, doc_id {id_type}, score double",
        ("__id",),
    )
    return scores.select(
        KEY,
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
