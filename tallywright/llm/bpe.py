"""Byte-level BPE: batched numpy merge rounds, and the way back from ids to text.

Texts are split into words by the vocabulary's pattern. Words that a task has not met yet are encoded
together: the symbols of all of them lie in one flat array, and a round looks up every neighbouring
pair by binary search over the sorted pair keys, takes the lowest rank of each word, and merges all
its places at once. Words of over ``LONG_WORD`` bytes, where a round for each rank would cost the whole
word, are merged rank by rank over linked places instead, so that a round touches only the places that
it changes. Both give what merging one pair at a time gives, as a merge's symbol occurs in merges of
higher rank only (checked when the vocabulary is read).
"""

import codecs
import hashlib
import heapq
import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pa_schema, slices

LONG_WORD = 256  # bytes
KNOWN_WORDS = 300_000  # words that a task remembers at most
CHUNK = 1 << 20  # characters that are split at a time
_NONE = np.iinfo(np.int64).max

# White space as the pattern of byte-level vocabularies has it, for texts in ASCII.
_ASCII = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+"
    r"|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"
)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 as it is, others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Merges and tokens of a byte-level BPE file, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, split = data["model"], data["pre_tokenizer"] or {}
        plain = (
            model["type"] == "BPE"
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and not any(data.get(k) for k in ("normalizer", "post_processor"))
            and not any(
                model.get(k)
                for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
            )
            and not any(
                t[k] for t in data["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")
            )
        )
        if not plain:
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        self.path = path
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        ids = model["vocab"]
        self.byte_ids = np.array([ids[c] for c in letters], dtype=np.int64)
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens: list[bytes] = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, at in ids.items():
            self.tokens[at] = bytes(byte_of[c] for c in token)
        for token, at in self.special.items():
            self.tokens[at] = token.encode()

        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = np.array([[ids[a], ids[b], ids[a + b]] for a, b in merges], dtype=np.int64).reshape(-1, 3)
        born = np.full(len(self.tokens), -1, dtype=np.int64)
        np.maximum.at(born, pairs[:, 2], np.arange(len(pairs)))
        if (born[pairs[:, :2]] >= np.arange(len(pairs))[:, None]).any():
            raise ValueError(f"{path} has merges of symbols that later merges make")
        keys = (pairs[:, 0] << 32) | pairs[:, 1]
        self.ranks = np.argsort(keys, kind="stable")
        self.keys, self.made = keys[self.ranks], pairs[:, 2]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, ``_NONE`` where there is no such merge."""
        if not len(self.keys):
            return np.full(len(left), _NONE)
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    # --- merging -------------------------------------------------------------------------------------

    def merge_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of non-empty words, all in one flat array of symbols."""
        sizes = np.array([len(w) for w in words])
        symbols = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        ready_symbols, ready_words = [], []
        while len(symbols):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            rank = np.full(len(symbols), _NONE)
            rank[:-1] = np.where(word[1:] == word[:-1], self.rank(symbols[:-1], symbols[1:]), _NONE)
            lowest = np.minimum.reduceat(rank, first)
            lowest = np.repeat(lowest, np.diff(first, append=len(symbols)))
            done = lowest == _NONE
            ready_symbols.append(symbols[done])
            ready_words.append(word[done])
            merged = every_other((rank == lowest) & ~done)
            symbols[merged] = self.made[rank[merged]]
            stay = ~done
            stay[np.flatnonzero(merged) + 1] = False
            symbols, word = symbols[stay], word[stay]
        word = np.concatenate(ready_words)
        order = np.argsort(word, kind="stable")
        ids = np.concatenate(ready_symbols)[order].astype("<u4")
        return np.split(ids, np.flatnonzero(np.diff(word[order])) + 1)

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one word: the places of each rank wait in a heap, neighbours are linked."""
        symbols = self.byte_ids[np.frombuffer(word, dtype=np.uint8)].copy()
        n = len(symbols)
        # the place after the last one is its own neighbour, and no pair
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[n], before[0] = n, n
        rank = np.full(n + 1, _NONE)
        alive = np.ones(n + 1, dtype=bool)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def look(places):
            right = after[places]
            ends = right == n
            found = self.rank(symbols[places], symbols[np.where(ends, 0, right)])
            rank[places] = found = np.where(ends, _NONE, found)
            hit = found < _NONE
            places, found = places[hit], found[hit]
            order = np.argsort(found, kind="stable")
            places, found = places[order], found[order]
            for part in np.split(places, np.flatnonzero(np.diff(found)) + 1):
                if len(part):
                    value = int(rank[part[0]])
                    if value not in waiting:
                        waiting[value] = []
                        heapq.heappush(heap, value)
                    waiting[value].append(part)

        look(np.arange(n))
        while heap:
            value = heapq.heappop(heap)
            places = np.unique(np.concatenate(waiting.pop(value)))
            places = places[alive[places] & (rank[places] == value)]
            if not len(places):
                continue
            # in a run of one symbol, the places that touch are taken in turn
            touch = np.zeros(len(places), dtype=bool)
            touch[1:] = after[places[:-1]] == places[1:]
            start = np.maximum.accumulate(np.where(touch, 0, np.arange(len(places))))
            places = places[(np.arange(len(places)) - start) % 2 == 0]
            gone = after[places]
            symbols[places] = self.made[value]
            alive[gone] = False
            rank[gone] = _NONE
            after[places] = after[gone]
            before[after[gone]] = places
            left = before[places]
            look(np.unique(np.concatenate([places, left[left < n]])))
        return symbols[alive[:n]].astype("<u4")


def every_other(flags: np.ndarray) -> np.ndarray:
    """The first, third, ... of each run of set flags."""
    at = np.arange(len(flags))
    start = flags.copy()
    start[1:] &= ~flags[:-1]
    return flags & ((at - np.maximum.accumulate(np.where(start, at, 0))) % 2 == 0)


class Splitter:
    """Words of a text by the vocabulary's pattern.

    The pattern's classes of characters depend on a Unicode version. Texts with a character that the
    pattern library and the vocabulary's library class differently are split by the latter.
    """

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer

        self.pattern = regex.compile(pattern)
        self.exact = Tokenizer.from_file(path).pre_tokenizer
        self.alike: set[str] = set()
        self.other: set[str] = set()

    def __call__(self, text: str) -> list[str]:
        if text.isascii():
            return _ASCII.findall(text)
        letters = set(text)
        for c in letters - self.alike - self.other:
            probe = f"a{c}1 {c}{c} b"
            here = [m.span() for m in self.pattern.finditer(probe)]
            there = [span for _, span in self.exact.pre_tokenize_str(probe)]
            (self.alike if here == there else self.other).add(c)
        if letters.isdisjoint(self.other):
            return self.pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.exact.pre_tokenize_str(text)]


def chunks(text: str, size: int):
    """Parts of a text of about ``size`` characters, cut where a word ends for sure: before a blank
    that follows another character than white space."""
    start = 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while at > 0 and text[at - 1].isspace():
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]


class Codec:
    """Encodes many texts at once and decodes ids. Words are remembered, ``KNOWN_WORDS`` at most."""

    def __init__(self, path: str, pattern: str, long_word: int = LONG_WORD, known: int = KNOWN_WORDS):
        self.vocabulary = Vocabulary(path)
        self.split = Splitter(path, pattern)
        self.long_word, self.most = long_word, known
        self.known: dict[str, bytes] = {}
        names = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.special_ids = {
            name: np.array([i], dtype="<u4").tobytes() for name, i in self.vocabulary.special.items()
        }

    def parts(self, text: str):
        """Chunks of a text, each with whether it is a special token."""
        pieces = self.special.split(text) if self.special else [text]
        for at, piece in enumerate(pieces):
            if at % 2:
                yield True, piece
            elif piece:
                for chunk in chunks(piece, CHUNK):
                    yield False, chunk

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids, as bytes, of all ``words``."""
        if len(self.known) + len(words) > self.most:
            self.known = {w: self.known[w] for w in words if w in self.known}
        new = [w for w in words if w not in self.known]
        coded = [w.encode() for w in new]
        short = [i for i, w in enumerate(coded) if len(w) <= self.long_word]
        if short:
            made = self.vocabulary.merge_words([coded[i] for i in short])
            for i, ids in zip(short, made, strict=True):
                self.known[new[i]] = ids.tobytes()
        for i, w in enumerate(coded):
            if len(w) > self.long_word:
                self.known[new[i]] = self.vocabulary.merge_long(w).tobytes()
        return self.known

    def encode(self, texts: list[str]):
        """For each text its ids as bytes (unsigned 32 bits, little-endian), in parts, one after
        another: pairs of (place of the text, ids). Every text has a part at least."""
        held, size = [], 0
        for place, text in enumerate(texts):
            held.append((place, b""))
            for special, chunk in self.parts(text):
                held.append((place, self.special_ids[chunk] if special else self.split(chunk)))
                size += len(chunk)
                if size >= CHUNK:
                    yield from self._encoded(held)
                    held, size = [], 0
        yield from self._encoded(held)

    def _encoded(self, held):
        known = self.learn(set(chain.from_iterable(w for _, w in held if isinstance(w, list))))
        for place, words in held:
            yield place, b"".join(map(known.__getitem__, words)) if isinstance(words, list) else words

    def bytes_of(self, ids: bytes) -> bytes:
        """The bytes that ids (as bytes) stand for; ids beyond the vocabulary stand for none."""
        tokens = self.vocabulary.tokens
        found = np.frombuffer(ids, dtype="<u4")
        if len(found) and int(found.max()) >= len(tokens):
            found = found[found < len(tokens)]
        return b"".join(map(tokens.__getitem__, found.tolist()))


def encode_texts(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    keep_ids: bool = False,
    keep_text: bool = False,
    long_word: int = LONG_WORD,
) -> DataFrame:
    """Ids of every whole text of ``docs`` (doc_id, text), and the text that they give again.

    One row per row of ``docs``: doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32 bits),
    decoded_sha256 (the decoded text in UTF-8); ``ids`` and ``decoded`` if asked for. ``vocabulary`` is
    a byte-level BPE file that executors can read, ``pattern`` splits texts into words. Strings of
    special tokens in a text are those tokens. Null and empty texts have no ids. Repeated rows and
    null ids are rows as any; other columns of ``docs`` do not matter. An empty table gives no rows.
    Nothing is shuffled, and a task holds about ``CHUNK`` characters of words at a time.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
        + (", ids array<bigint>" if keep_ids else "")
        + (", decoded string" if keep_text else "")
    )
    out = pa_schema(docs.sparkSession, schema)

    def run(batches):
        codec = Codec(vocabulary, pattern, long_word)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            counts = [0] * len(texts)
            ids_sums = [hashlib.sha256() for _ in texts]
            text_sums = [hashlib.sha256() for _ in texts]
            readers = [codecs.getincrementaldecoder("utf-8")("replace") for _ in texts]
            kept_ids = [[] for _ in texts]
            kept_text = [[] for _ in texts]
            for place, ids in codec.encode(texts):
                counts[place] += len(ids) // 4
                ids_sums[place].update(ids)
                decoded = readers[place].decode(codec.bytes_of(ids))
                text_sums[place].update(decoded.encode())
                if keep_ids:
                    kept_ids[place] += np.frombuffer(ids, dtype="<u4").tolist()
                if keep_text:
                    kept_text[place].append(decoded)
            for place, reader in enumerate(readers):
                rest = reader.decode(b"", True)
                text_sums[place].update(rest.encode())
                kept_text[place].append(rest)
            columns = [
                batch.column("doc_id"),
                counts,
                [s.hexdigest() for s in ids_sums],
                [s.hexdigest() for s in text_sums],
            ]
            columns += [kept_ids] if keep_ids else []
            columns += [["".join(t) for t in kept_text]] if keep_text else []
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, out, strict=True)],
                schema=out,
            )

    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(run, schema)


def decode_ids(rows: DataFrame, vocabulary: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the text of the ids in ``ids_col``, special tokens included.

    Bytes that are no UTF-8 become U+FFFD; null lists give null, null ids and ids that the vocabulary
    does not have give nothing. A column ``decoded`` is replaced.
    """
    kept = [c for c in rows.columns if c != "decoded"]
    source = rows.select(*[F.col(f"`{c}`") for c in kept])
    schema = source.withColumn("decoded", F.lit(None).cast("string")).schema

    def run(batches):
        codec = Codec(vocabulary, pattern)
        for batch in slices(batches):
            texts = [
                None
                if ids is None
                else codec.bytes_of(
                    np.array([i for i in ids if i is not None and 0 <= i < 1 << 32], dtype="<u4").tobytes()
                ).decode("utf-8", "replace")
                for ids in batch.column(ids_col).to_pylist()
            ]
            yield batch.append_column("decoded", pa.array(texts, pa.string()))

    return source.mapInArrow(run, schema)
