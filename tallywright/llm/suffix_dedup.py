"""Removal of repeated byte strings with suffix arrays, over a corpus of any size.

Every window of ``length`` bytes is assigned to its anchor, the substring of ``SEED`` bytes in it
whose hash is least: equal windows have equal anchors at equal offsets. So repeats are found by
meeting anchors, and only anchors that occur twice are looked at further.

* The windows of one anchor form a run with a common stretch of text. Runs whose stretches are equal
  as a whole are settled by the first of them, with one aggregation.
* Where an anchor stands in different stretches, these are compared in a suffix array, which linear
  grouping builds (see suffix_array), and the longest match with an earlier stretch decides each
  window. Bytes between two places where stretches part are one symbol there.
* Where very many stretches share an anchor, their windows are settled by one aggregation over window
  hashes instead, so that no anchor gathers its stretches in one task.
"""

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, scratch, slices, with_key
from .suffix_array import longest_earlier, suffix_array

LENGTH = 100
SEED = 24
CROWD = 4096  # different stretches of one anchor beyond which windows are hashed
_CHUNK = 1 << 20  # bytes of a text that are looked at together
_BUFFER = 1 << 19  # bytes of short texts that are
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BASE_2 = 0xD6E8FEB86659FD93
_INVERSE_2 = pow(_BASE_2, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53), (33, 1)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x


class Hashes:
    """Hashes of any substrings of a piece of text, from sums of powers modulo 2^64."""

    def __init__(self):
        self.size = 0

    def load(self, data: np.ndarray, second: bool = True) -> None:
        n = len(data) + 1
        if n > self.size:
            self.size = max(n, 1 << 16)
            self.powers = [
                (_powers(b, self.size), _powers(i, self.size))
                for b, i in ((_BASE, _INVERSE), (_BASE_2, _INVERSE_2))
            ]
        letters = data.astype(np.uint64) + np.uint64(1)
        values = [letters]
        if second:  # squares, as they tell more strings apart than the letters alone
            values.append(letters * letters + np.uint64(77))
        self.sums = []
        for (power, _), value in zip(self.powers, values, strict=False):
            sums = np.zeros(n, np.uint64)
            np.cumsum(value * power[: n - 1], out=sums[1:])
            self.sums.append(sums)

    def of(self, starts: np.ndarray, stops: np.ndarray, which: int = 0) -> np.ndarray:
        sums, inverse = self.sums[which], self.powers[which][1]
        return _mix((sums[stops] - sums[starts]) * inverse[starts])

    def all(self, size: int) -> np.ndarray:
        """Hashes of every substring of ``size`` bytes."""
        sums, inverse = self.sums[0], self.powers[0][1]
        return _mix((sums[size:] - sums[:-size]) * inverse[: len(sums) - size])


def anchor_places(hashes: Hashes, length: int, seed: int) -> np.ndarray:
    """For each window of the loaded bytes the place of its anchor: the least hash, and of equal ones
    the first place."""
    low = np.uint64((1 << 24) - 1)
    least = hashes.all(seed) & ~low
    least |= np.arange(len(least), dtype=np.uint64)
    wide, span = length - seed + 1, 1
    while 2 * span <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if rest := wide - span:
        least = np.minimum(least[:-rest], least[rest:])
    return (least & low).astype(np.int64)


def chunks(data: bytes, length: int):
    """(offset, part): parts of long texts that share all but one byte of a window at their ends."""
    for at in range(0, max(1, len(data) - length + 1), _CHUNK):
        yield at, data[at : at + _CHUNK + length - 1]


def buffers(batches, length: int):
    """Lists of (key, offset, bytes): texts or parts of them, together of some size."""
    held, size = [], 0
    for batch in slices(batches):
        for key, text in zip(batch[KEY].to_pylist(), batch["text"].to_pylist(), strict=True):
            for offset, part in chunks((text or "").encode(), length):
                if len(part) < length:
                    continue
                held.append((key, offset, part))
                size += len(part)
                if size >= _BUFFER:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def anchors(docs: DataFrame, length: int, seed: int, stretches: bool) -> DataFrame:
    """One row per run: h, the hash of its anchor; with ``stretches`` also c, the hash of the bytes
    that its windows cover, __row_key, and meta: first window, number of windows less one, and offset
    of the anchor, packed."""
    if length - seed > 255:
        raise ValueError("length may exceed the seed by 255 at most")
    names = ["h", "c", KEY, "meta"] if stretches else ["h"]

    def work(batches):
        hashes = Hashes()
        for held in buffers(batches, length):
            keys = np.array([k for k, _, _ in held])
            offsets = np.array([o for _, o, _ in held])
            sizes = np.array([len(p) for _, _, p in held])
            begins = np.cumsum(sizes) - sizes
            hashes.load(np.frombuffer(b"".join(p for _, _, p in held), np.uint8), stretches)
            # starts of the windows that lie in one text
            count = sizes - length + 1
            text = np.repeat(np.arange(len(held)), count)
            start = np.arange(len(text)) + (begins - (np.cumsum(count) - count))[text]
            place = anchor_places(hashes, length, seed)[start]
            head = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
            tail = np.r_[head[1:], len(place)] - 1
            place, first, last, text = place[head], start[head], start[tail], text[head]
            columns = [hashes.of(place, place + seed).view(np.int64)]
            if stretches:
                inside = (place - first).astype(np.uint64)
                c = hashes.of(first, last + length)
                c ^= _mix(hashes.of(first, last + length, 1) + inside)
                at = first - begins[text] + offsets[text]
                meta = (at << 16) | ((last - first) << 8) | (place - first)
                columns += [c.view(np.int64), keys[text], meta]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)

    return docs.select(KEY, "text").mapInArrow(work, ", ".join(f"{n} bigint" for n in names))


def unpack(meta: int) -> tuple[int, int, int]:
    """First window, number of windows less one, anchor offset."""
    return meta >> 16, (meta >> 8) & 255, meta & 255


# --- stretches of one anchor -----------------------------------------------------------------------


def _common(a: list[bytes]) -> np.ndarray:
    """Lengths of the common openings of neighbours in a list."""
    out = np.zeros(max(0, len(a) - 1), np.int64)
    for i in range(len(out)):
        x, y = a[i], a[i + 1]
        n = min(len(x), len(y))
        if x[:n] == y[:n]:
            out[i] = n
            continue
        lo, hi = 0, n  # the first lo bytes are equal, those up to hi are not
        while hi - lo > 1:
            mid = (lo + hi) // 2
            if x[lo:mid] == y[lo:mid]:
                lo = mid
            else:
                hi = mid
        out[i] = lo
    return out


def _branches(sides: list[bytes]) -> tuple[list[int], list[list[int]]]:
    """The depths at which some of the strings part, and for each string the group that it belongs to
    at each depth up to the deepest that it shares with another."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    common = _common([sides[i] for i in order])
    depths = sorted(set(common[common > 0].tolist()))
    groups: list[list[int]] = [[] for _ in sides]
    for depth in depths:
        joined = common >= depth
        number = np.r_[0, np.cumsum(~joined)]
        shares = np.r_[False, joined] | np.r_[joined, False]
        for k in np.flatnonzero(shares):
            groups[order[k]].append(int(number[k]))
    return depths, groups


def windows_seen_earlier(buckets, length: int):
    """For buckets of stretches (in order of row and place) that share an anchor: (bucket, member,
    first, last) offsets before the anchor of windows that an earlier member holds too.

    ``buckets`` are lists of (left, right): the bytes before the anchor, and from it on. All buckets
    go through one suffix array; their symbols differ.
    """
    text: list[int] = []
    starts = []  # per member: bucket, member, left depths, right depths, place of its first symbol
    symbols: dict = {}
    for b, members in enumerate(buckets):
        left_depths, left = _branches([m[0][::-1] for m in members])
        right_depths, right = _branches([m[1] for m in members])
        for i in range(len(members)):
            lefts, rights = left[i], right[i]
            if not rights:
                continue
            reach = right_depths[len(rights) - 1] + (left_depths[len(lefts) - 1] if lefts else 0)
            if reach < length:
                continue
            starts.append((b, i, left_depths[: len(lefts)], right_depths, len(text)))
            for t in range(len(lefts) - 1, -1, -1):
                text.append(symbols.setdefault((b, 0, t, lefts[t]), len(symbols)))
            for t, g in enumerate(rights):
                text.append(symbols.setdefault((b, 1, t, g), len(symbols)))
            text.append(symbols.setdefault((b, 2, i), len(symbols)))
    if not starts:
        return
    text = [x + 1 for x in text] + [0]
    earlier = longest_earlier(text, suffix_array(np.array(text)))
    for b, i, left_depths, right_depths, at in starts:
        n = len(left_depths)
        # windows that start in the stretch between two depths on the left, or at the anchor itself
        for t in range(n, -1, -1):
            matched = earlier[at + n - t][0]
            if matched <= t:
                continue
            deep = left_depths[t - 1] if t else 0
            shallow = (left_depths[t - 2] if t > 1 else 0) + 1 if t else 0
            most = right_depths[matched - t - 1]
            if (least := max(shallow, length - most)) <= deep:
                yield b, i, least, deep


def settle(stretches: DataFrame, length: int) -> DataFrame:
    """(__row_key, start, stop): bytes of windows that an earlier stretch of the same anchor holds.

    ``stretches`` has h, __row_key, meta and bytes; the stretches of an anchor are brought together.
    """

    def work(batches):
        rest: list = []  # rows of the anchor that the last batch may have cut

        def flush(rows):
            buckets, members = [], []
            for _, group in groupby(rows, key=lambda r: r[0]):
                own = sorted(group, key=lambda r: (r[1], unpack(r[2])[0] + unpack(r[2])[2]))
                cut = [(unpack(r[2])[2], r[3]) for r in own]
                buckets.append([(s[:a], s[a:]) for a, s in cut])
                members.append(own)
            out = []
            for b, i, least, deep in windows_seen_earlier(buckets, length):
                _, key, meta, _ = members[b][i]
                first, _, offset = unpack(meta)
                anchor = first + offset
                out.append((key, anchor - deep, anchor - least + length))
            keys, begins, ends = zip(*out, strict=True) if out else ([], [], [])
            return pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (keys, begins, ends)],
                names=[KEY, "start", "stop"],
            )

        for batch in batches:
            rows = rest + list(
                zip(*[batch[c].to_pylist() for c in ("h", KEY, "meta", "bytes")], strict=True)
            )
            last = rows[-1][0] if rows else None
            cut = next((i for i in range(len(rows), 0, -1) if rows[i - 1][0] != last), 0)
            rest = rows[cut:]
            if cut:
                yield flush(rows[:cut])
        if rest:
            yield flush(rest)

    parts = int(stretches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        stretches.select("h", KEY, "meta", "bytes")
        .repartition(parts, "h")
        .sortWithinPartitions("h")
        .mapInArrow(work, f"{KEY} bigint, start bigint, stop bigint")
    )


def settle_by_hash(stretches: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many stretches: an aggregation over the hashes of windows."""

    def work(batches):
        hashes = Hashes()
        for batch in slices(batches):
            out = []
            for key, meta, data in zip(*[batch[c].to_pylist() for c in (KEY, "meta", "bytes")], strict=True):
                first, more, _ = unpack(meta)
                hashes.load(np.frombuffer(data, np.uint8))
                at = np.arange(more + 1)
                w = [hashes.of(at, at + length, k).view(np.int64) for k in (0, 1)]
                out.append((*w, np.full(more + 1, key), first + at))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in zip(*out, strict=True)],
                    names=["w1", "w2", KEY, "start"],
                )

    windows = stretches.select(KEY, "meta", "bytes").mapInArrow(
        work, f"w1 bigint, w2 bigint, {KEY} bigint, start bigint"
    )
    place = F.struct(KEY, "start")
    firsts = scratch(
        windows.groupBy(F.col("w1").alias("f1"), F.col("w2").alias("f2"))
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1"),
        "windows",
    )
    return (
        windows.join(firsts, (F.col("w1") == F.col("f1")) & (F.col("w2") == F.col("f2")))
        .where(place != F.col("first"))
        .select(KEY, "start", (F.col("start") + length).alias("stop"))
    )


# --- the operator ----------------------------------------------------------------------------------


def repeated_bytes(
    docs: DataFrame, packed: DataFrame, length: int, seed: int, crowd: int
) -> DataFrame:
    """(__row_key, start, stop): stretches of bytes whose windows all start earlier too. ``packed``
    has the texts of ``docs`` compressed, as z."""
    # written, as are other aggregates that are joined on their key: a join with an aggregate in the
    # same stage could not be split where a key is hot
    twice = scratch(
        anchors(docs, length, seed, stretches=False)
        .groupBy(F.col("h").alias("h2"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("h2"),
        "twice",
    )
    found = anchors(docs, length, seed, stretches=True)
    live = scratch(found.join(twice, F.col("h") == F.col("h2"), "left_semi"), "anchors")
    place = F.struct(KEY, "meta")
    kinds = scratch(
        live.groupBy("h", "c").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")),
        "stretches",
    )
    again = kinds.where("n > 1").select(
        F.col("h").alias("h2"), F.col("c").alias("c2"), F.col("first").alias("first")
    )
    begin = F.shiftright("meta", 16)
    windows = F.shiftright("meta", 8).bitwiseAND(F.lit(255))
    copies = (
        live.join(again, (F.col("h") == F.col("h2")) & (F.col("c") == F.col("c2")))
        .where(place != F.col("first"))
        .select(KEY, begin.alias("start"), (begin + windows + length).alias("stop"))
    )
    several = scratch(
        kinds.groupBy(F.col("h").alias("h2")).agg(F.count(F.lit(1)).alias("m")).where("m > 1"),
        "several",
    )
    wanted = (
        kinds.join(several, F.col("h") == F.col("h2"))
        .select("h", F.col("m") > crowd, F.col(f"first.{KEY}").alias("w_key"), "first.meta")
        .toDF("h", "crowded", "w_key", "meta")
        .groupBy("w_key")
        .agg(F.collect_list(F.struct("h", "crowded", "meta")).alias("wanted"))  # of one document
    )

    def take(batches):
        unzip = zstandard.ZstdDecompressor()
        for batch in slices(batches):
            out = []
            for key, z, rows in zip(*[batch[c].to_pylist() for c in (KEY, "z", "wanted")], strict=True):
                data = unzip.decompress(z)
                for r in rows:
                    first, more, _ = unpack(r["meta"])
                    out.append((r["h"], r["crowded"], key, r["meta"], data[first : first + more + length]))
            types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
            columns = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["h", "crowded", KEY, "meta", "bytes"],
            )

    stretches = scratch(
        packed.select(KEY, "z")
        .join(wanted, F.col(KEY) == F.col("w_key"))
        .select(KEY, "z", "wanted")
        .mapInArrow(take, f"h bigint, crowded boolean, {KEY} bigint, meta bigint, bytes binary"),
        "bytes",
    )
    return copies.union(settle(stretches.where("not crowded"), length)).union(
        settle_by_hash(stretches.where("crowded"), length)
    )


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    seed: int = SEED,
    crowd: int = CROWD,
    keep_bytes: bool = True,
) -> DataFrame:
    """Remove every byte of a ``length``-byte string that also starts earlier in the corpus.

    Earlier is the smaller id, or the same row and an earlier start; overlaps count, and strings are
    those of the input. Columns: __row_key, doc_id, n_bytes, n_removed, n_spans, kept_sha256, and
    the bytes that stay if asked for. Null texts are empty; texts shorter than ``length`` stay whole.
    Of rows with the same id and text the first keeps its bytes. An empty table gives no rows.
    """
    keyed = with_key(docs)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def pack(batches):
        zip_ = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches):
            data = [zip_.compress((t or "").encode()) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch[KEY], batch["doc_id"], pa.array(data, pa.binary())], names=[KEY, "doc_id", "z"]
            )

    packed = keyed.select(KEY, "doc_id", "text").mapInArrow(
        pack, f"{KEY} bigint, doc_id {id_type}, z binary"
    )
    gone = (
        repeated_bytes(keyed, packed, length, seed, crowd)
        .groupBy(F.col(KEY).alias("g_key"))
        .agg(F.collect_list(F.struct("start", "stop")).alias("gone"))  # of one document
    )

    def cut(batches):
        unzip = zstandard.ZstdDecompressor()
        for batch in slices(batches):
            out = []
            for z, gone in zip(batch["z"].to_pylist(), batch["gone"].to_pylist(), strict=True):
                data = unzip.decompress(z)
                kept, reach, spans, removed = [], 0, 0, 0
                end = -1
                for start, stop in sorted((g["start"], g["stop"]) for g in gone or ()):
                    if start > end:
                        spans += 1
                        kept.append(data[reach:start])
                        end = stop
                        removed += stop - start
                    elif stop > end:
                        removed += stop - end
                        end = stop
                    reach = end
                kept = b"".join([*kept, data[reach:]])
                row = (len(data), removed, spans, hashlib.sha256(kept).hexdigest())
                out.append((*row, kept) if keep_bytes else row)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 4 + keep_bytes]
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            made = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch[KEY], batch["doc_id"], *made], names=[KEY, "doc_id", *names]
            )

    schema = (
        f"{KEY} bigint, doc_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint,"
        " kept_sha256 string" + (", kept binary" if keep_bytes else "")
    )
    return (
        packed.join(gone, F.col(KEY) == F.col("g_key"), "left")
        .select(KEY, "doc_id", "z", "gone")
        .mapInArrow(cut, schema)
    )
