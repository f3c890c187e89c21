"""Line dedup: an edit-distance join of lines by segment partition.

How many edits are allowed follows from the length of the shorter line. Lines of a length class are
split into one segment more than the edits of that class, so two lines within that distance share a
segment, near the same distance from the start or from the end. Segments stand in an index under
their class, number and content; a line looks up its own class, and the class below where it is
short enough, at the few starts that can matter. Lines that meet are compared where they meet, in
groups of a bounded size: counts of characters tell most of them apart, the edit distance decides.
Lines that are linked form classes, of which the first line stays.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KEY, as_before, cut_lines, scratch, slices, with_rest
from .components import connected_components

EDITS = ((0, 1), (80, 2), (120, 3))  # (least length, edits): for the shorter of two lines
MIN_CHARS = 20
CROWD = 64  # lines under one segment beyond which not all near pairs are given
GATHER = 16  # crowds of lines that one group compares
GATHER_CHARS = 1 << 24  # characters that one group compares
TILES = 8  # parts of a crowd beyond which it is split by hubs and further segments
DEPTH = 4  # further segments by which such a crowd is split
BROADCAST_IDS = 500_000
_BLANK = " \t\r\v\f"
_LONGEST = 1 << 20  # lengths from here on are one class


def _agree(a: str, i: int, b: str, j: int) -> int:
    """How many characters of ``a`` from i on and ``b`` from j on are the same."""
    n = min(len(a) - i, len(b) - j)
    at, step = 0, 8
    while at < n and a[i + at : i + at + step] == b[j + at : j + at + step]:
        at += step
        step *= 2
    while step > 1 and at < n:
        step //= 2
        if at + step <= n and a[i + at : i + at + step] == b[j + at : j + at + step]:
            at += step
    return min(at, n)


def within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance of two strings is at most ``most``.

    For each number of edits, the furthest place of the first string that each diagonal reaches;
    equal characters are passed by comparing slices.
    """
    last = len(b) - len(a)  # the diagonal on which both end
    if abs(last) > most:
        return False
    reach = {0: _agree(a, 0, b, 0)}
    for edits in range(1, most + 1):
        if reach.get(last) == len(a):
            return True
        left, now = most - edits, {}
        for d in range(max(-edits, last - left), min(edits, last + left) + 1):
            i = max(reach.get(d, -2) + 1, reach.get(d + 1, -2) + 1, reach.get(d - 1, -1))
            i = min(i, len(a), len(b) - d)
            if i >= 0 and i + d >= 0:
                now[d] = i + _agree(a, i, b, i + d)
        reach = now
    return reach.get(last) == len(a)


def lines_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """Every line of ``min_chars`` or more, trimmed: key, number, line, id (128 bits), h (64 bits)."""
    # trimmed before they are exploded, so that no later expression trims again
    raw = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    trimmed = F.transform(raw, lambda x: F.btrim(x, F.lit(_BLANK)))
    return (
        docs.select(KEY, F.posexplode(trimmed).alias("no", "line"))
        .where(F.char_length("line") >= min_chars)
        .withColumn("h", F.xxhash64("line"))
        .withColumn("id", F.struct("h", F.xxhash64(F.lit("second"), "line").alias("h2")))
    )


def allowed(length: int, steps: tuple) -> int:
    return [edits for least, edits in steps if length >= least][-1]


def length_classes(steps: tuple) -> list[tuple[int, int]]:
    """(least length, edits) of each class; neighbours are far enough apart for their edits."""
    out = [(0, steps[0][1])]
    for (least, edits), (above, _) in zip(steps, [*steps[1:], (_LONGEST, 0)], strict=True):
        at = max(least, edits + 1)
        while at + edits <= above:
            out.append((at, edits))
            at = max(3 * at // 2, at + edits)
    return out


def _parts(classes: list[tuple[int, int]], offsets: tuple[int, ...]) -> list[tuple]:
    """(place of the class, *_PART) of each segment that lines of a class look up.

    The first segment without an edit has as many edits before it as segments, so it is displaced by
    no more than its number, nor by more than the edits that are left for those after it. It is
    counted from the nearer end; the text on its other side holds at most ``left_over`` edits. A line looks up the classes at
    ``offsets`` from its own where its length (least to most) allows a partner there.
    """
    out = []
    for own in range(len(classes)):
        for offset in offsets:
            if not 0 <= own + offset < len(classes):
                continue
            bound, edits = classes[own + offset]
            least = bound - edits if offset > 0 else 0
            most = classes[own][0] + edits - 1 if offset < 0 else (1 << 31) - 1
            size = bound // (edits + 1)
            for i in range(edits + 1):
                front = i <= edits - i
                spread = min(i, edits - i)
                start = 1 + (i * size if front else -(edits + 1 - i) * size)
                over = edits - i if front else i
                for shift in range(-spread, spread + 1):
                    mine = offset == 0 and shift == 0
                    out.append((own, bound, edits, i, size, start + shift, front, mine, over, least, most))
    return out


_PART = (
    "part int, bound int, edits int, i int, size int, start int, front boolean, mine boolean,"
    " over int, least int, most int"
)


def _place(n: Column, classes: list[tuple[int, int]]) -> Column:
    """The place in ``classes`` of a line of ``n`` characters."""
    place = F.lit(0)
    for i, (bound, _) in enumerate(classes[1:], 1):
        place = F.when(n < bound, i - 1) if i == 1 else place.when(n < bound, i - 1)
    return place.otherwise(len(classes) - 1) if len(classes) > 1 else place


def segment_rows(
    rows: DataFrame, steps: tuple | dict, offsets: tuple[int, ...] = (0, -1), rest: bool = False
) -> DataFrame:
    """The segments of ``rows`` (k, h, own, line): index entries (own) and other places looked up.

    ``steps`` holds for all rows, or is given for each value of the column left_over; other rows have no segments. The segments
    of all classes (a few thousand rows at most, whatever the corpus) are a table sent to the lines.
    Columns: k (of segment and the k before), h, own, and the length of the line (chars) or, with ``rest``,
    edits of the class, left_over, the text on the far side of the segment (rest) and other columns of ``rows``.
    """
    kinds = steps if isinstance(steps, dict) else {None: steps}
    n_before, parts, part = 0, [], F.lit(None).cast("int")
    for kind, of_kind in kinds.items():
        classes = length_classes(of_kind)
        parts += [(n_before + own, *others) for own, *others in _parts(classes, offsets)]
        place = _place(F.col("n"), classes) + n_before
        part = place if kind is None else F.when(F.col("left_over") == kind, place).otherwise(part)
        n_before += len(classes)
    known = ("k", "h", "own", "line", "left_over")
    others = [c for c in rows.columns if c not in known] if rest else []
    cut = (
        rows.withColumn("n", F.char_length("line"))
        .select("k", "h", "own", "line", "n", part.alias("part"), *others)
        .join(F.broadcast(rows.sparkSession.createDataFrame(parts, _PART)), "part")
        .where("n BETWEEN least AND most")
        .withColumn("at", F.expr("start + if(front, 0, n)"))
        .where("size = 0 OR (at >= 1 AND at + size - 1 <= n)")
    )
    found = [
        F.xxhash64("k", "bound", "i", F.expr("if(size = 0, '', substr(line, at, size))")).alias("k"),
        "h",
        (F.col("own") & F.col("mine")).alias("own"),
    ]
    if rest:
        far = F.expr("if(front, substr(line, at + size), substr(line, 1, greatest(at - 1, 0)))")
        found += ["edits", F.col("over").alias("left_over"), far.alias("rest"), *others]
    else:
        found.append(F.col("n").alias("chars"))
    return cut.select(*found)


def _crowd_codes(batches):
    """(c, own, h) for each (h, line): codes that only lines at distance 1 share.

    A line without one character, the place kept, is shared with lines that differ in that character. A
    line without one character is also the code, as a whole line, of the line that lacks it.
    """
    import pyarrow as pa
    import xxhash

    digest = xxhash.xxh64_intdigest
    for batch in slices(batches):
        for h, line in zip(batch["h"].to_pylist(), batch["line"].to_pylist(), strict=True):
            codes, own = [digest(line, 2)], [True]
            previous = None
            for i, c in enumerate(line):
                rest = line[:i] + line[i + 1 :]
                codes.append(digest(f"{i}:{len(line)}:{rest}", 3))
                own.append(False)
                if c != previous:  # dropping the next of equal letters gives the same line
                    codes.append(digest(rest, 2))
                    own.append(False)
                previous = c
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x - (1 << 64) if x >> 63 else x for x in codes], pa.int64()),
                    pa.array(own),
                    pa.array([h] * len(codes), pa.int64()),
                ],
                names=["c", "own", "h"],
            )


def _verified(pairs: DataFrame, known: DataFrame, steps: tuple) -> DataFrame:
    """(a, b, id_a, id_b) of the pairs whose texts are near enough; no pair is given twice."""
    side = lambda s: known.select(
        F.col("h").alias(f"h_{s}"), F.col("id").alias(f"id_{s}"), F.col("line").alias(f"line_{s}")
    )
    both = (
        pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a != b")
        .distinct()
        .join(side("a"), F.col("a") == F.col("h_a"))
        .join(side("b"), F.col("b") == F.col("h_b"))
    )

    def verify(batches):
        import pyarrow as pa

        for batch in batches:
            near = [
                within(x, y, allowed(min(len(x), len(y)), steps))
                for x, y in zip(batch["line_a"].to_pylist(), batch["line_b"].to_pylist(), strict=True)
            ]
            yield batch.select(["a", "b", "id_a", "id_b"]).filter(pa.array(near, pa.bool_()))

    kind = known.schema["id"].dataType.simpleString()
    return both.select("a", "b", "id_a", "id_b", "line_a", "line_b").mapInArrow(
        verify, f"a bigint, b bigint, id_a {kind}, id_b {kind}"
    )


def _tiles(size: Column, chars: Column, crowd: int) -> Column:
    """Parts of a group of ``size`` lines, so that two of them are small enough to be compared in one task."""
    return F.ceil(F.greatest(size / F.lit(max(1, GATHER * crowd)), chars / F.lit(GATHER_CHARS))).cast("int")


def _near_rows(lines: list[str], mine: list, reached: list, side: list, steps: tuple, crowd: int):
    """(i, j) of near lines of a group; beyond ``crowd`` lines, only as many as connect them."""
    import numpy as np

    n = len(lines)
    mine, reached, side = np.array(mine), np.array(reached), np.array(side)
    sizes = np.array([len(x) for x in lines])
    if n > 3:
        # code points by remainder: an edit changes two counts by one, or one
        points = [np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32) & 31 for x in lines]
        counts = np.stack([np.bincount(x, minlength=32) for x in points]).astype(np.int32)
    root = list(range(n)) if n > crowd else None

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(n - 1):
        most = allowed(int(sizes[i]), steps)  # no fewer than for a shorter line
        meets = (mine[i + 1 :] | mine[i]) & ~(reached[i + 1 :] & reached[i])
        meets &= (side[i + 1 :] != side[i]) | (side[i] < 0)
        meets &= np.abs(sizes[i + 1 :] - sizes[i]) <= most
        others = i + 1 + np.flatnonzero(meets)
        if n > 3 and len(others):
            others = others[np.abs(counts[others] - counts[i]).sum(axis=1) <= 2 * most]
        for j in others.tolist():
            if root is not None and top(i) == top(j):
                continue
            if within(lines[i], lines[j], allowed(int(min(sizes[i], sizes[j])), steps)):
                if root is not None:
                    root[top(i)] = top(j)
                yield i, j


def _compared(groups: DataFrame, known: DataFrame, steps: tuple, crowd: int) -> DataFrame:
    """(a, b, id_a, id_b) of near lines under one k, one of them in the index, not both reached by a hub.

    ``groups`` (k, h, own, reached, tiles) have a row for each line of a group. A group of several tiles
    meets by twos of them, so that no task holds more than two; the lines of a k are sent as many times
    as it has tiles.
    """
    tile = F.pmod("h", "tiles").cast("int")
    lo, hi = F.least("tile", "other"), F.greatest("tile", "other")
    placed = (
        groups.join(known.select(F.col("h").alias("w"), "id", "line"), F.col("h") == F.col("w"))
        .withColumn("tile", tile)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            F.when(F.col("tiles") == 1, F.col("k")).otherwise(F.xxhash64("k", lo, hi)).alias("k"),
            F.when(F.col("tile") == F.col("other"), -1).when(F.col("tile") == lo, 0).otherwise(1).alias("side"),
            "own",
            "reached",
            "h",
            "id",
            "line",
        )
        .repartition("k")
        .sortWithinPartitions("k")
    )

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def near(group):
            h, ids = group["h"].to_pylist(), group["id"]
            fields = [group[c].to_pylist() for c in ("line", "own", "reached", "side")]
            found = [(i, j) if h[i] < h[j] else (j, i) for i, j in _near_rows(*fields, steps, crowd) if h[i] != h[j]]
            if found:
                a, b = (pa.array(x, pa.int64()) for x in zip(*found, strict=True))
                columns = [group["h"].take(a), group["h"].take(b), ids.take(a), ids.take(b)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "id_a", "id_b"])

        held = []  # what has come of the last group
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch["k"].to_numpy()
            starts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()]
            if held and held[-1]["k"][0].as_py() != keys[0]:
                yield from near(_joined(held))
                held = []
            for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                held.append(batch.slice(start, end - start))
                if end < batch.num_rows:
                    if len(held) > 1 or end - start > 1:
                        yield from near(_joined(held))
                    held = []
        if held:
            yield from near(_joined(held))

    kind = known.schema["id"].dataType.simpleString()
    return placed.mapInArrow(run, f"a bigint, b bigint, id_a {kind}, id_b {kind}")


def _joined(batches: list):
    """Record batches as one."""
    import pyarrow as pa

    if len(batches) == 1:
        return batches[0]
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _crowd_links(
    rows: DataFrame, known: DataFrame, steps: tuple, crowd: int, depth: int
) -> tuple[list[DataFrame], list[DataFrame]]:
    """(links of hubs, other links) of crowds: ``rows`` (k, h, own, left_over, rest, chars).

    All of a crowd are compared with one of them, its hub. Where some are not reached, the crowd is
    split by segments of the text that is left, and lines meet again where they share one more,
    unless the hub has reached both. Groups that are still crowded are crowds in their turn. What is
    crowded at the last depth is compared tile by tile with the lines the hub has not reached.
    """
    links, near_rows = [], []
    in_group = [F.max("own").alias("own"), F.max("reached").alias("reached"), F.max("tiles").alias("tiles")]
    rows = scratch(rows.withColumn("reached", F.lit(False)), "crowds")
    by_edits = {edits: ((0, edits),) for edits in range(1, max(edits for _, edits in steps) + 1)}
    for level in range(depth + 1):
        hubs = rows.groupBy("k").agg(F.min(F.struct(~F.col("reached"), "h"))["h"].alias("hub"))
        members = scratch(rows.join(hubs, "k"), "members")
        stars = members.where("NOT reached").select(F.col("hub").alias("a"), F.col("h").alias("b"))
        links.append(scratch(_verified(stars, known, steps), "stars"))
        star = links[-1].select("a", "b").distinct()
        near = members.join(
            star.withColumn("star", F.lit(True)),
            (F.least("hub", "h") == F.col("a")) & (F.greatest("hub", "h") == F.col("b")),
            "left",
        ).withColumn("reached", F.col("reached") | (F.col("h") == F.col("hub")) | F.col("star").isNotNull())
        near = scratch(near.drop("a", "b", "star", "hub"), "reached")
        open_ = near.where("NOT reached").select("k").distinct()
        near = near.join(open_, "k", "left_semi")
        if level == depth:
            sizes = near.groupBy("k").agg(
                _tiles(F.count(F.lit(1)), F.sum("chars"), crowd).alias("tiles")
            )
            last = near.join(sizes, "k").groupBy("k", "h").agg(*in_group)
            near_rows.append(scratch(_compared(last, known, steps, crowd), "near"))
            break
        source = near.select("k", "h", "own", F.col("rest").alias("line"), "reached", "left_over", "chars")
        parts = scratch(segment_rows(source, by_edits, (0, -1, 1), rest=True), "split")
        sizes = parts.groupBy("k").agg(
            F.count_distinct("h").alias("size"),
            _tiles(F.count_distinct("h"), F.sum("chars"), crowd).alias("tiles"),
            F.max("own").alias("owned"),
            F.min("reached").alias("all_reached"),
        )
        sized = scratch(
            parts.join(sizes.where("size > 1 AND owned AND NOT all_reached"), "k").select(
                "k", "h", "own", "left_over", "rest", "reached", "chars", "tiles"
            ),
            "sized",
        )
        few = sized.where(F.col("tiles") <= TILES).groupBy("k", "h").agg(*in_group)
        near_rows.append(scratch(_compared(few, known, steps, crowd), "near"))
        rows = sized.where(F.col("tiles") > TILES).drop("tiles")
        if rows.isEmpty():
            break
    return links, near_rows


def line_links(
    lines: DataFrame, edits: int | tuple = EDITS, crowd: int = CROWD, depth: int = DEPTH
) -> DataFrame:
    """Links (a, b) between the ids of different lines that are near enough.

    ``edits`` is a number, or (least length, number) for the shorter line. All such pairs are
    linked, but for lines of which more than ``crowd`` share a segment: each line is still connected with
    all its neighbours. Where they are more than ``TILES`` groups, lines within one edit
    are linked by codes, if one is allowed, and others through hubs and further segments
    (``_crowd_links``).
    """
    steps = ((0, edits),) if isinstance(edits, int) else tuple(edits)
    start = lines.select(F.lit(0).cast("bigint").alias("k"), "h", F.lit(True).alias("own"), "line")
    rows = scratch(segment_rows(start, steps), "substrings")
    live = (
        rows.groupBy("k")
        .agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.max("own").alias("owned"))
        .where("owned and lo != hi")
        .select("k")
    )
    met = scratch(
        rows.join(live, "k")
        .groupBy("k", "h")
        .agg(F.max("own").alias("own"), F.max("chars").alias("chars")),
        "segments",
    )
    sizes = met.groupBy("k").agg(_tiles(F.count(F.lit(1)), F.sum("chars"), crowd).alias("tiles"))

    wanted = met.select(F.col("h").alias("w")).distinct()
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    known = scratch(
        lines.select("h", "id", "line")
        .join(wanted, F.col("h") == F.col("w"), "left_semi")
        .groupBy("h", "id")
        .agg(F.first("line").alias("line")),
        "lines",
    )
    few = met.join(sizes.where(F.col("tiles") <= TILES), "k").withColumn("reached", F.lit(False))
    links, pairs = [_compared(few, known, steps, crowd)], []
    crowded = scratch(
        met.join(sizes.where(F.col("tiles") > TILES), "k").select("k", "h"), "crowded"
    )
    if not crowded.isEmpty():
        of_crowds = known.join(
            crowded.select(F.col("h").alias("w")).distinct(), F.col("h") == F.col("w"), "left_semi"
        ).select(
            F.lit(0).cast("bigint").alias("k"),
            "h",
            F.lit(True).alias("own"),
            "line",
            F.char_length("line").alias("chars"),
        )
        again = scratch(
            segment_rows(of_crowds, steps, rest=True).join(
                crowded.select("k").distinct(), "k", "left_semi"
            ),
            "again",
        )
        ones = again.where("edits = 1").select(F.col("h").alias("w")).distinct()
        codes = (
            known.join(ones, F.col("h") == F.col("w"), "left_semi")
            .select("h", "line")
            .mapInArrow(_crowd_codes, "c bigint, own boolean, h bigint")
        )
        hubs = (
            codes.groupBy(F.col("c").alias("c2"))
            .agg(
                F.min(F.when(F.col("own"), F.col("h"))).alias("whole"),
                F.min("h").alias("lo"),
                F.max("h").alias("hi"),
            )
            .where("lo != hi")
            # without a whole line under a code, lines under a place code differ there only; others
            # fall away when they are verified
            .select("c2", F.coalesce("whole", "lo").alias("hub"))
        )
        ends = codes.join(hubs, F.col("c") == F.col("c2"))
        pairs.append(scratch(ends.select(F.col("hub").alias("a"), F.col("h").alias("b")), "pairs"))
        more = again.where("edits > 1").drop("edits")
        if not more.isEmpty():
            stars, split = _crowd_links(more, known, steps, crowd, depth)
            links += stars + split
    links += [_verified(of_codes, known, steps) for of_codes in pairs]
    out = reduce(DataFrame.union, links)
    return out.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def repeated_lines(docs: DataFrame, edits: int | tuple, min_chars: int, crowd: int) -> DataFrame:
    """(__row_key, gone): the numbers of the lines of a row whose class has an earlier line."""
    lines = lines_of(docs, min_chars)
    classes = connected_components(line_links(lines, edits, crowd))
    at = F.struct(KEY, "no")
    places = scratch(lines.select(KEY, "no", "id"), "places")
    firsts = places.groupBy("id").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
    known = firsts.join(classes, F.col("id") == F.col("node"), "left").where(
        "n > 1 or component is not null"
    )
    heads = known.groupBy(F.coalesce("component", "id").alias("class")).agg(
        F.min("first").alias("head")
    )
    # written, so that the join of a hot line can be split
    of_line = scratch(
        known.select(F.col("id").alias("k_id"), F.coalesce("component", "id").alias("k_class"))
        .join(heads, F.col("k_class") == F.col("class"))
        .select("k_id", "head"),
        "heads",
    )
    return (
        places.join(of_line, F.col("id") == F.col("k_id"))
        .where(at != F.col("head"))
        .groupBy(F.col(KEY).alias("g_key"))
        .agg(F.collect_list("no").alias("gone"))
    )


def dedup_lines(
    docs: DataFrame,
    edits: int | tuple = EDITS,
    min_chars: int = MIN_CHARS,
    crowd: int = CROWD,
) -> DataFrame:
    """``docs`` without the lines that repeat an earlier line or come within ``edits`` of one.

    ``edits`` is a number, or (least length, number) for the shorter of two lines: one edit from 20
    characters on, two from 80, three from 120 unless told otherwise.
    All columns stay, ``text`` changes, and __row_key and n_gone (lines removed) are added; columns
    that were called so before are replaced. Earlier
    is the smaller id, then the higher place in the text. Lines of fewer than ``min_chars``
    characters always stay, as do null and empty texts; a text may become empty. Repeated rows lose
    what the first of them keeps. An empty table gives no rows.
    """
    packed = with_rest(docs)
    gone = scratch(
        repeated_lines(packed.select(KEY, "text"), edits, min_chars, crowd), "gone"
    )
    # a merge join whatever the size, so that a run on a part of a corpus tells what the whole needs
    joined = packed.join(gone.hint("merge"), F.col(KEY) == F.col("g_key"), "left")
    lost = F.col("gone")
    cut = joined.withColumn("text", cut_lines(F.col("text"), lost))
    return cut.select(
        *as_before(cut, docs, (KEY, "n_gone")),
        KEY,
        F.coalesce(F.size(lost), F.lit(0)).alias("n_gone"),
    )
