"""Hard negatives by Fagin's threshold algorithm.

Rows are dealt over blocks. A block keeps, for each dimension, its rows in the order of that component:
the sorted candidate lists. Every anchor visits every block, in which it reads each list from the end
that the sign of its own component favours (sorted access), scores rows that come up for the first time
by their whole vector in whole numbers (random access), and stops once the threshold, the score of a
row that had the next value of every list, falls strictly below the kth score of each of its windows;
rows that tie with the kth score are thus always seen. The best of all blocks are then ranked together.

Two rounds: the first finds the positives of each anchor (lists of its own label), the second the rows of
other labels inside the window below each positive's score. A task holds one block and a batch of
anchors; anchors travel once to each block, rows once altogether.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import KEY, pa_schema, scratch, with_key
from .vectors import exact_type, is_finite, largest, longest, matrix, whole

ROWS_PER_BLOCK = 4096
_FIRST_DEPTH = 32


class Lists:
    """Rows of a block and, per dimension, their places in the order of the component."""

    def __init__(self, rows: np.ndarray):
        self.rising = np.argsort(rows, axis=0, kind="stable").astype(np.int32)
        self.falling = self.rising[::-1]
        self.low = np.take_along_axis(rows, self.rising, axis=0)
        self.high = self.low[::-1]
        self.rows, self.largest = rows, largest(rows)
        self._typed: dict = {}

    def typed(self, kind) -> np.ndarray:
        if kind not in self._typed:
            self._typed[kind] = self.rows.astype(kind)
        return self._typed[kind]

    def walk(self, anchor: np.ndarray, offer) -> int:
        """Offer unseen rows and their scores, ``offer(places, scores)``, until the value that it gives
        back is strictly above the threshold; the number of rows that were scored."""
        n, d = self.rows.shape
        kind = exact_type(max(1, d) * largest(anchor) * self.largest)
        rows, weights = self.typed(kind), anchor.astype(kind)
        from_top = anchor >= 0
        # a component that is zero adds nothing, so its list need not be read
        read = np.flatnonzero(anchor)
        if not len(read):
            places = np.arange(n)
            offer(places, np.zeros(n, dtype=np.int64))
            return n
        seen, left = np.zeros(n, dtype=bool), n
        depth, to = 0, min(n, _FIRST_DEPTH)
        while True:
            up = np.where(
                from_top[read], self.falling[depth:to][:, read], self.rising[depth:to][:, read]
            )
            fresh = np.zeros(n, dtype=bool)
            fresh[up.ravel()] = True
            fresh &= ~seen
            seen |= fresh
            places = np.flatnonzero(fresh)
            left -= len(places)
            bar = offer(places, (rows[places] @ weights).astype(np.int64))
            if not left:
                return n
            following = np.where(from_top, self.high[to], self.low[to]).astype(kind)
            if bar is not None and int(following @ weights) < bar:
                return n - left
            depth, to = to, min(n, 2 * to)


class Best:
    """The ``most`` rows of highest score between ``low`` and ``high``, ties by smaller key."""

    def __init__(self, most: int, low: int | None = None, high: int | None = None):
        self.most, self.low, self.high = most, low, high
        self.scores, self.keys, self.places = [], [], []

    def bar(self):
        """The kth score, or the lower end of the window while fewer rows are known."""
        return int(self.scores[-1]) if len(self.scores) == self.most else self.low

    def add(self, places, scores, keys):
        bar = self.bar()
        use = np.ones(len(scores), dtype=bool) if bar is None else scores >= bar
        if self.high is not None:
            use &= scores <= self.high
        if not use.any():
            return
        scores = np.concatenate([self.scores, scores[use]]) if len(self.scores) else scores[use]
        keys = np.concatenate([self.keys, keys[use]]) if len(self.keys) else keys[use]
        places = np.concatenate([self.places, places[use]]) if len(self.places) else places[use]
        order = np.lexsort((keys, -scores))[: self.most]
        self.scores, self.keys, self.places = scores[order], keys[order], places[order]


class Block:
    """One block of rows: keys, ids, labels, vectors."""

    def __init__(self, keys: np.ndarray, ids: list, labels: np.ndarray, rows: np.ndarray):
        self.keys, self.ids, self.labels, self.rows = keys, ids, labels, rows
        self._lists: dict = {}
        self.scored = 0

    def lists(self, label=None) -> tuple[np.ndarray, Lists]:
        """Places and lists of the rows of one label, or of all."""
        if label not in self._lists:
            of = np.flatnonzero(self.labels == label) if label is not None else np.arange(len(self.keys))
            self._lists[label] = of, Lists(self.rows[of])
        return self._lists[label]

    def positives(self, key: int, label, anchor: np.ndarray, most: int):
        """(id, key, score) of the best other rows of the anchor's label."""
        of, lists = self.lists(label)
        best = Best(most)

        def offer(places, scores):
            other = self.keys[of[places]] != key
            best.add(of[places][other], scores[other], self.keys[of[places]][other])
            return best.bar()

        if len(of):
            self.scored += lists.walk(anchor, offer)
        return [(self.ids[p], int(k), int(s)) for p, k, s in zip(best.places, best.keys, best.scores)]

    def negatives(self, label, anchor: np.ndarray, windows: list[tuple[int, int]], most: int):
        """(window, id, key, score) of the best rows of other labels in each window."""
        of, lists = self.lists()
        best = [Best(most, *w) for w in windows]

        def offer(places, scores):
            bar = min(b.bar() for b in best)
            use = (scores >= bar) & (self.labels[places] != label)
            if use.any():
                places, scores = places[use], scores[use]
                for b in best:
                    b.add(places, scores, self.keys[places])
            return min(b.bar() for b in best)

        if best and len(of):
            self.scored += lists.walk(anchor, offer)
        return [
            (w, self.ids[p], int(k), int(s))
            for w, b in enumerate(best)
            for p, k, s in zip(b.places, b.keys, b.scores)
        ]


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest whole score n with low * score <= 100 * n <= high * score."""
    return -((-low * score) // 100), (high * score) // 100


def in_blocks(rows: DataFrame, anchors: DataFrame, blocks: int, width: int, visit, schema: str) -> DataFrame:
    """What ``visit(block, key, id, label, vector, scores)`` yields for every anchor in every block.

    Each block is one partition, in which its rows come first and the anchors follow.
    """
    both = ("__key", "__id", "__label", "__x", "__scores")
    mine = rows.select(
        F.pmod(F.xxhash64("__key"), F.lit(blocks)).cast("int").alias("__block"),
        F.lit(0).alias("__kind"),
        *both[:4],
        F.lit(None).cast("array<bigint>").alias("__scores"),
    )
    theirs = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("__block"), F.lit(1).alias("__kind"), *both
    )
    out = pa_schema(rows.sparkSession, schema)

    def run(batches):
        held, block, at = [], None, None
        for batch in batches:
            place = batch.column("__block").to_numpy(zero_copy_only=False).astype(np.int64) * 2
            place += batch.column("__kind").to_numpy(zero_copy_only=False)
            ends = [*(np.flatnonzero(np.diff(place)) + 1).tolist(), len(place)]
            start = 0
            for end in ends:
                if start == end:
                    continue
                part, where = batch.slice(start, end - start), int(place[start])
                start = end
                keys = part.column("__key").to_numpy(zero_copy_only=False)
                labels = part.column("__label").to_numpy(zero_copy_only=False)
                vectors = matrix(part.column("__x"), width)
                if where % 2 == 0:
                    if at != where // 2:
                        held, block, at = [], None, where // 2
                    held.append((keys, part.column("__id").to_pylist(), labels, vectors))
                    continue
                if at != where // 2:
                    continue  # a block without rows
                if block is None:
                    k, i, lab, x = zip(*held, strict=True)
                    block = Block(np.concatenate(k), sum(i, []), np.concatenate(lab), np.concatenate(x))
                    held = []
                found = [
                    row
                    for anchor in zip(
                        keys.tolist(),
                        part.column("__id").to_pylist(),
                        labels.tolist(),
                        vectors,
                        part.column("__scores").to_pylist(),
                        strict=True,
                    )
                    for row in visit(block, *anchor)
                ]
                columns = list(zip(*found, strict=True)) if found else [[] for _ in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, out, strict=True)], schema=out
                )

    dealt = mine.union(theirs).repartitionById(blocks, F.col("__block"))
    return dealt.sortWithinPartitions("__block", "__kind").mapInArrow(run, schema)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | str = "label",
    vector: str = "embedding",
    id_col: str = "vec_id",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    block_rows: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Rows of another label that score nearly as high as a positive, for every anchor and positive.

    A row's score is the inner product of floor(``scale`` * vector) with the anchor's; higher scores
    come first, ties by smaller id. The positives of an anchor are its first other rows of its label;
    the negatives of a positive are the first rows of other labels whose score lies between ``low`` and
    ``high`` hundredths of the positive's score. One row each: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score, positive_rank.

    Rows with a null label, a null vector, or a null or non-finite entry take no part. Shorter vectors
    count as ended by zeros, and empty ones score 0. Rows of one id are rows of their own, in the order
    of their vectors; a null id comes before all others. Extra columns do not matter; an empty table
    gives no rows. A score beyond BIGINT raises.
    """
    # the anchor flag and the label are taken before names change, so that any column may be used
    label = F.col(label) if isinstance(label, str) else label
    rows = vectors.where(is_finite(vector) & label.isNotNull()).select(
        F.col(id_col).alias("__id"),
        label.cast("bigint").alias("__label"),
        whole(vector, scale).alias("__x"),
        F.coalesce(is_anchor, F.lit(False)).alias("__anchor"),
    )
    keyed = with_key(rows, "__id", "__x").withColumnRenamed(KEY, "__key")
    rows = scratch(keyed, "vectors")
    n, width = longest(rows, "__x")
    blocks = max(1, -(-n // block_rows))
    id_type = rows.schema["__id"].dataType.simpleString()
    anchors = rows.where("__anchor").drop("__anchor")
    rows = rows.drop("__anchor")

    def seek_positives(block, key, name, own, vector, _):
        for other, k, score in block.positives(key, own, vector, positives):
            yield key, name, k, other, score

    found = in_blocks(
        rows,
        anchors.withColumn("__scores", F.lit(None).cast("array<bigint>")),
        blocks,
        width,
        seek_positives,
        f"a_key bigint, a_id {id_type}, p_key bigint, p_id {id_type}, p_score bigint",
    )
    rank = F.row_number().over(Window.partitionBy("a_key").orderBy(F.desc("p_score"), "p_key"))
    chosen = scratch(
        found.withColumn("p_rank", rank).where(F.col("p_rank") <= positives), "positives"
    )

    def seek_negatives(block, key, name, own, vector, scores):
        windows = [(s, *window_of(s, low, high)) for s in scores]
        windows = [w for w in windows if w[1] <= w[2]]
        best = block.negatives(own, vector, [w[1:] for w in windows], negatives)
        for window, other, k, score in best:
            yield key, windows[window][0], k, other, score

    scores = chosen.groupBy(F.col("a_key").alias("s_key")).agg(F.collect_set("p_score").alias("__scores"))
    near = in_blocks(
        rows,
        anchors.join(scores, F.col("__key") == F.col("s_key")),
        blocks,
        width,
        seek_negatives,
        f"n_anchor bigint, n_window bigint, n_key bigint, n_id {id_type}, n_score bigint",
    )
    order = Window.partitionBy("n_anchor", "n_window").orderBy(F.desc("n_score"), "n_key")
    near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return chosen.join(
        near, (F.col("a_key") == F.col("n_anchor")) & (F.col("p_score") == F.col("n_window"))
    ).select(
        F.col("a_id").alias("anchor_id"),
        F.col("p_id").alias("positive_id"),
        "rank",
        F.col("n_id").alias("negative_id"),
        F.col("p_score").alias("positive_score"),
        F.col("n_score").alias("negative_score"),
        F.col("p_rank").alias("positive_rank"),
    )
