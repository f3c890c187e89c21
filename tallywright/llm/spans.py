"""Pattern matches with their places in a text, by built-in functions only."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import KEY

AROUND = 48  # code points kept on both sides of a match


@dataclass(frozen=True)
class Kind:
    """``pattern`` is matched in every text that holds ``probe``, a plain string, or a pattern where
    ``by_pattern`` says so; every text with a match must hold it. Patterns give non-empty matches;
    their loops over groups are possessive, as others recurse once per turn on long texts."""

    name: str
    pattern: str
    probe: str
    by_pattern: bool = True

    def held(self, text: Column) -> Column:
        return text.rlike(self.probe) if self.by_pattern else text.contains(self.probe)


def find(docs: DataFrame, kinds: list[Kind]) -> DataFrame:
    """Leftmost non-overlapping matches of each kind in the whole texts of ``docs``.

    Columns: __row_key, kind, start, stop (code points, end exclusive), match, before, after (the
    text on either side up to the next match of the kind, ``AROUND`` code points at most). Null
    texts have none.
    """
    texts = docs.select(KEY, F.coalesce("text", F.lit("")).alias("t"))
    cut = [
        F.struct(
            F.lit(k.name).alias("kind"),
            F.when(
                k.held(F.col("t")),
                F.arrays_zip(
                    F.split("t", k.pattern, -1).alias("gap"),
                    F.regexp_extract_all("t", F.lit(k.pattern), F.lit(0)).alias("match"),
                ),
            ).alias("parts"),
        )
        for k in kinds
    ]
    parts = (
        texts.select(KEY, F.inline(F.array(*cut)))
        .where(F.size("parts") > 1)
        .select(KEY, "kind", F.posexplode("parts").alias("i", "part"))
        .select(
            KEY,
            "kind",
            "i",
            F.char_length("part.gap").alias("gap"),
            F.col("part.match").alias("match"),
            F.right("part.gap", F.lit(AROUND)).alias("before"),
            F.left("part.gap", F.lit(AROUND)).alias("head"),
        )
    )
    in_order = Window.partitionBy(KEY, "kind").orderBy("i")
    length = F.coalesce(F.char_length("match"), F.lit(0))
    placed = parts.select(
        "*",
        F.sum((F.col("gap") + length).cast("bigint")).over(in_order).alias("stop"),
        F.lead("head").over(in_order).alias("after"),
    )
    return placed.where("match is not null").select(
        KEY, "kind", (F.col("stop") - length).alias("start"), "stop", "match", "before", "after"
    )


def digest(docs: DataFrame, spans: DataFrame, order: list[str], base: list[str]) -> DataFrame:
    """One row per row of ``docs``: id, n_<kind> for the base kinds, base_sha256, spans.

    ``spans`` has __row_key, kind, start, stop. They are listed as kind:start:end by start, then by
    the place of their kind in ``order``.
    """
    rank: Column = F.array_position(F.array(*[F.lit(k) for k in order]), F.col("kind"))
    entry = F.struct("start", rank.alias("rank"), "stop", "kind")
    counts = [F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in base]
    by_doc = spans.groupBy(F.col(KEY).alias("k2")).agg(
        *counts, F.sort_array(F.collect_list(entry)).alias("found")
    )

    def listed(found: Column) -> Column:
        return F.array_join(
            F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ","
        )

    kept = F.coalesce("found", F.array().cast(by_doc.schema["found"].dataType))
    return docs.join(by_doc, F.col(KEY) == F.col("k2"), "left").select(
        KEY,
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in base],
        F.sha2(
            listed(F.filter(kept, lambda x: x["kind"].isin(base))).cast("binary"), 256
        ).alias("base_sha256"),
        listed(kept).alias("spans"),
    )
