"""A Bloom filter of keys, tested where rows are scanned, before anything is shuffled.

One bit per key at a hashed place. Bits are gathered as bitmaps of 32,768 places, so the filter is a small
table whose size has a bound of its own: ``places`` / 8 bytes, whatever the keys. Where keys are far more
than a tenth of the places more rows pass than need to; none that is in the keys is ever lost.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACES = 1 << 27  # 16 MB
_WIDTH = 1 << 15


def _place(key: str, places: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(places))


def bloom_filter(keys: DataFrame, key: str, places: int = PLACES) -> DataFrame:
    """Bitmaps of the non-null values of ``key``: ``_bucket``, ``_bits``; only buckets with a bit."""
    if places % _WIDTH or not 0 < places <= 1 << 31:
        raise ValueError(f"places must be a multiple of {_WIDTH}, 2^31 at most")
    place = F.col("_place")
    return (
        keys.where(F.col(key).isNotNull())
        .select(_place(key, places).alias("_place"))
        .groupBy(F.shiftright(place, 15).cast("int").alias("_bucket"))
        .agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit(_WIDTH - 1))).alias("_bits"))
    )


def may_hold(rows: DataFrame, key: str, bits: DataFrame, places: int = PLACES) -> DataFrame:
    """The rows of ``rows`` whose ``key`` may be one of those in the filter; null is none."""
    place = _place(key, places)
    byte = F.substring("_bits", (place.bitwiseAND(F.lit(_WIDTH - 1)) / 8).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("bigint"), (place % 8).cast("int"))
    meets = F.shiftright(place, 15).cast("int") == F.col("_bucket")
    # at most ``places`` / 8 bytes are sent
    return rows.where(F.col(key).isNotNull()).join(
        F.broadcast(bits), meets & (bit == 1), "left_semi"
    )
