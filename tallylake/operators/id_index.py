"""Which transaction ids are stored already: ids in folders by hash, and a bit filter in front of them.

A load looks its ids up in the filter, which is a sixteenth of the ids in size or less; most new ids are known to be new
after that. The others are looked up exactly, in the folders that they fall into and in no other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.config import Config, DEFAULT

# Fixed by `bitmap_construct_agg`: bits of one bitmap.
BITMAP_BITS = 4096 * 8


def id_part(transaction_id: Column, cfg: Config = DEFAULT) -> Column:
    """The folder of an id: the first bits of its MD5, as its surrogate key has them."""
    first = F.conv(F.substring(F.md5(transaction_id), 1, 4), 16, 10).cast("int")
    return F.shiftright(first, 16 - cfg.id_part_bits)


def ids_of(facts: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return facts.select("transaction_id", id_part(F.col("transaction_id"), cfg).alias("id_part"))


def _places(ids: DataFrame) -> DataFrame:
    """Ids with two bit places and the hash that chooses their bitmap."""
    h = F.xxhash64("transaction_id")
    return ids.withColumns(
        {
            "_p": F.array(h.bitwiseAND(F.lit(BITMAP_BITS - 1)), F.shiftright(h, 15).bitwiseAND(F.lit(BITMAP_BITS - 1))),
            "_h": F.shiftrightunsigned(h, 30),
        }
    )


def _bucket(width) -> Column:
    """`width` is a power of two."""
    return F.col("_h").bitwiseAND(width - F.lit(1))


def filter_of(ids: DataFrame, n_ids: int, cfg: Config = DEFAULT) -> DataFrame:
    """Bitmaps of `ids_of`, wide enough for `n_ids` at sixteen bits an id."""
    parts = 1 << cfg.id_part_bits
    width = 1
    while width * BITMAP_BITS * parts < 16 * n_ids:
        width *= 2
    placed = _places(ids).select("id_part", _bucket(F.lit(width).cast("long")).alias("bucket"), F.explode("_p").alias("_p"))
    return (
        placed.groupBy("id_part", "bucket").agg(F.bitmap_construct_agg("_p").alias("bits"))
        .select("id_part", F.lit(width).cast("long").alias("width"), "bucket", "bits")
    )


def _is_set(place: Column) -> Column:
    byte = F.conv(F.hex(F.substr("bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1


def maybe_known(ids: DataFrame, bits: DataFrame) -> DataFrame:
    """Those of `ids_of` that a filter does not rule out. Filters of one width are combined first."""
    widths = [r[0] for r in bits.select("width").distinct().collect()]  # powers of two: some thirty
    if not widths:
        return ids.limit(0)
    placed = _places(ids)
    found = []
    for width in widths:
        whole = bits.filter(F.col("width") == width).groupBy("id_part", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        probes = placed.withColumn("bucket", _bucket(F.lit(width)))
        hits = probes.join(whole, ["id_part", "bucket"]).filter(_is_set(F.col("_p")[0]) & _is_set(F.col("_p")[1]))
        found.append(hits.select("transaction_id", "id_part"))
    return reduce(DataFrame.unionByName, found).distinct()


def known(maybe: DataFrame, stored: DataFrame) -> DataFrame:
    """The ids of `maybe` (a written table) that `stored` holds. Only the folders of `maybe` are opened; their ids are
    not shuffled while `maybe` is small enough to be broadcast by Spark's own threshold."""
    parts = [r[0] for r in maybe.select("id_part").distinct().collect()]  # at most 2**id_part_bits
    if not parts:
        return maybe.select("transaction_id")
    return stored.filter(F.col("id_part").isin(parts)).join(maybe.select("transaction_id"), "transaction_id", "left_semi").select(
        "transaction_id")
