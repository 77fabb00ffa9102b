"""Mixing sources to target weights by a time-varying curriculum.

The mix holds as many words as all documents together. Sources, by code point and null last, weigh 5, 2, 1, repeating;
a source's target is its share by weight, at most `most_passes` times its own words, and what it cannot take goes to
the others by weight. In one pass over the sources, sorted by limit / weight: a source reaches its limit exactly if the
level that the rest would share still lies at or above it.

Within a source, documents follow each other in the order of a hash (MD5 of the id), pass after pass. A document is
taken in a pass when the middle of its words in this order lies below the target, so the words taken differ from the
target by at most half a document, and no document is taken more than `most_passes` times.

The curriculum: the weight of a source at time t in [0, 1] is its weight times 1 + tilt (2t - 1), with the tilts of
`TILTS` in turn. Integrated over [0, 1] this is the weight itself, so tilts move words in time and leave the targets.
The integral t + tilt (t^2 - t), times the target, is the source's cumulative demand; its inverse at the middle of a
document's words is the training position of that document, and documents are sorted by position, by ranges.

A null text has no words; documents without words are never taken, and a source of nothing else has target 0. Rows with one doc_id are documents of their own.
The number of sources may be large, but their totals are sorted in one task: one row for each source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallylake.llm.prefix import running_totals
from tallylake.llm.staging import shuffle_width, staged

WEIGHTS = (5, 2, 1)
TILTS = (-0.6, 0.0, 0.6)


def words(text: str) -> Column:
    """Number of runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_passes: int = 3) -> DataFrame:
    """(source, source_id, source_size, weight, target) from (source, size); source_id counts sources from 0."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("source_id", (F.row_number().over(by_name) - 1).cast("long"))
    weighed = ranked.withColumn(
        "weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("source_id") % len(weights) + 1).cast("int"))
    ).withColumn("most", F.col("source_size") * most_passes)
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("most") / F.col("weight"), "source_id")
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(earlier), F.lit(0))) / F.sum("weight").over(later)
    levelled = weighed.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") >= F.col("most"))
    # The first source that is not full fixes the level for itself and all that follow.
    settled = levelled.withColumn("final", F.min(F.when(~F.col("full"), F.struct(F.col("most") / F.col("weight"), "source_id", "level"))).over(everything)["level"])
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(
        F.least(F.col("most").cast("double"), F.col("final") * F.col("weight")))
    return settled.select("source", "source_id", "source_size", "weight", target.alias("target"))


def plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_passes: int = 3, tilts: tuple[float, ...] = TILTS) -> DataFrame:
    """(doc_id, row_id, size, source, source_size, target, passes, taken, position): one row for each row of `docs`;
    `passes` lists the passes that take the document, `position` is that of the first. row_id is a hash of the text,
    to tell rows with one doc_id apart."""
    sizes = docs.select("doc_id", F.xxhash64("text").alias("row_id"), "source", words("text").alias("size"))
    sizes = staged(sizes, "sizes")
    goals = staged(targets(sizes, weights, most_passes), "targets")
    keyed = (
        sizes.withColumn("source_key", F.coalesce("source", F.lit(""))).withColumn("no_source", F.col("source").isNull())
        .join(goals.select(F.coalesce("source", F.lit("")).alias("source_key"), F.col("source").isNull().alias("no_source"),
                           "source_id", "source_size", "target"), ["source_key", "no_source"])
        .drop("source_key", "no_source")
        .withColumn("order", F.md5(F.col("doc_id").cast("string").cast("binary")))
    )
    placed = running_totals(keyed, "source_id", ["order", "doc_id", "row_id"], "size", "curriculum")
    tilt = F.element_at(F.array(*(F.lit(float(t)) for t in tilts)), (F.col("source_id") % len(tilts) + 1).cast("int"))
    middle = lambda n: F.col("source_size") * n + F.col("before") + F.col("size") / 2
    # Inverse of t + tilt (t^2 - t) = share for a share in [0, 1], in a form that holds for any tilt in (-1, 1).
    inverse = lambda share: 2 * share / ((1 - tilt) + F.sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * share))
    passes = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(most_passes - 1)), lambda n: F.struct(n.alias("n"), inverse(F.try_divide(middle(n), F.col("target"))).alias("position"), (middle(n) < F.col("target")).alias("taken"))),
        lambda p: p["taken"] & (F.col("size") > 0),
    )
    return (
        placed.withColumn("passes", passes)
        .withColumn("taken", F.col("size") * F.size("passes"))
        .withColumn("position", F.get("passes", F.lit(0))["position"])
        .select("doc_id", "row_id", "size", "source", "source_size", "target", "passes", "taken", "position")
    )


def sorted_by_position(rows: DataFrame) -> DataFrame:
    return rows.repartitionByRange(shuffle_width(rows.sparkSession), F.col("position").asc_nulls_last(), "doc_id") \
        .sortWithinPartitions(F.col("position").asc_nulls_last(), "doc_id")


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix: rows of `docs` with all their columns, once for each pass that takes them, in training order. Rows that
    repeat both doc_id and text go in as one of them, for the passes of all."""
    chosen = plan(docs, **settings).where(F.size("passes") > 0)
    chosen = chosen.groupBy("doc_id", "row_id").agg(F.flatten(F.collect_list("passes")).alias("passes"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("row_id"))
    rows = rows.dropDuplicates(["doc_id", "row_id"])
    taken = rows.join(chosen, ["doc_id", "row_id"]).select("row", "doc_id", F.explode("passes.position").alias("position"))
    return sorted_by_position(taken).select("row.*")
