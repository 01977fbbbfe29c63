"""Mixing sources to target weights, with DataFrame operations alone.

Each document gets a random key by hashing its id. The keys of a source are cut into equal ranges, so a range
holds about the same number of documents however large the source is. Sums per range, summed up level by
level, give the words before each range; a sort inside the range gives the words before each document. A source
takes whole epochs as often as they fit into its budget, then documents in key order up to the exact word.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import WORD, bare, col, materialize

# Documents of the whole corpus per range of keys, and ranges summed up in one group.
ROWS_PER_RANGE = 1000
FANOUT = 1000
MAX_EPOCHS = 3
MADE = ("size", "source_size", "target", "taken")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null and empty text."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def random_key(id_: Column, seed: int) -> Column:
    """A hash of the id as 32 hex digits: the same on every run and in every engine that has MD5."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """From ``source, source_size``: the target of each source.

    Sources in order of code points, null last, take the weights in turn. Targets share the total size by
    weight; none exceeds ``max_epochs`` times its source's size, and what is over is shared again. In order of
    capacity per weight the capped sources come first, so one running sum finds them all. The table has a row
    per source, which is what the unpartitioned windows sort.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_room = Window.orderBy("room", F.col("source").isNull(), "source")
    earlier = by_room.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("turn").cast("int"))
    ranked = (
        sizes.withColumn("turn", (F.row_number().over(by_name) - 1) % len(weights) + 1)
        .withColumn("weight", weight.cast("long"))
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("room", F.col("cap").cast("double") / F.col("weight"))
    )
    whole = Window.partitionBy()
    shared = ranked.select(
        "source", "source_size", "weight", "cap", "room",
        (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(earlier), F.lit(0))).alias("left_over"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))).alias("left_weight"),
    )
    share = F.col("left_over").cast("double") * F.col("weight") / F.col("left_weight")
    capped = shared.withColumn("capped", share > F.col("cap"))
    # The first source in this order that is not capped settles what a unit of weight is worth, also among equal rooms.
    order = F.struct("room", F.col("source").isNull().alias("none"), "source", "left_over", "left_weight")
    settled = F.min(F.when(~F.col("capped"), order)).over(whole)
    return capped.withColumn("settled", settled).select(
        "source", "source_size",
        F.when(F.col("capped"), F.col("cap").cast("double"))
        .otherwise(F.col("settled.left_over").cast("double") * F.col("weight") / F.col("settled.left_weight"))
        .alias("target"),
    )


def words_before(sums: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """From ``source, place, words``: the sum of ``words`` at smaller places of the source, as ``before``.

    Places are summed up in groups of ``fanout``, groups in groups of groups, until a source has one group.
    """
    top = sums.agg(F.max("place")).first()[0]
    inside = Window.partitionBy("source", "above").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumn("above", F.floor(F.col("place") / fanout).cast("long"))
    local = placed.withColumn("before", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    if top is None or top < fanout:
        return local.select("source", "place", "before")
    upper = placed.groupBy("source", F.col("above").alias("place")).agg(F.sum("words").alias("words"))
    carried = words_before(materialize(upper, "mix-level"), fanout)
    carried = carried.select(F.col("source").alias("s"), F.col("place").alias("above"), F.col("before").alias("carried"))
    same = F.col("source").eqNullSafe(F.col("s")) & (local["above"] == carried["above"])
    return local.join(carried, same).select("source", "place", (F.col("before") + F.col("carried")).alias("before"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = (1, 2, 3), seed: int = 2, max_epochs: int = MAX_EPOCHS, keep_text: bool = True,
) -> DataFrame:
    """Every row of ``docs`` with ``size`` in words, ``source_size``, ``target`` and ``taken``.

    ``taken`` counts the words that the mix takes of the row: its size for each whole epoch, and in the last
    epoch as much as the budget (the target to the nearest word) still holds, so a source meets its budget to
    the word. The document at the cut is taken in part.

    * Null and empty texts have size 0 and nothing is taken of them. A null source is a source of its own.
    * A source without words has target 0. Rows without an id share one key and follow each other by size.
    * Rows that repeat id and size are interchangeable; each run gives the same set of results.
    * An input column named like a result column gives way to it. An empty table gives an empty result.
      ``keep_text=False`` leaves the text out.
    """
    passed = [c for c in bare(docs, *MADE) if keep_text or c != text_col]
    sized = docs.select(
        F.struct(F.lit(0).alias("_"), *[col(c).alias(f"c{i}") for i, c in enumerate(passed)]).alias("row"),
        col(id_col).alias("id"), col(source_col).alias("source"), word_count(col(text_col)).alias("size"),
    )
    sized = materialize(sized, "mix-sizes")
    targets = materialize(
        source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs), "mix-targets"
    )
    ranges = sized.count() // ROWS_PER_RANGE + 1
    key = random_key(F.col("id"), seed)
    place = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(1 << 32) * ranges).cast("long")
    keyed = sized.withColumn("key", key).withColumn("place", place)
    sums = materialize(keyed.groupBy("source", "place").agg(F.sum("size").alias("words")), "mix-ranges")
    before = words_before(sums)
    # Ranges are small, so the rows of one can be sorted together; what stands before the range joins on.
    order = Window.partitionBy("source", "place").orderBy("key", "id", "size")
    inside = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    before = before.select(F.col("source").alias("s"), F.col("place").alias("p"), "before")
    placed = placed.join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("place") == F.col("p")))
    targets = targets.select(F.col("source").alias("t"), "source_size", "target")
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("t")))
    joined = joined.withColumn("budget", F.round("target").cast("long"))
    epochs = F.expr("CASE WHEN source_size > 0 THEN budget div source_size ELSE 0 END")
    rest = F.col("budget") - epochs * F.col("source_size") - F.col("before") - F.col("inside")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(rest, F.col("size")))
    return joined.select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(passed)],
        "size", "source_size", "target", taken.cast("long").alias("taken"),
    )
