"""Near duplicates by MinHash: one-permutation signatures, banded buckets, star-shaped candidates.

1. Rows with equal shingle sets collapse into one node.
2. A node's signature is cut into bands; nodes that agree in a band share a bucket. A bucket of n nodes gives n - 1
   candidate pairs, each with its smallest node, not n * n / 2.
3. Candidates are confirmed on the full sets.
4. Where all nodes that share buckets are linked by then, no further pair can matter. Only elsewhere the pairs that stars
   leave out are tried too: the nodes of such a cluster are laid out in tiles of bounded size, and a tile compares
   its sets through an index of their shingles. A tile returns links, never pairs.

So the links are those of all pairs in a bucket, and the components are exact but for pairs without a common
bucket: at the similarity asked for, fewer than one in 200,000.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import bare, col, map_batches, materialize, slices
from martloom.llm.components import components
from martloom.llm.shingles import OnePermutation, Shingler

BANDS = 32
MISSED = 5e-6
# A tile holds two blocks of at most about so many sets and so many bytes of shingles.
BLOCK_SETS = 256
BLOCK_BYTES = 4 << 20
MADE = ("n_shingles", "component_id", "kept")


def rows_per_band(percent: int, bands: int = BANDS, missed: float = MISSED) -> int:
    """The most rows with which two sets of the given similarity share no band with a probability below ``missed``."""
    r = 1
    while r < 16 and (1 - (percent / 100) ** (r + 1)) ** bands <= missed:
        r += 1
    return r


def _signatures(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """From ``id, text`` (binary): ``id, mark`` (hash of the text), ``n``, ``digest`` of the set, ``bands``."""
    schema = T.StructType([
        rows.schema["id"], T.StructField("mark", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("digest", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
    ])
    frame = rows.select("id", F.xxhash64("text").alias("mark"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        shingler, permutation = Shingler(words), OnePermutation(BANDS, rows_per_band(percent))
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingler(part.column("text").to_pylist())
                full = [s for s in sets if len(s)]
                bands = iter(permutation.band_hashes(full) if full else ())
                yield [
                    part.column("id"), part.column("mark"), pa.array(map(len, sets), pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()),
                    pa.array([next(bands) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ]

    return map_batches(frame, run, schema)


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """From ``node, text``: ``node`` and its shingles, ascending, as 64-bit integers in ``shingles``."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("shingles", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        shingler = Shingler(words)
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingler(part.column("text").to_pylist())
                yield [part.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())]

    return map_batches(texts.select("node", F.col("text").cast("binary").alias("text")), run, schema)


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two ascending sets share at least ``percent`` hundredths of their union."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = np.count_nonzero(large[at] == small)
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` of nodes ``a, b`` with ``linked``."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    joined = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "x", "y")
    schema = T.StructType([T.StructField(c, t) for c, t in (("a", T.LongType()), ("b", T.LongType()), ("linked", T.BooleanType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            linked = [
                similar(np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64), percent)
                for i in range(batch.num_rows)
            ]
            yield [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())]

    return map_batches(joined, run, schema)


def tile_links(nodes: np.ndarray, parts: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join different parts, enough of them to connect all parts that any pair of these sets connects."""
    parent = {p: p for p in parts.tolist()}

    def root(p: int) -> int:
        while parent[p] != p:
            parent[p] = parent[parent[p]]
            p = parent[p]
        return p

    lengths = np.array([*map(len, sets)])
    shingles = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), lengths)
    order = np.argsort(shingles, kind="stable")
    shingles, owner = shingles[order], owner[order]
    links = []
    for i, s in enumerate(sets):
        low, high = np.searchsorted(shingles, s, "left"), np.searchsorted(shingles, s, "right")
        spans = high - low
        ends = np.cumsum(spans)
        places = np.repeat(low - (ends - spans), spans) + np.arange(ends[-1])
        both = np.bincount(owner[places], minlength=len(sets))
        for j in np.flatnonzero(100 * both >= percent * (lengths + lengths[i] - both)).tolist():
            a, b = root(int(parts[i])), root(int(parts[j]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((int(nodes[i]), int(nodes[j])))
    return links


def _tiled(nodes: DataFrame, percent: int) -> DataFrame:
    """From ``node, part, cluster, shingles``: links ``a, b`` between parts of a cluster, by tiles."""
    blocks = nodes.groupBy("cluster").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum(F.octet_length("shingles")) / BLOCK_BYTES)).cast("int").alias("blocks")
    )
    laid = nodes.join(materialize(blocks, "near-blocks").hint("merge"), "cluster")
    laid = laid.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    laid = laid.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    laid = laid.select(
        "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "part", "shingles"
    )

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(s, np.uint64) for s in rows.shingles]
        return pd.DataFrame(tile_links(rows.node.to_numpy(), rows.part.to_numpy(), sets, percent), columns=["a", "b"])

    # Without this the tiles of a cluster would stay in the task that the join brought the cluster to.
    laid = laid.repartition("cluster", "i", "j")
    return laid.groupBy("cluster", "i", "j").applyInPandas(run, "a long, b long")


def near_groups(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True,
) -> DataFrame:
    """Every row of ``docs`` with ``n_shingles``, ``component_id`` (smallest id linked to it, directly or not) and ``kept``.

    Two texts are linked if ``percent`` hundredths of the union of their sets of ``words``-word shingles are common.

    * A text of fewer words than a shingle has its whole sequence of words as its one shingle.
    * A null or empty text has no shingles and is linked with nothing; its ``component_id`` is its own id.
    * Rows that repeat a text are linked. Rows that repeat the id as well are kept or not alike.
    * A null id counts as larger than any other; a component of null ids has a null ``component_id`` and is kept.
    * An input column named like a result column gives way to it. An empty table gives an empty result.
      ``keep_text=False`` leaves the text out, which saves a shuffle of all texts.
    """
    rows = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    marked = materialize(_signatures(rows, words, percent), "near-signatures")
    nodes = materialize(
        marked.filter("n > 0").groupBy("digest").agg(
            F.min(F.struct(F.col("id").isNull(), "id", "mark")).alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands"),
        ).select("digest", "first.id", "first.mark", "n", "bands", F.monotonically_increasing_id().alias("node")),
        "near-nodes",
    )
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    centres = materialize(
        buckets.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("last"))
        .filter("centre < last").select("bucket", "centre"),
        "near-centres",
    )
    pairs = materialize(
        buckets.join(centres.hint("merge"), "bucket").filter("node <> centre")
        .select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct(),
        "near-pairs",
    )
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = materialize(wanted.join(nodes.select("node", "id", "mark"), "node"), "near-wanted")
    same = rows["id"].eqNullSafe(wanted["id"]) & (F.xxhash64(rows["text"]) == wanted["mark"])
    texts = rows.join(wanted.hint("merge"), same).select("node", rows["text"])
    # Rows that repeat id and text give the same set twice.
    sets = materialize(_sets(texts, words).dropDuplicates(["node"]), "near-sets")
    confirmed = materialize(_confirmed(pairs, sets, percent), "near-confirmed")
    parts = materialize(components(confirmed.filter("linked")), "near-parts")
    clusters = components(confirmed)
    placed = materialize(
        sets.join(parts.withColumnRenamed("component", "part"), "node", "left")
        .join(clusters.withColumnRenamed("component", "cluster"), "node", "left")
        .select("node", "shingles", F.coalesce("part", "node").alias("part"), F.coalesce("cluster", "node").alias("cluster")),
        "near-placed",
    )
    unsettled = placed.groupBy("cluster").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p < q").select("cluster")
    late = _tiled(placed.join(materialize(unsettled, "near-unsettled").hint("merge"), "cluster"), percent)
    links = confirmed.filter("linked").select("a", "b").union(late)
    labels = components(links)
    named = materialize(
        nodes.select("digest", "id", "node").join(labels, "node", "left")
        .select("digest", "id", F.coalesce("component", "node").alias("component")),
        "near-named",
    )
    smallest = materialize(named.groupBy("component").agg(F.min("id").alias("component_id")), "near-smallest")
    by_set = materialize(named.join(smallest, "component").select("digest", "component_id"), "near-classes")
    seen = marked.select("id", "mark", "n", "digest").join(by_set.hint("merge"), "digest", "left")
    result = seen.select(
        F.col("id").alias(id_col), "mark", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", col(id_col).eqNullSafe(F.col("component_id")))
    if not keep_text:
        return result.select(id_col, *MADE)
    # Rows of one id and one text are interchangeable: one of their results serves all of them.
    result = materialize(result.dropDuplicates([id_col, "mark"]), "near-result")
    found = result.select(col(id_col).alias(" id"), col("mark").alias(" mark"), *MADE)
    passed = bare(docs, *MADE)
    text = F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary")
    whole = docs.select(*map(col, passed)).join(
        found.hint("merge"), col(id_col).eqNullSafe(col(" id")) & (F.xxhash64(text) == col(" mark"))
    )
    return whole.select(*map(col, passed), *MADE)
