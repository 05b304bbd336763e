"""Embedding near-dedup by sorted projection passes.

1. Equal vectors of a label become one class, so exact copies are compared once.
2. Every pass has its own random hyperplanes; the signs of a vector's
   projections, concatenated, are its key.  The classes are ordered by (label,
   key) and cut into consecutive blocks.
3. A class is compared with all classes of its own and the neighbouring blocks
   (the bounded window) and, where a run of equal keys is longer than that, with
   the whole run: the run's blocks are dealt out pair by pair, so no task ever
   holds more than two blocks.
4. numpy verifies the pairs of two blocks by their cosine in double precision.
   A pair that meets in several passes counts in the first only, which every
   task can tell from the block numbers and keys that travel with the vectors;
   so links are counted exactly once without shuffling pairs.
5. Per pair of blocks only link counts per class and a spanning forest leave the
   task; connected components unite the forests across passes.

The number of key bits follows from the number of classes, so unrelated vectors
rarely share a key.  Longer keys are shared less often, so the number of passes
follows from the bits: a pair exactly at the cosine shares a whole key in some
pass with a chance of ``RECALL`` at every size (8 passes at 16 bits, 22 at a
billion classes), before what the windows add.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted, settled
from .components import connected_components
from .simhash_dedup import forest

COSINE = 0.98
RECALL = 0.96
PASSES = 8  # at least
BLOCK = 256
MAX_BITS = 40
SEED = 42


def _planes(dim: int, passes: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, passes * bits))


def passes_for(bits: int, cosine: float = COSINE, recall: float = RECALL) -> int:
    """Passes after which two unit vectors at that cosine have shared a whole key
    of ``bits`` signs with a chance of at least ``recall``.  A random plane parts
    them with a chance of angle / pi; the windows only add to it."""
    same = (1 - math.acos(max(-1.0, min(1.0, cosine))) / math.pi) ** bits
    return PASSES if same >= 1 else max(PASSES, math.ceil(math.log(1 - recall) / math.log1p(-same)))


def usable(column: pa.Array, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vectors that can have links (not null, empty or zero, all components
    finite) by dimension: where they stand, and a matrix of them."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)  # a null component is not a number
    starts = np.cumsum(size) - size
    for width in np.unique(size[size > 0]).tolist():
        at = np.nonzero(size == width)[0]
        x = flat[starts[at][:, None] + np.arange(width)]
        good = np.isfinite(x).all(axis=1) & x.any(axis=1)
        if good.any():
            yield at[good], x[good]


def units(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow of the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _project(passes: int, bits: int, seed: int, kind: str):
    powers = (1 << np.arange(bits, dtype=np.int64))[::-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                for at, x in usable(part.column("v"), kind):
                    width = x.shape[1]
                    if width not in planes:
                        planes[width] = _planes(width, passes, bits, seed)
                    signs = (units(x) @ planes[width] > 0).reshape(len(x), passes, bits)
                    take = pa.array(at)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("cid").take(take), part.column("label").take(take),
                         part.column("copies").take(take),
                         pa.array([row.tobytes() for row in x], type=pa.binary()),
                         pa.array((signs.astype(np.int64) @ powers).tolist(), type=pa.list_(pa.int64()))],
                        names=["cid", "label", "copies", "v", "keys"])

    return run


def _blocks(projected: DataFrame, block: int) -> DataFrame:
    """``(pass, cid, nr, run_from, run_to)``: the block of every class in every
    pass and the blocks that the run of its key spans.

    Ranks come from a range-partitioned sort whose layout a checkpoint fixes;
    one row count per partition gives every partition its first rank.
    """
    order = ["pass", "label", "key", "cid"]
    long = projected.select("cid", "label", F.posexplode("keys").alias("pass", "key"))
    laid = settled(long.repartitionByRange(*order).sortWithinPartitions(*order))
    placed = laid.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part", (F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("first"))
    ranked = placed.join(F.broadcast(before), "part").select(
        "pass", "label", "key", "cid",
        ((F.col("first") + F.col("at") - F.shiftleft(F.col("part").cast("long"), 33)) / block).cast("long").alias("nr"))
    ranked = settled(ranked)
    runs = ranked.groupBy("pass", "label", "key").agg(F.min("nr").alias("run_from"), F.max("nr").alias("run_to"))
    long_runs = runs.filter("run_to > run_from + 1")
    return ranked.join(long_runs, ["pass", "label", "key"], "left").select(
        "pass", "cid", "nr", "run_from", "run_to")


def _compare(cosine: float, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            job = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("pass", "low", "high")], axis=1)
            cuts = (np.nonzero((np.diff(job, axis=0) != 0).any(axis=1))[0] + 1).tolist()
            for s, e in itertools.pairwise([0, *cuts, len(job)]):
                if s == e:
                    continue
                if (this := tuple(job[s].tolist())) != now:
                    yield from _pairs(held, now, cosine, kind)
                    held, now = [], this
                held.append(batch.slice(s, e - s))
        yield from _pairs(held, now, cosine, kind)

    return run


def _pairs(held: list[pa.RecordBatch], job, cosine: float, kind: str) -> Iterator[pa.RecordBatch]:
    """Links between the classes of two blocks and, for neighbouring blocks,
    within the lower one."""
    rows = pa.Table.from_batches(held) if held else None
    if rows is None or rows.num_rows < 2:
        return
    this, low, high = job
    nr = np.array(rows.column("nrs").to_pylist(), dtype=np.int64)
    keys = np.array(rows.column("keys").to_pylist(), dtype=np.int64)
    label = rows.column("label").to_numpy()
    copies = rows.column("copies").to_numpy()
    cid = rows.column("cid").to_numpy()
    raw = rows.column("v").to_pylist()
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    counts, parent = np.zeros(len(cid), dtype=np.int64), np.arange(len(cid))
    for width in np.unique(size):  # vectors of other dimensions have no cosine
        at = np.nonzero(size == width)[0]
        unit = units(np.frombuffer(b"".join(raw[k] for k in at), dtype=kind).reshape(len(at), -1))
        side = nr[at, this] != low  # of the higher block
        for first in range(0, len(at), 512):
            some = slice(first, first + 512)
            i, j = np.nonzero(unit[some] @ unit.T >= cosine - 1e-9)
            i += first
            fit = ~side[i] & (side[j] | ((i < j) & (high == low + 1)))
            i, j = i[fit], j[fit]
            exact = (unit[i] * unit[j]).sum(axis=1) >= cosine
            i, j = at[i[exact]], at[j[exact]]
            fit = label[i] == label[j]
            i, j = i[fit], j[fit]
            if high > low + 1:  # blocks that only a run of equal keys brings together
                fit = keys[i, this] == keys[j, this]
                i, j = i[fit], j[fit]
            if this:
                met = (np.abs(nr[i, :this] - nr[j, :this]) <= 1) | (keys[i, :this] == keys[j, :this])
                i, j = i[~met.any(axis=1)], j[~met.any(axis=1)]
            np.add.at(counts, i, copies[j])
            np.add.at(counts, j, copies[i])
            parent = forest(0, i, j, parent)
    some = np.nonzero(counts)[0]
    if len(some):
        yield pa.RecordBatch.from_arrays(
            [pa.array(cid[some]), pa.array(cid[parent[some]]), pa.array(counts[some])], names=["cid", "other", "links"])


def class_links(classes: DataFrame, cosine: float = COSINE, passes: int | None = None, block: int = BLOCK,
                seed: int = SEED) -> DataFrame:
    """``(cid, other, links)`` from classes ``(cid, label, v, copies)``: how many
    vectors the class was found linked to (to be summed), and one edge of the
    spanning forest."""
    kind = "<f4" if classes.schema["v"].dataType.elementType == T.FloatType() else "<f8"
    bits = int(min(MAX_BITS, max(8, np.ceil(np.log2(classes.count() + 1)))))
    passes = passes or passes_for(bits, cosine)
    projected = settled(classes.select("cid", "label", "copies", "v").mapInArrow(
        _project(passes, bits, seed, kind), f"cid long, label {classes.schema['label'].dataType.simpleString()}, "
                                            "copies long, v binary, keys array<long>"))
    where = settled(_blocks(projected, block))
    nrs = where.groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("pass", "nr", "run_from", "run_to"))).alias("w"))
    full = projected.join(nrs, "cid").select("cid", "label", "copies", "v", "keys", "w", F.col("w.nr").alias("nrs"))
    spread = full.withColumn("x", F.explode("w")).drop("w")
    nr, start, end = F.col("x.nr"), F.coalesce("x.run_from", "x.nr"), F.coalesce("x.run_to", "x.nr")
    # with every block of the run, with the block before and the one after
    partners = F.sequence(F.least(start, nr - 1), F.greatest(end, nr + 1))
    jobs = spread.withColumn("partner", F.explode(partners)).filter(F.col("partner") != nr).select(
        F.col("x.pass").alias("pass"), F.least(nr, "partner").alias("low"), F.greatest(nr, "partner").alias("high"),
        "cid", "label", "copies", "v", "keys", "nrs")
    dealt = jobs.repartition("pass", "low", "high").sortWithinPartitions("pass", "low", "high", "cid")
    return dealt.mapInArrow(_compare(cosine, kind), "cid long, other long, links long")


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", cosine: float = COSINE, passes: int | None = None,
                    block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row of ``vectors``.

    Two rows are linked if their labels are equal and not null and their cosine
    in double precision is at least ``cosine``.  ``n_links``: other rows linked
    directly; ``component_id``: smallest id reachable by links, itself
    included; ``kept``: it is that id.

    ``passes``: None takes as many as :func:`passes_for` finds for the size.

    A vector that is null, empty or zero or has a null or non-finite component,
    and one whose label is null, has no link.  Vectors of different dimensions
    are not linked.  Repeated rows are vectors of their own (each links to the
    others).  A null id is never the smallest (``component_id`` is null and
    ``kept`` false where there is no other).  An empty table gives an empty
    table.  Other columns are not read.
    """
    if vectors.schema[vector_col].dataType != T.ArrayType(T.FloatType()):
        vectors = vectors.withColumn(vector_col, F.col(quoted(vector_col)).cast("array<double>"))
    rows = vectors.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(label_col)).alias("label"),
                          F.col(quoted(vector_col)).alias("v"))
    # copies of a vector share a label and a 128-bit hash; Spark's hashes pass over
    # null components, so vectors with one get none
    able = F.col("label").isNotNull() & F.forall("v", lambda x: x.isNotNull())
    hashed = rows.withColumn("h", F.when(able, F.xxhash64("v"))).withColumn("g", F.when(able, F.xxhash64(F.lit(7), "v")))
    grouped = (
        hashed.filter("h IS NOT NULL").groupBy("label", "h", "g")
        .agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))
    )
    classes = settled(grouped.withColumn("cid", F.xxhash64("label", "h", "g")))
    found = settled(class_links(classes, cosine, passes, block, seed))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("cid").alias("a"), F.col("other").alias("b")))
    good = F.exists("v", lambda x: x != 0) & ~F.exists(
        "v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    known = (
        classes.join(links, "cid", "left").join(parts, classes.cid == parts.node, "left")
        .select("label", "h", "g", "low", F.coalesce("component", "cid").alias("component"),
                F.when(good, F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    )
    lowest = known.groupBy("component").agg(F.min("low").alias("component_id"))
    of_class = known.filter("links IS NOT NULL").join(lowest, "component").select(
        "label", "h", "g", "links", "component_id")
    out = hashed.select("id", "label", "h", "g").join(of_class, ["label", "h", "g"], "left")
    part = F.when(F.col("links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        part.alias("component_id"), F.coalesce(F.col("id") == part, F.lit(False)).alias("kept"))
