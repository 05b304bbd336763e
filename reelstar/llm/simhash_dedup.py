"""SimHash near-dedup by exact tiled comparison.

1. One pass over the texts makes a 64-bit fingerprint per document (numpy
   counts the set bits of all shingle hashes).
2. Equal fingerprints become one class, so exact copies are compared once.
3. The four 16-bit quarters of a fingerprint have population counts; the tuple
   of the four is its tile.  Two fingerprints at distance r have tiles whose
   counts differ by at most r in sum, so all other tile pairs are skipped - the
   comparison stays exact.  A class is sent to its own tile and, as a visitor,
   to the tiles within the radius on one side (65 of 129 for radius 3), so every
   remaining tile pair meets in exactly one place.
4. There numpy compares blocks by exclusive-or and bit counts.  Links are
   reduced to a spanning forest of the tile at once, so a group of thousands
   of near copies sends one edge per member, not one per pair.
5. Connected components over the edges.

A tile of more than ``HOME_ROWS`` classes (a large group of near copies, or a
very large table) is cut into blocks by a hash of the fingerprint: visitors go
to every block, and a class of one block visits the blocks before it, so each
pair still meets in one place.  A task holds one block of about ``HOME_ROWS``
classes; visitors stream past in parts.  The tiles that are cut are broadcast:
there are at most 17^4 tiles, whatever the input.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, quoted, settled, slices
from .components import connected_components

SHINGLE = 3
RADIUS = 3
SEED = 42
_QUARTER = 16
_BASE = _QUARTER + 1  # counts of a quarter: 0..16
_POWERS = np.array([_BASE**3, _BASE**2, _BASE, 1], dtype=np.int64)
_BLOCK = 1 << 20  # comparisons of one numpy block
HOME_ROWS = 1 << 15  # classes at home in one block of a tile


def _hashes(text: bytes, width: int) -> Iterator[np.ndarray]:
    """XXH64 of all word shingles of a text, slice by slice."""
    from xxhash import xxh64_intdigest

    left: list[bytes] = []  # the last width - 1 words, for the shingles across slices
    seen = False
    for part in slices(text.lower()):  # bytes.lower changes A-Z only
        words = left + part.split()
        n = len(words) - width + 1
        if n > 0:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
            seen = True
            yield np.array(
                [xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1:].tolist(), strict=True)],
                dtype=np.uint64,
            )
        left = words[-(width - 1):] if width > 1 else []
    if not seen and left:
        yield np.array([xxh64_intdigest(b" ".join(left), SEED)], dtype=np.uint64)


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """The 64-bit fingerprint as a signed integer; 0 for a text without words."""
    total, n = np.zeros(64, dtype=np.int64), 0
    for h in _hashes(text or b"", width):
        for at in range(0, len(h), 1 << 16):
            part = h[at: at + (1 << 16)]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += bits.sum(axis=0, dtype=np.int64)
            n += len(part)
    bits = (2 * total > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = SHINGLE) -> DataFrame:
    """``(id, fp)`` of every row of ``docs``; null text counts as empty."""
    def make():
        return lambda texts, _: {"fp": [fingerprint(t, width) for t in texts]}

    return map_texts(docs, make, [T.StructField("fp", T.LongType())], text_col, [id_col])


def _offsets(radius: int) -> np.ndarray:
    """Tile offsets within the radius whose first non-zero entry is positive."""
    one = range(-radius, radius + 1)
    near = [d for d in itertools.product(one, repeat=4) if 0 < sum(map(abs, d)) <= radius]
    return np.array([d for d in near if next(x for x in d if x) > 0], dtype=np.int64)


def tile_of(fp: Column) -> Column:
    """The number of a fingerprint's tile, as the tasks count it."""
    mask = F.lit((1 << _QUARTER) - 1).cast("long")
    parts = [F.bit_count(F.shiftrightunsigned(fp, _QUARTER * k).bitwiseAND(mask)) for k in range(4)]
    return sum((p * int(w) for p, w in zip(parts[1:], _POWERS[1:], strict=True)), parts[0] * int(_POWERS[0])).cast("int")


def _blocks_of_tiles(distinct: DataFrame, home_rows: int) -> DataFrame:
    """``(tile, blocks)`` of the tiles that are cut."""
    sizes = distinct.groupBy(tile_of(F.col("fp")).alias("tile")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.filter(F.col("n") > home_rows).select(
        "tile", F.ceil(F.col("n") / home_rows).cast("int").alias("blocks"))


def _dealt(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """``(tile, block, visits, fp)``: every row in the block it is at home in and,
    as a visitor, in the blocks of its tile that it is to meet."""
    own = F.when(~F.col("visits"), F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    cut = rows.join(F.broadcast(blocks), "tile", "left")
    last = F.coalesce(own, F.col("blocks") - 1, F.lit(0))  # at home: the blocks before its own
    spread = cut.select("tile", "visits", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), last)).alias("block"))
    return spread.select("tile", "block", (F.col("visits") | F.coalesce(F.col("block") < F.col("own"), F.lit(False)))
                         .alias("visits"), "fp")


def _quarters(fp: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp.view(np.uint16).reshape(-1, 4)).astype(np.int64)



def _to_tiles(radius: int):
    offsets = _offsets(radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fp = batch.column("fp").slice(at, 4096).to_numpy(zero_copy_only=False)
                q = _quarters(fp)
                yield _tile_rows(q @ _POWERS, fp, np.zeros(len(fp), dtype=bool))
                to = q[:, None, :] + offsets[None, :, :]
                who, which = np.nonzero(((to >= 0) & (to <= _QUARTER)).all(axis=2))
                yield _tile_rows(to[who, which] @ _POWERS, fp[who], np.ones(len(who), dtype=bool))

    return run


def _tile_rows(tile: np.ndarray, fp: np.ndarray, visits: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(tile.astype(np.int32)), pa.array(visits), pa.array(fp)], names=["tile", "visits", "fp"]
    )


def forest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes over the links (a, b),
    starting from the labels of earlier links."""
    label = np.arange(n) if label is None else label
    while len(a):
        la, lb = label[a], label[b]
        open_ = la != lb
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while not np.array_equal(step := label[label], label):
            label = step
    return label


class _Tile:
    """The classes at home in one block of a tile and the forest of their links."""

    def __init__(self, radius: int):
        self.radius, self.home, self.label = radius, np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def at_home(self, fp: np.ndarray) -> None:
        before = len(self.home)
        self.home = np.concatenate((self.home, fp))
        self.label = np.concatenate((self.label, np.arange(before, len(self.home))))
        step = max(1, _BLOCK // len(self.home))
        for at in range(before, len(self.home), step):
            mine = self.home[at: at + step]
            i, j = self._near(mine, self.home)
            self.label = forest(0, i + at, j, self.label)

    def visit(self, fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if not len(self.home):
            return
        n, step = len(self.home), max(1, _BLOCK // len(self.home))
        for at in range(0, len(fp), step):
            mine = fp[at: at + step]
            i, j = self._near(mine, self.home)
            if len(i):
                label = forest(0, i + n, j, np.concatenate((self.label, np.arange(n, n + len(mine)))))
                self.label = label[:n]
                met = np.unique(i)
                yield mine[met], self.home[label[met + n]]

    def _near(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= self.radius)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        moved = np.nonzero(self.label != np.arange(len(self.label)))[0]
        return self.home[moved], self.home[self.label[moved]]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (tile, block, visits): home rows of a block first."""
        tile, now = _Tile(radius), None
        for batch in batches:
            tiles = (batch.column("tile").to_numpy(zero_copy_only=False).astype(np.int64) << 32) + \
                batch.column("block").to_numpy(zero_copy_only=False)
            visits = batch.column("visits").to_numpy(zero_copy_only=False)
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            cuts = np.nonzero((np.diff(tiles) != 0) | (visits[1:] != visits[:-1]))[0] + 1
            for s, e in itertools.pairwise([0, *cuts.tolist(), len(tiles)]):
                if s == e:
                    continue
                if tiles[s] != now:
                    yield from _edge_rows(*tile.links())
                    tile, now = _Tile(radius), tiles[s]
                if visits[s]:
                    for a, b in tile.visit(fps[s:e]):
                        yield from _edge_rows(a, b)
                else:
                    tile.at_home(fps[s:e])
        yield from _edge_rows(*tile.links())

    return run


def _edge_rows(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def near_links(fps: DataFrame, radius: int = RADIUS, home_rows: int = HOME_ROWS) -> DataFrame:
    """Edges ``(a, b)`` between the distinct values of ``fps.fp`` that connect
    all values at a distance of at most ``radius`` bits, directly or through
    other edges (a spanning forest of every block of a tile, not all pairs).
    ``home_rows`` is layout only."""
    distinct = fps.select("fp").distinct()
    rows = distinct.mapInArrow(_to_tiles(radius), "tile int, visits boolean, fp long")
    dealt = (
        _dealt(rows, _blocks_of_tiles(distinct, home_rows))
        .repartition("tile", "block")
        .sortWithinPartitions("tile", "block", "visits")
    )
    return dealt.mapInArrow(_compare(radius), "a long, b long")


def _linked(classes: DataFrame, radius: int) -> DataFrame:
    """One row per fingerprint ``fp``, with the fingerprint ``__part`` that
    names its component."""
    classes = settled(classes)
    parts = connected_components(near_links(classes, radius))
    return classes.join(parts, classes.fp == parts.node, "left").select(
        *classes.columns, F.coalesce("component", "fp").alias("__part"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``(id, fingerprint, component_id)`` for every row of ``docs``.

    Texts are lower-cased (A-Z), cut into words at blanks and into shingles of
    ``width`` words, repeats included; a text of fewer words is one shingle.
    A bit of the fingerprint is set if it is set in over half of the shingles'
    XXH64 (seed 42).  Fingerprints that differ in at most ``radius`` bits are
    linked; ``component_id`` is the smallest id reachable over links.

    Null text is empty text; an empty text or one of blanks only has the
    fingerprint zero and is linked like any other.  Rows with equal ids or
    texts each keep their row.  A null id is never the smallest; a component
    of null ids only has a null ``component_id``.  An empty table gives an
    empty table.  Other columns of ``docs`` are not read.
    """
    made = settled(fingerprints(docs, id_col, text_col, width))
    made = made.select(F.col(quoted(id_col)).alias("__id"), F.col("fp"))
    linked = _linked(made.groupBy("fp").agg(F.min("__id").alias("__low")), radius)
    lowest = linked.groupBy("__part").agg(F.min("__low").alias("component_id"))
    of_fp = linked.join(lowest, "__part").select("fp", "component_id")
    return made.join(of_fp, "fp", "left").select(
        F.col("__id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each group of near copies (all columns as they
    are): the one with the smallest id, then the smallest hash of the text, then
    of the whole row, so the choice does not depend on the order of the rows.
    Rows with the same id and texts of different groups belong to their own
    groups each.  Rows with a null id stay.
    """
    key, text = F.col(quoted(id_col)), F.col(quoted(text_col))
    whole = [quoted(c) for c, kind in docs.dtypes if "map<" not in kind]  # maps have no hash
    marks = {"__h": F.xxhash64(text), "__w": F.xxhash64(*whole)}
    known = docs.filter(key.isNotNull())
    given = known.select(key.alias("__id"), text.alias("__text"), *[v.alias(k) for k, v in marks.items()])

    def make():
        return lambda texts, _: {"fp": [fingerprint(t, width) for t in texts]}

    made = settled(map_texts(given, make, [T.StructField("fp", T.LongType())], "__text", ["__id", *marks]))
    row = F.struct("__id", *marks)
    linked = _linked(made.groupBy("fp").agg(F.min(row).alias("__row")), radius)
    keep = linked.groupBy("__part").agg(F.min("__row").alias("__row")).select("__row.*")
    on = [key == F.col("__id"), *[v == F.col(k) for k, v in marks.items()]]
    # rows that are equal in all of it have the same hashes
    first = known.join(keep, on, "left_semi").withColumns(marks).dropDuplicates([id_col, *marks])
    return first.drop(*marks).unionByName(docs.filter(key.isNull()))
