"""Packing token sequences into fixed windows by best-fit decreasing.

Every task packs the documents of its own partition, so neither texts nor
token ids are shuffled.  A document's ids are first cut into full windows; what
is left over (shorter than a window) is gathered, and every ``BLOCK`` leftovers
are placed longest first, each into the open window with the least room that
still holds it.  A segment tree over the remaining capacities finds that window
in O(log window) steps.  Sequence ids carry the partition in their upper bits,
so they are unique without any coordination.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts_of, quoted, texts_of
from .word_ids import ids_of

WINDOW = 2048
END_ID = 1
#: Leftovers that are placed together (a few words of memory each).
BLOCK = 100_000
#: Bytes of text whose ids are made together.
PART_BYTES = 1 << 22
_PART_SHIFT = 40


class OpenWindows:
    """Open windows by remaining room, with a segment tree over 0..``window``
    whose leaves tell whether some window has exactly that room."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.tree = bytearray(2 * self.size)
        self.by_room: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, window: int, room: int) -> None:
        if not self.by_room[room]:
            at = room + self.size
            while at and not self.tree[at]:
                self.tree[at] = 1
                at >>= 1
        self.by_room[room].append(window)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out the window with the least room that is at least ``need``:
        (window, its room)."""
        tree, at = self.tree, need + self.size
        if not tree[at]:
            while at > 1 and (at & 1 or not tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if tree[2 * at] else 2 * at + 1
        room = at - self.size
        found = self.by_room[room].pop()
        if not self.by_room[room]:
            tree[at] = 0
            at >>= 1
            while at and not (tree[2 * at] or tree[2 * at + 1]):
                tree[at] = 0
                at >>= 1
        return found, room


def best_fit_decreasing(lengths: list[int], window: int = WINDOW) -> tuple[list[int], list[int], int]:
    """``(sequence, offset, sequences)``: where each piece goes.  Pieces of
    equal length keep their order; every length is 1..window."""
    open_, n = OpenWindows(window), 0
    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    for k in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = lengths[k]
        found = open_.tightest(need)
        if found is None:
            found, n = (n, window), n + 1
        at, room = found
        sequence[k], offset[k] = at, window - room
        if room > need:
            open_.put(at, room - need)
    return sequence, offset, n


def pack(
    docs: DataFrame,
    tokenizer: Callable[[], Callable[[list[bytes | None]], list[np.ndarray]]],
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    with_ids: bool = False,
    block: int = BLOCK,
) -> DataFrame:
    """One row per piece of a document: ``id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, padded_length`` and, if asked for, the
    piece's token ids ``ids``.

    A document's ids (by ``tokenizer()``, made once per task, a function from
    texts to id arrays; then ``end_id``) are cut into full windows from the front; the rest is placed by best-fit
    decreasing.  ``offset`` is gapless from 0 in each sequence.  A sequence is
    padded to ``padded_length``: the window, or the tokens it holds if that is
    a power of two.  ``ids_crc32``: over the ids as little-endian 32-bit.

    Null or empty text has ``end_id`` as its only id.  Rows with equal or null
    ids are packed each on its own.  Texts of any length are tokenized whole.
    An empty table gives an empty table.  Other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    # a large table packs in large partitions; with ids a block is bounded by them too
    most_ids = 1 << 23

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer()
        sequence = TaskContext.get().partitionId() << _PART_SHIFT
        held: list[tuple] = []  # leftovers: (id, start, length, crc, doc_tokens, ids)
        held_ids = 0

        def rows(pieces: list[tuple], seqs: list[int], offsets: list[int], used: dict[int, int]) -> pa.RecordBatch:
            def padded(s: int) -> int:
                return used[s] if used[s] & (used[s] - 1) == 0 else window

            columns = list(zip(*pieces, strict=True))
            arrays = [
                pa.array(columns[0], type=kind),
                *(pa.array(columns[k], type=pa.int64()) for k in (1, 2, 3, 4)),
                pa.array(seqs, type=pa.int64()), pa.array(offsets, type=pa.int64()),
                pa.array([padded(s) for s in seqs], type=pa.int64()),
            ]
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_length"]
            if with_ids:
                arrays.append(pa.array(columns[5], type=pa.list_(pa.int64())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def place() -> Iterator[pa.RecordBatch]:
            nonlocal sequence, held, held_ids
            if held:
                seqs, offsets, n = best_fit_decreasing([p[2] for p in held], window)
                used: dict[int, int] = {}
                for p, s in zip(held, seqs, strict=True):
                    used[s + sequence] = used.get(s + sequence, 0) + p[2]
                yield rows(held, [s + sequence for s in seqs], offsets, used)
                sequence += n
            held, held_ids = [], 0

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            full: list[tuple] = []
            parts = ((p.column(0).to_pylist(), encode(texts_of(p.column(1)))) for p in parts_of(batch, 1, PART_BYTES))
            for i, found in ((i, x) for keys, made in parts for i, x in zip(keys, made, strict=True)):
                ids = np.append(found, np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), window):
                    part = ids[start: start + window]
                    piece = (i, start, len(part), zlib.crc32(part.tobytes()), len(ids), part if with_ids else None)
                    if len(part) == window:
                        full.append(piece)
                    else:
                        held.append(piece)
                        held_ids += len(part) * with_ids
                if len(held) >= block or held_ids >= most_ids:
                    yield from place()
                if len(full) >= 4096:
                    yield rows(full, *_own(full, sequence, window))
                    sequence, full = sequence + len(full), []
            if full:
                yield rows(full, *_own(full, sequence, window))
                sequence += len(full)
        yield from place()

    schema = (f"{quoted(id_col)} {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long, padded_length long" + (", ids array<long>" if with_ids else ""))
    return docs.select(F.col(quoted(id_col)), F.col(quoted(text_col))).mapInArrow(run, schema)


def _own(full: list[tuple], first: int, window: int) -> tuple[list[int], list[int], dict[int, int]]:
    """Full windows are sequences of their own."""
    seqs = list(range(first, first + len(full)))
    return seqs, [0] * len(full), dict.fromkeys(seqs, window)


def word_tokenizer(path: str) -> Callable[[], Callable[[list[bytes | None]], list[np.ndarray]]]:
    """Ids by the tokenizer file at ``path`` (which every executor can read)."""
    return lambda: ids_of(path).encode
