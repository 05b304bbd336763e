"""Helpers shared by the corpus operators.

Text operators that need Python run as ``mapInArrow`` over the partitions of
the input: no shuffle, one Arrow batch in memory at a time, and every text is
cut into slices of bounded size before it is split into words, so one very
long document cannot exhaust a worker.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import checkpoint_root

#: The white space of every contract here: space and U+0009 to U+000D.
#: ``bytes.split()`` splits at exactly these.
BLANKS = " \t\n\x0b\x0c\r"
_BLANK_BYTES = frozenset(BLANKS.encode())

#: Texts are split into words in slices of about this many bytes.
SLICE_BYTES = 1 << 21


def slices(text: bytes, limit: int = SLICE_BYTES) -> Iterator[bytes]:
    """Consecutive parts of ``text`` of about ``limit`` bytes that start at a
    blank (a word is never cut; a word longer than ``limit`` stays whole)."""
    at, n = 0, len(text)
    while n - at > limit:
        end = at + limit
        while end < n and text[end] not in _BLANK_BYTES:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def texts_of(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def parts_of(batch: pa.RecordBatch, text_col: str | int, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch``, at least one and with about ``limit`` bytes of text each."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(upto):
        end = int(np.searchsorted(upto, limit + (upto[at - 1] if at else 0))) + 1
        yield batch.slice(at, end - at)
        at = end


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[list[bytes | None], pa.RecordBatch], dict]],
    fields: list[T.StructField],
    text_col: str = "text",
    keep: list[str] | None = None,
    part_bytes: int | None = None,
) -> DataFrame:
    """Columns ``keep`` of ``df`` (all by default) and ``fields`` computed from
    the text, in one pass and without a shuffle.

    ``make()`` is called once per task and returns the function that turns the
    texts of a batch into one list (or array) per field.  A kept column with
    the name of a field is replaced by it.  With ``part_bytes`` a batch is
    handed over, and its result returned, in parts of about so many bytes of text.
    """
    names = {f.name for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    # plain names inside: mapInArrow cannot take every name a column may have
    inner = [f"__kept{k}" for k in range(len(kept))]
    given = [F.col(quoted(c)).alias(n) for c, n in zip(kept, inner, strict=True)]
    schema = T.StructType([T.StructField(n, df.schema[c].dataType) for c, n in zip(kept, inner, strict=True)] + fields)
    out_schema = to_arrow_schema(T.StructType(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in (p for b in batches for p in (parts_of(b, "__text", part_bytes) if part_bytes else (b,))):
            made = fn(texts_of(batch.column("__text")), batch)
            arrays = [batch.column(n) for n in inner]
            arrays += [pa.array(made[f.name], type=f.type) for f in out_schema]
            yield pa.RecordBatch.from_arrays(arrays, names=[*inner, *out_schema.names])

    out = df.select(*given, F.col(quoted(text_col)).alias("__text")).mapInArrow(run, schema)
    return out.toDF(*kept, *out_schema.names)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def settled(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint in the shared
    folder, so later steps neither recompute it nor lose it with an executor."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
