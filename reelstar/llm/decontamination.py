"""Benchmark decontamination over a distributed positional inverted index.

The documents are indexed once: every task writes, for about a million words at
a time, one *block* - the sorted terms of its documents, how often each occurs,
and the ascending places of every term (the postings, delta-coded).  A block
holds whole documents; a longer one is cut into parts that repeat the last
words of the part before, so no phrase is lost at a cut.  The table of blocks
lies in the shared folder; no posting is ever shuffled.

A search sends the benchmark's windows to every block.  A window starts from the
postings of its rarest term in the block, moved back by the term's offset, and
intersects them with the moved postings of its other terms, rarest first, by
binary search in the sorted postings.  With ``slop`` a term may stand that many
places off: these are the proximity matches.  Both kinds come from one pass.

The benchmark travels to the tasks only up to ``QUERY_BYTES``; a larger one is
dealt by hash into passes over the same index.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from ..session import drop_path, work_dir
from .common import quoted, settled, slices, texts_of

#: Empty places between two documents of a block; phrases with their slop are shorter.
GAP = 64
#: Text bytes of a block, about a million words.
BLOCK_BYTES = 6 << 20
#: Text bytes of the benchmark that one pass takes to every task.
QUERY_BYTES = 4 << 20
#: Places that are intersected at a time.
CANDIDATES = 1 << 21

#: Lower-cases A-Z; every byte outside `[0-9a-z\x80-\xff]` becomes a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


# -- index -------------------------------------------------------------------

def coded_words(parts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """The words of the folded ``parts`` as ranks in the sorted list of their
    terms, that list, and the number of words of each part."""
    data = np.frombuffer(b" ".join(parts), dtype=np.uint8)
    inside = data != 32
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.cumsum([0, *(len(p) + 1 for p in parts)])
    n_words = np.diff(np.searchsorted(starts, first))
    if not len(starts):
        return np.zeros(0, np.int64), [], n_words
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[inside])]
    ).dictionary_encode()
    terms = words.dictionary.to_pylist()
    order = sorted(range(len(terms)), key=terms.__getitem__)
    rank = np.empty(len(terms), np.int64)
    rank[order] = np.arange(len(terms))
    return rank[words.indices.to_numpy()], [terms[k] for k in order], n_words


def index_block(parts: list[bytes]) -> tuple[dict[str, bytes], np.ndarray, np.ndarray]:
    """Terms, counts and delta-coded postings of the folded ``parts``; the
    number of words of each part and the place of its first word."""
    codes, terms, n_words = coded_words(parts)
    base = np.cumsum(n_words) - n_words + GAP * np.arange(len(parts))
    places = np.arange(len(codes)) + GAP * np.repeat(np.arange(len(parts)), n_words)
    keys = (codes << 32) | places
    keys.sort()
    counts = np.bincount(codes, minlength=len(terms))
    at = keys & 0xFFFFFFFF
    delta = np.diff(at, prepend=0)
    heads = np.cumsum(counts) - counts
    delta[heads] = at[heads]
    block = {"terms": b"\n".join(terms), "counts": counts.astype("<u4").tobytes(),
             "postings": delta.astype("<u4").tobytes()}
    return block, n_words, base


def build_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the positional index of ``docs`` to ``path`` and read it back.

    One row per block: ``parts`` - the documents or parts of them with a
    row number that is unique in the index, the id, the number of the first
    word, how many of the words are new (not repeated from the part before)
    and the first place in the block - and the binary columns ``terms``,
    ``counts`` and ``postings``.  Words are maximal runs of letters and digits
    of ASCII and of all other characters, A-Z lower-cased.

    Null or empty texts have a part without words, so every row of ``docs`` is
    in the index; rows with equal ids stay apart.  Other columns are not read.
    An empty table gives an empty index.
    """
    given = docs.select(F.col(quoted(id_col)).alias("__id"), F.col(quoted(text_col)).alias("__text"))
    part = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("id", given.schema["__id"].dataType),
        T.StructField("first", T.LongType()), T.StructField("n_words", T.LongType()),
        T.StructField("base", T.LongType()),
    ])
    schema = T.StructType([T.StructField("parts", T.ArrayType(part))]
                          + [T.StructField(c, T.BinaryType()) for c in ("terms", "counts", "postings")])
    out, part_type = to_arrow_schema(schema), to_arrow_type(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        about: list[tuple] = []
        held: list[bytes] = []
        size = 0

        def block() -> pa.RecordBatch:
            made, n_words, base = index_block(held)
            parts = [{"row": r, "id": i, "first": first - old, "n_words": int(n) - old, "base": int(b)}
                     for (r, i, first, old), n, b in zip(about, n_words, base, strict=True)]
            arrays = [pa.array([parts], type=pa.list_(part_type))]
            arrays += [pa.array([made[c]], type=pa.binary()) for c in ("terms", "counts", "postings")]
            return pa.RecordBatch.from_arrays(arrays, schema=out)

        for batch in batches:
            ids = batch.column("__id").to_pylist()
            for i, text in zip(ids, texts_of(batch.column("__text")), strict=True):
                row += 1
                first, tail = 0, []
                for piece in slices((text or b"").translate(_FOLD), BLOCK_BYTES):
                    held.append(b" ".join([*tail, piece]))
                    about.append((row, i, first, len(tail)))
                    size += len(held[-1])
                    if len(text or b"") > BLOCK_BYTES:
                        words = piece.split()
                        first += len(words)
                        tail = (tail + words)[-GAP:]
                    if size >= BLOCK_BYTES or len(held) >= 1 << 16:
                        yield block()
                        held, about, size = [], [], 0
        if held:
            yield block()

    given.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


# -- search ------------------------------------------------------------------

@dataclass
class Windows:
    """The windows of one pass: their terms as numbers in ``terms`` (-1 after
    the last), their lengths and their items."""

    terms: list[bytes]
    words: np.ndarray
    length: np.ndarray
    item: np.ndarray
    items: list[str]


def windows_of(items: list[tuple[str, str | None]], window: int) -> Windows:
    """Every ``window`` consecutive words of an item; an item of fewer words,
    but not none, is one window."""
    names = sorted({name for name, _ in items})
    number = {name: k for k, name in enumerate(names)}
    seen: dict[bytes, int] = {}
    rows, of = set(), []
    for name, text in items:
        words = [seen.setdefault(w, len(seen)) for w in (text or "").encode().translate(_FOLD).split()]
        last = max(len(words) - window, 0)
        rows.update((number[name], *words[k:k + window]) for k in range(last + 1) if words)
    made = sorted(rows)
    table = np.full((len(made), window), -1, np.int64)
    for k, (_, *words) in enumerate(made):
        table[k, :len(words)] = words
    of = np.array([r[0] for r in made], np.int64)
    return Windows(list(seen), table, (table >= 0).sum(axis=1), of, names)


def find_windows(block: dict, q: Windows, slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where the windows stand in a block: window, place of its first word,
    place of the rarest word taken as the anchor, and whether every word stands
    exactly there (else each within ``slop`` places)."""
    terms = block["terms"].split(b"\n")
    counts = np.frombuffer(block["counts"], "<u4").astype(np.int64)
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, bool),)
    if not len(counts) or not len(q.words):
        return none
    at = [bisect_left(terms, t) for t in q.terms]
    there = np.array([k if k < len(terms) and terms[k] == t else -1 for k, t in zip(at, q.terms, strict=True)])
    df = np.where(there >= 0, counts[np.maximum(there, 0)], 0)
    # the postings of the benchmark's terms, as sorted keys (term, place)
    delta = np.frombuffer(block["postings"], "<u4").astype(np.int64)
    ends = np.cumsum(counts)
    held = np.flatnonzero(there >= 0)
    if not len(held):
        return none
    term_of = np.repeat(held, df[held])
    from_ = np.cumsum(df) - df
    pick = np.arange(len(term_of)) - from_[term_of] + (ends - counts)[there[term_of]]
    places = np.cumsum(delta[pick])
    heads = from_[held]
    before = np.where(heads > 0, places[heads - 1], 0)
    places -= np.repeat(before, df[held])
    keys = (term_of << 32) + places

    full = q.words >= 0
    n_at = np.where(full, df[q.words], np.iinfo(np.int64).max)
    alive = np.flatnonzero((n_at > 0).all(axis=1))
    order = np.argsort(n_at[alive], axis=1, kind="stable")
    rarest = order[:, 0]
    anchor = q.words[alive, rarest]
    cost = df[anchor] * (2 * slop + 1)
    found = []
    group = np.cumsum(cost) // CANDIDATES
    for g in np.unique(group):
        some = np.flatnonzero(group == g)
        n = df[anchor[some]]
        k = np.repeat(some, n)
        nth = np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
        where = places[from_[anchor[k]] + nth]
        start = where - rarest[k]
        if slop:
            shift = np.arange(-slop, slop + 1)
            k, where = np.repeat(k, len(shift)), np.repeat(where, len(shift))
            start = (start[:, None] + shift).ravel()
        exact = start + rarest[k] == where
        for nth_rarest in range(1, q.words.shape[1]):
            off = order[k, nth_rarest]
            word = q.words[alive[k], off]
            to = (word << 32) + start + off
            low = np.minimum(np.searchsorted(keys, to - slop), len(keys) - 1)
            ok = (word < 0) | (np.abs(keys[low] - to) <= slop)
            k, where, start, exact, word, to = (x[ok] for x in (k, where, start, exact, word, to))
            if slop and len(k):
                exact &= (word < 0) | (keys[np.minimum(np.searchsorted(keys, to), len(keys) - 1)] == to)
        found.append((alive[k], start, where, exact))
    if not found:
        return none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def merged(slot, item, exact, first, end):
    """Rows of one document, item and kind whose ranges overlap become one."""
    order = np.lexsort((end, first, exact, item, slot))
    slot, item, exact, first, end = (x[order] for x in (slot, item, exact, first, end))
    group = np.cumsum(np.concatenate(([0], np.diff(slot) | np.diff(item) | np.diff(exact.astype(np.int8)))) != 0)
    # ends of all earlier groups lie below this one's first
    lift = group * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift)
    new = np.concatenate(([True], first[1:] + lift[1:] > reach[:-1]))
    heads = np.flatnonzero(new)
    return slot[heads], item[heads], exact[heads], first[heads], np.maximum.reduceat(end, heads)


def _passes(items: DataFrame, id_col: str, text_col: str, window: int) -> Iterator[Windows]:
    given = items.select(F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit("")).alias("i"),
                         F.col(quoted(text_col)).alias("t"))
    total = given.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-int(total) // QUERY_BYTES) or 1
    for k in range(n):
        some = given if n == 1 else given.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield windows_of([(r.i, r.t) for r in some.collect()], window)


def find_phrases(index: DataFrame, items: DataFrame, window: int = 10, slop: int = 0,
                 id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Per part of the index and pass over the items: ``row``, ``id``,
    ``n_words`` (new words of the part; 0 after the first pass) and
    ``matches``: ``item_id`` (string), ``first`` and ``end`` word (exclusive) of
    overlapping occurrences of the item's windows, and ``exact``: False if some
    word stands up to ``slop`` places away from where the window would put it.

    A proximity match exists where, for some place s, every word i of the window
    occurs within ``slop`` places of s + i in the same document.  Items without
    words match nothing; a null item id is "".
    """
    if window + 2 * slop > GAP:
        raise ValueError(f"a window with its slop may span at most {GAP} words")
    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("id", index.schema["parts"].dataType.elementType["id"].dataType),
        T.StructField("n_words", T.LongType()),
        T.StructField("matches", T.ArrayType(T.StructType([
            T.StructField("item_id", T.StringType()), T.StructField("first", T.LongType()),
            T.StructField("end", T.LongType()), T.StructField("exact", T.BooleanType())]))),
    ])
    out = to_arrow_schema(schema)

    def searched(q: Windows, counted: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in batch.to_pylist():
                    parts = block["parts"]
                    base = np.array([p["base"] for p in parts], np.int64)
                    skip = np.array([p["first"] for p in parts], np.int64)
                    w, start, anchor, exact = find_windows(block, q, slop)
                    matches: list[list] = [[] for _ in parts]
                    if len(w):
                        slot = np.searchsorted(base, anchor, side="right") - 1
                        first = start - base[slot] + skip[slot]
                        for s, i, e, a, z in zip(*(x.tolist() for x in merged(
                                slot, q.item[w], exact, np.maximum(first, 0), first + q.length[w])), strict=True):
                            matches[s].append({"item_id": q.items[i], "first": a, "end": z, "exact": e})
                    yield pa.RecordBatch.from_arrays([
                        pa.array([p["row"] for p in parts], type=out.field("row").type),
                        pa.array([p["id"] for p in parts], type=out.field("id").type),
                        pa.array([p["n_words"] * counted for p in parts], type=out.field("n_words").type),
                        pa.array(matches, type=out.field("matches").type),
                    ], schema=out)

        return index.mapInArrow(run, schema)

    found = None
    for q in _passes(items, id_col, text_col, window):
        one = searched(q, found is None)
        found = one if found is None else found.unionByName(one)
    return found


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, slop: int = 2, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``n_words``, ``n_hit`` (words inside an
    exact occurrence of a window of any item), ``items`` (sorted ids, as
    strings, of the items with such a window), ``n_near_items`` (items with an
    exact or a proximity match) and ``contaminated`` (``n_hit`` > 0).

    Null and empty texts have no words and no hits.  Rows with equal or null
    ids are judged apart.  Rows of ``items`` with equal ids are one item.  Other
    columns are not read, so their names cannot clash.  An empty benchmark hits
    nothing; an empty table gives no rows.
    """
    spark = docs.sparkSession
    path = work_dir(spark, "positional-index")
    index = build_index(docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text")),
                        path, "id", "text")
    parts = settled(find_phrases(index, items, window, slop, item_col, item_text))
    drop_path(spark, path)
    spans = parts.filter(F.size("matches") > 0).select("row", F.inline("matches"))
    # what an exact range adds to those that begin before it
    before = Window.partitionBy("row").orderBy("first", "end").rowsBetween(Window.unboundedPreceding, -1)
    new = F.col("end") - F.greatest(F.col("first"), F.coalesce(F.max("end").over(before), F.lit(0)))
    hit = spans.filter("exact").select("row", F.greatest(new, F.lit(0)).alias("new")).groupBy("row").agg(
        F.sum("new").alias("n_hit"))
    by_item = spans.groupBy("row", "item_id").agg(F.max("exact").alias("exact")).groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(F.col("exact"), F.col("item_id")))).alias("items"),
        F.count(F.lit(1)).alias("n_near_items"))
    whole = parts.groupBy("row").agg(F.any_value("id").alias("id"), F.sum("n_words").alias("n_words"))
    found = whole.join(hit.join(by_item, "row", "full"), "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return found.select(
        F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("n_near_items", F.lit(0)).cast("long").alias("n_near_items"),
        (n_hit > 0).alias("contaminated"),
    )
