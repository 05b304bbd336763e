"""Spelling variants: words that differ by one code point, grouped by form.

The letters fall into a few groups; a word's vector counts its letters of each
group.  One inserted, deleted or replaced letter moves the vector by a surplus of
at most one in one group and a deficit of at most one in another.  Arranged by
successive group counts the words form a trie, and a depth-first search that
may spend one surplus and one deficit meets every word that can be near; the
words at the leaves are verified letter by letter.

On Spark the first levels of the trie are the shuffle key: a *cell* holds the
words whose counts of the first groups agree.  A word lies in its own cell and is
looked for in the cells its budget can reach, in one direction only, so that
every pair meets once; the search goes on below with the budget that is left.  As
many levels become the key as it takes for the largest cell to hold
``CELL_WORDS`` words; the cells that stay larger at the last level (fewer than the
words by ``CELL_WORDS``, so they can be broadcast) are dealt into blocks by hash,
and both sides of such a cell meet block by block.  A task returns
one row per word and cell - how many near words, and the best of them - never
the pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import quoted, settled, slices, texts_of

#: The letters of the groups: a-z dealt by rank of frequency, the others by code point.
_RANKED = "etaoinshrdlcumwfgypbvkjxqz"
N_GROUPS = 8
LETTER_GROUPS = tuple(
    _RANKED[k::N_GROUPS] + "".join(chr(c) for c in range(0xC0, 0x100) if c % N_GROUPS == k)
    for k in range(N_GROUPS)
)
#: Words that a cell, and a block of a larger one, holds at most (blocks: about).
CELL_WORDS = 8_000
#: One in so many pairs of document and run loses a code point.
DELETE_ONE_IN = 97
#: Distinct words, and bytes of them, that a task counts before it passes them on.
HELD_WORDS, HELD_BYTES = 400_000, 32 << 20

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_OTHER_LEAD = bytes(b for b in range(0xC2, 0xF5) if b != 0xC3)
#: Characters of two bytes and more, but for U+00C0 to U+00FF.
_OTHER = re.compile(rb"[\xc2\xc4-\xf4][\x80-\xbf]+")


# -- words -----------------------------------------------------------------------

def letter_runs(text: bytes) -> Iterator[list[bytes]]:
    """The maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) of a text, A-Z
    lower-cased, a list for each slice of it."""
    folded = text.translate(_FOLD)
    if len(folded.translate(None, _OTHER_LEAD)) != len(folded):
        folded = _OTHER.sub(b" ", folded)
    for part in slices(folded):
        yield part.split()


def without_one(run: bytes, h: int) -> bytes:
    """``run`` without its code point number h modulo its length."""
    s = run.decode()
    k = h % len(s)
    return (s[:k] + s[k + 1:]).encode()


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 5,
                delete_one_in: int | None = DELETE_ONE_IN) -> DataFrame:
    """``(word, n)``: the letter runs of all texts of at least ``min_chars`` code
    points and their numbers of occurrences.

    With ``delete_one_in``, a run of a document whose crc32 of
    ``<id>:<run>`` is divisible by it loses one code point first (null ids: the
    empty string).  Null texts have no words.
    """
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        size = 0

        def passed_on() -> pa.RecordBatch:
            words = [w for w in total if len(w) - w.count(b"\xc3") >= min_chars]
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()).cast(pa.string()), pa.array([total[w] for w in words], pa.int64())],
                schema=out)

        for batch in batches:
            ids = batch.column("__id").to_pylist()
            for i, text in zip(ids, texts_of(batch.column("__text")), strict=True):
                seed = zlib.crc32(f"{'' if i is None else i}:".encode())
                for runs in letter_runs(text or b""):
                    for w, c in Counter(runs).items():
                        if delete_one_in:
                            h = zlib.crc32(w, seed)
                            if not h % delete_one_in:
                                w = without_one(w, h)
                        if w not in total:
                            size += len(w)
                        total[w] += c
                    if len(total) > HELD_WORDS or size > HELD_BYTES:
                        yield passed_on()
                        total, size = Counter(), 0
        yield passed_on()

    given = docs.select(F.col(quoted(id_col)).alias("__id"), F.col(quoted(text_col)).alias("__text"))
    return given.mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"))


# -- the trie ----------------------------------------------------------------------

def one_edit(a: str, b: str) -> bool:
    """Whether two different texts, of lengths that differ by one at most, differ
    by one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    k = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        k += 1
    return (a[k + 1:] if len(a) == len(b) else a[k:]) == b[k + 1:]


class Leaf:
    """Words of one vector, all of one length."""

    def __init__(self, words: list[str] | None = None):
        self.words: list[str] = words if words is not None else []
        self._halves: dict[int, tuple[dict, dict]] = {}

    def halves(self, k: int) -> tuple[dict[str, list[str]], dict[str, list[str]]]:
        """The words by their first and by their last ``k`` code points."""
        if k not in self._halves:
            heads, tails = defaultdict(list), defaultdict(list)
            for w in self.words:
                heads[w[:k]].append(w)
                tails[w[len(w) - k:]].append(w)
            self._halves[k] = heads, tails
        return self._halves[k]

    def near_pairs(self, other: Leaf) -> Iterator[tuple[str, str]]:
        """The near words of two leaves.  Words that differ by one edit agree
        in the first or in the last half of the shorter one; only those that
        do are verified."""
        k = min(len(self.words[0]), len(other.words[0])) // 2
        (heads, tails), (their_heads, their_tails) = self.halves(k), other.halves(k)
        for head in heads.keys() & their_heads.keys():
            for a in heads[head]:
                end = a[k:]
                for b in their_heads[head]:
                    if a != b and one_edit(end, b[k:]):
                        yield a, b
        for tail in tails.keys() & their_tails.keys():
            for a in tails[tail]:
                begin = a[:len(a) - k]
                for b in their_tails[tail]:
                    if a[:k] != b[:k] and one_edit(begin, b[:len(b) - k]):
                        yield a, b


def build_trie(words: list[tuple[tuple[int, ...], str]]) -> dict:
    """Words by their successive counts; the last level holds the leaves."""
    root: dict = {}
    for vector, word in words:
        node = root
        for c in vector[:-1]:
            node = node.setdefault(c, {})
        if vector[-1] not in node:
            node[vector[-1]] = Leaf()
        node[vector[-1]].words.append(word)
    return root


def leaves_within(root: dict, vector: tuple[int, ...], plus: int, minus: int) -> list[tuple[tuple[int, ...], Leaf]]:
    """Depth-first search for the leaves whose counts differ from ``vector`` by
    a surplus of at most ``plus`` and a deficit of at most ``minus`` in total."""
    found, last = [], len(vector)
    stack = [(root, (), plus, minus)]
    while stack:
        node, path, plus, minus = stack.pop()
        level = len(path)
        if level == last:
            found.append((path, node))
            continue
        c = vector[level]
        if c in node:
            stack.append((node[c], (*path, c), plus, minus))
        if plus and c + 1 in node:
            stack.append((node[c + 1], (*path, c + 1), plus - 1, minus))
        if minus and c - 1 in node:
            stack.append((node[c - 1], (*path, c - 1), plus, minus - 1))
    return found


def search_cell(homes: list[tuple[tuple[int, ...], str, int]],
                queries: list[tuple[tuple[int, ...], str, int, int, int]]) -> dict[str, list]:
    """Near words within a cell.  homes: (counts below the cell, word, n);
    queries: the same and the surplus and deficit left.  A query with both left
    is a word of the cell itself; each of its pairs is taken from the lesser.
    Returns word -> [number of near words, -n of the best, the best]."""
    root = build_trie([(v, w) for v, w, _ in homes])
    n_of = {w: n for _, w, n in homes}
    n_of.update((w, n) for _, w, n, _, _ in queries)
    best: dict[str, list] = {}

    def near(word: str, other: str) -> None:
        n = n_of[other]
        row = best.get(word)
        if row is None:
            best[word] = [1, -n, other]
            return
        row[0] += 1
        if -n < row[1] or -n == row[1] and other < row[2]:
            row[1], row[2] = -n, other

    asked = defaultdict(list)
    for vector, word, _, plus, minus in queries:
        asked[vector, plus, minus].append(word)
    for (vector, plus, minus), words in asked.items():
        own, query = bool(plus and minus), Leaf(words)
        for path, leaf in leaves_within(root, vector, plus, minus):
            if own and path < vector:
                continue
            once = own and path == vector
            for word, other in query.near_pairs(leaf):
                if not once or word < other:
                    near(word, other)
                    near(other, word)
    return best


# -- on Spark ----------------------------------------------------------------------

def vector_of(word: Column) -> Column:
    """Counts of the letters of each group."""
    whole = F.char_length(word)
    return F.array(*[whole - F.char_length(F.translate(word, g, "")) for g in LETTER_GROUPS])


def steps(levels: int) -> list[list[int]]:
    """The moves of the first ``levels`` counts within the budget, of each move
    and its opposite only one (the first change is a surplus); none comes first."""
    moves = [[0] * levels]
    for up in range(levels):
        moves.append([int(k == up) for k in range(levels)])
        moves += [[int(k == up) - int(k == down) for k in range(levels)] for down in range(up + 1, levels)]
    return moves


def _levels(vectors: DataFrame, cell_words: int) -> tuple[int, bool]:
    """Levels of the trie that make up the key, and whether cells stay larger."""
    for m in range(2, N_GROUPS):
        largest = vectors.groupBy(F.slice("v", 1, m)).agg(F.sum("c").alias("c")).agg(F.max("c")).first()[0]
        if (largest or 0) <= cell_words:
            return m, False
    return N_GROUPS - 1, True


def near_words(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """``(word, n_near, best_n, best)`` for the words of ``words`` (distinct
    ``word``, ``n``) with a near word: how many, and the one with the largest n
    (ties: the smallest in code-point order)."""
    spread = settled(words.select("word", "n", vector_of(F.col("word")).alias("v")))
    vectors = settled(spread.groupBy("v").agg(F.count(F.lit(1)).alias("c")))
    m, crowded = _levels(vectors, cell_words)
    large = vectors.groupBy(F.slice("v", 1, m).alias("cell")).agg(F.sum("c").alias("c")).filter(
        F.col("c") > cell_words).select("cell", F.ceil(F.col("c") / cell_words).cast("int").alias("blocks"))

    def dealt(rows: DataFrame, own: str, all_of: str) -> DataFrame:
        """Rows with their block: ``own`` by hash, every one of ``all_of``."""
        if not crowded:
            return rows.withColumns({own: F.lit(0), all_of: F.lit(0)})
        rows = rows.join(F.broadcast(large), "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        rows = rows.withColumn(all_of, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return rows.withColumn(own, F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")).drop("blocks")

    moves = F.array(*[F.array(*map(F.lit, s)) for s in steps(m)])
    rest = F.slice("v", m + 1, N_GROUPS - m).alias("rest")
    homes = spread.select(F.slice("v", 1, m).alias("cell"), F.lit(True).alias("is_home"), rest, "word", "n",
                          F.lit(0).alias("plus"), F.lit(0).alias("minus"))
    asked = spread.select("word", "n", "v", F.explode(moves).alias("move")).select(
        F.zip_with(F.slice("v", 1, m), "move", lambda a, b: a + b).alias("cell"), F.lit(False).alias("is_home"),
        rest, "word", "n", (1 - F.size(F.filter("move", lambda x: x > 0))).alias("plus"),
        (1 - F.size(F.filter("move", lambda x: x < 0))).alias("minus"),
    ).filter(~F.exists("cell", lambda x: x < 0))
    both = dealt(homes, "home", "asker").unionByName(dealt(asked, "asker", "home"))
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n_near", T.LongType()),
                           T.StructField("neg", T.LongType()), T.StructField("best", T.StringType())])
    out = to_arrow_schema(schema)

    def search(group: pa.Table) -> pa.Table:
        homes, queries = [], []
        for is_home, rest, word, n, plus, minus in zip(
                *(group.column(c).to_pylist() for c in ("is_home", "rest", "word", "n", "plus", "minus")), strict=True):
            if is_home:
                homes.append((tuple(rest), word, n))
            else:
                queries.append((tuple(rest), word, n, plus, minus))
        found = search_cell(homes, queries)
        return pa.table([list(found), *([row[k] for row in found.values()] for k in range(3))], schema=out)

    partial = both.groupBy("cell", "home", "asker").applyInArrow(search, schema)
    return partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("neg", "best")).alias("b")).select(
        "word", "n_near", (-F.col("b.neg")).alias("best_n"), F.col("b.best").alias("best"))


def roots_of(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for the rows of ``forms`` (word, form; no cycles): the
    last form reached.  Every round doubles the steps taken, so the rounds are
    the logarithm of the longest chain."""
    to = settled(forms.select("word", F.col("form").alias("root")))
    while True:
        up = to.select(F.col("word").alias("root"), F.col("root").alias("next"))
        to = settled(to.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        if to.filter("next is not null").limit(1).count() == 0:
            return to.drop("next")
        to = to.drop("next")


def variants_of(words: DataFrame, ratio: int = 2, cell_words: int = CELL_WORDS) -> DataFrame:
    """Per row of ``words`` (distinct ``word``, ``n``): ``form`` - the near word
    with the largest n (ties: the smallest in code-point order), if that n is at
    least ``ratio`` times the word's, else null; ``root`` - the last form
    reached from the word, or itself; ``n``, ``n_near`` and ``form_n``.

    Two words are near if they differ by exactly one inserted, deleted or
    replaced code point.  Words may hold any characters; those outside of the
    letter groups count for none of them.  No words: no rows.
    """
    words = settled(words.select("word", "n"))
    near = near_words(words, cell_words).withColumnRenamed("word", "__word")
    joined = words.join(near, F.col("word") == F.col("__word"), "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    found = settled(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")))
    roots = roots_of(found.filter("form is not null"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 5,
                      min_n: int = 3, ratio: int = 2, delete_one_in: int | None = DELETE_ONE_IN,
                      cell_words: int = CELL_WORDS) -> DataFrame:
    """The words of all texts with at least ``min_chars`` code points and
    ``min_n`` occurrences (see ``count_words``), grouped by spelling (see
    ``variants_of``).

    Null, empty and letterless texts have no words; rows with equal ids are
    counted each; other columns are not read.  An empty table gives no rows.
    """
    counted = count_words(docs, id_col, text_col, min_chars, delete_one_in).filter(F.col("n") >= min_n)
    return variants_of(counted, ratio, cell_words)
