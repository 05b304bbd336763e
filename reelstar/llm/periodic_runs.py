"""Periodic runs of words: every maximal repetition of a text, exactly.

A text without words that occur three times holds no run, and a word that
occurs less often lies in none: the text is cut there, again and again, and
only stretches that may hold a run go on.  For each stretch:

* Ukkonen's suffix tree; an Euler tour through it with range minima answers the
  longest common extension of two places in constant time (the string depth of
  the lowest common ancestor of their leaves);
* the order of the leaves ranks the suffixes; the longest Lyndon word at a
  place ends at the next smaller suffix, under the order of the words and under
  its reverse.  These are the candidate roots: every run has one as its period;
* each root is extended to the right in this tree and to the left in the tree of
  the reversed stretch.

The work is per row: no shuffle, one Arrow batch at a time.  Words are kept as
references to one copy of each distinct word; only one tree is alive at a time.
"""

from __future__ import annotations

import zlib
from collections import Counter
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_texts, slices

#: A run has at least this many words and this many periods.
MIN_WORDS, MIN_PERIODS = 24, 3
#: Words that are joined at a time for a digest.
JOINED = 1 << 16


# -- longest common extensions -------------------------------------------------

def suffix_tree(s: list[int]) -> tuple[list[dict[int, int]], list[int]]:
    """Ukkonen's suffix tree of ``s``, whose last symbol occurs once: the
    children of every inner node by first symbol (``~k`` is the leaf of suffix
    k) and the nodes' string depths."""
    kids: list[dict[int, int]] = [{}]
    at, depth, link = [0], [0], [0]
    node = edge = length = todo = 0
    for i, c in enumerate(s):
        todo += 1
        last = 0
        while todo:
            if not length:
                edge = i
            below = kids[node]
            child = below.get(s[edge])
            if child is None:
                below[s[edge]] = ~(i - todo + 1)
                if last:
                    link[last] = node
                    last = 0
            else:
                if child >= 0:
                    reach = depth[child] - depth[node]
                    if length >= reach:
                        edge += reach
                        length -= reach
                        node = child
                        continue
                    begin = at[child]
                else:
                    begin = ~child
                d = depth[node] + length
                if s[begin + d] == c:
                    length += 1
                    if last:
                        link[last] = node
                    break
                new = len(kids)
                kids.append({s[begin + d]: child, c: ~(i - todo + 1)})
                at.append(begin)
                depth.append(d)
                link.append(0)
                below[s[edge]] = new
                if last:
                    link[last] = new
                last = new
            todo -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - todo + 1
    return kids, depth


class Extensions:
    """Longest common prefixes of suffixes of ``s`` (symbols over 0) in
    constant time, and the suffixes' ranks (the end is smaller than all)."""

    def __init__(self, s: list[int]):
        kids, depth = suffix_tree([*s, 0])
        # Euler tour: the depth at every visit of an inner node; a leaf stands
        # between the visits of its parent before and after it
        visits: list[int] = []
        leaves: list[int] = []
        seen: list[int] = []
        n = len(kids)
        stack = [0]
        while stack:
            x = stack.pop()
            if x < 0:
                seen.append(len(visits))
                leaves.append(~x)
            elif x >= n:
                visits.append(depth[x - n])
            else:
                visits.append(depth[x])
                below = kids[x]
                for symbol in sorted(below, reverse=True):
                    stack.append(x + n)
                    stack.append(below[symbol])
        del kids, depth
        self.rank = np.empty(len(leaves), np.int32)
        self.rank[leaves] = np.arange(len(leaves), dtype=np.int32)
        # minima of the tour between neighbouring leaves, then over 2^k of them
        low = np.minimum.reduceat(np.array(visits, np.int32), seen)[:-1] if len(seen) > 1 else np.zeros(0, np.int32)
        self.least = [low]
        while 2 * (step := 1 << (len(self.least) - 1)) <= len(low):
            self.least.append(np.minimum(self.least[-1][:-step], self.least[-1][step:]))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of the suffixes ``a`` and ``b``,
        which differ."""
        x, y = self.rank[a], self.rank[b]
        x, y = np.minimum(x, y), np.maximum(x, y)
        k = np.frexp((y - x).astype(np.float64))[1] - 1
        out = np.empty(len(x), np.int64)
        for level in np.unique(k):
            m = k == level
            least = self.least[level]
            out[m] = np.minimum(least[x[m]], least[y[m] - (1 << int(level))])
        return out


def next_below(rank: list[int]) -> tuple[list[int], list[int]]:
    """For every place the next one with a smaller and with a greater rank
    (the number of places if there is none)."""
    n = len(rank)
    smaller, greater = [n] * n, [n] * n
    down: list[int] = []
    up: list[int] = []
    for i, r in enumerate(rank):
        while down and rank[down[-1]] > r:
            smaller[down.pop()] = i
        while up and rank[up[-1]] < r:
            greater[up.pop()] = i
        down.append(i)
        up.append(i)
    return smaller, greater


def runs_of_symbols(s: list[int], min_words: int = MIN_WORDS, periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of the maximal runs of ``s`` (symbols over
    0) with at least ``min_words`` symbols and ``periods`` (two or more) periods."""
    n = len(s)
    if n < max(min_words, 2):
        return []
    right = Extensions(s)
    smaller, greater = next_below(right.rank.tolist())
    place = np.arange(n)
    roots = []
    for after in (smaller, greater):
        end = np.array(after[:n], np.int64)
        ok = end < n  # a root that reaches the end mark is none
        roots.append((place[ok], end[ok] - place[ok]))
    i, p = (np.concatenate(x) for x in zip(*roots, strict=True))
    least = np.maximum(min_words, periods * p)
    ok = least <= n
    i, p, least = i[ok], p[ok], least[ok]
    fw = right.common(i, i + p)
    del right
    # the root's first occurrence in a run stands less than a period behind its start
    ok = fw + 2 * p - 1 >= least
    i, p, fw, least = i[ok], p[ok], fw[ok], least[ok]
    if not len(i):
        return []
    bw = np.zeros(len(i), np.int64)
    inner = np.flatnonzero(i > 0)
    if len(inner):
        left = Extensions(s[::-1])
        bw[inner] = left.common(n - i[inner], n - i[inner] - p[inner])
    length = bw + p + fw
    ok = length >= least
    return sorted(set(zip((i - bw)[ok].tolist(), length[ok].tolist(), p[ok].tolist(), strict=True)),
                  key=lambda r: (r[0], r[2]))


# -- texts -----------------------------------------------------------------------

def words_of(text: bytes) -> list[bytes]:
    """The words of a text, each distinct one held once."""
    if len(text) < 1 << 20:
        return text.split()
    held: dict[bytes, bytes] = {}
    words: list[bytes] = []
    for part in slices(text):
        words += [held.setdefault(w, w) for w in part.split()]
    return words


def stretches(words: list[bytes], min_words: int = MIN_WORDS, periods: int = MIN_PERIODS) -> list[tuple[int, int]]:
    """Parts of ``words`` outside of which no run lies: every word of a part
    occurs ``periods`` times in it."""
    todo, done = [(0, len(words))], []
    while todo:
        a, z = todo.pop()
        if z - a < min_words:
            continue
        part = words[a:z] if (a, z) != (0, len(words)) else words
        count = Counter(part)
        if min(count.values()) >= periods:
            done.append((a, z))
            continue
        begin = a
        for k, w in enumerate(part, a):
            if count[w] < periods:
                if k - begin >= min_words:
                    todo.append((begin, k))
                begin = k + 1
        if z - begin >= min_words:
            todo.append((begin, z))
    return sorted(done)


def runs_of_words(words: list[bytes], min_words: int = MIN_WORDS, periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of the runs of a text, by start, then period."""
    runs = []
    for a, z in stretches(words, min_words, periods):
        number: dict[bytes, int] = {}
        s = [number.setdefault(w, len(number) + 1) for w in words[a:z]]
        runs += [(a + start, length, p) for start, length, p in runs_of_symbols(s, min_words, periods)]
    return runs


def repeated_tail(words: list[bytes], doc_id) -> list[bytes]:
    """The words of a document whose id's crc32 (of its decimal text) is
    divisible by ten, its tail repeated: each word i >= a becomes word
    a + (i - a) % p.  Other documents, and those without id, stay."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * -(-(n - a) // p))[:n - a]


def _joined_digest(words: list[bytes], dropped: np.ndarray | None) -> str:
    digest, sep = sha256(), b""
    for k in range(0, len(words), JOINED):
        part = words[k:k + JOINED]
        if dropped is not None:
            part = [w for w, gone in zip(part, dropped[k:k + JOINED].tolist(), strict=True) if not gone]
        if part:
            digest.update(sep + b" ".join(part))
            sep = b" "
    return digest.hexdigest()


def described(words: list[bytes], runs: list[tuple[int, int, int]]) -> dict:
    """The columns of one document."""
    start = length = period = milli = dropped = None
    if runs:
        start, length, period = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        milli = 1000 * length // period
        dropped = np.zeros(len(words), bool)
        for a, n, p in runs:
            dropped[a + p:a + n] = True
    listed = "".join(f"{a},{n},{p}\n" for a, n, p in runs)
    return {"n_runs": len(runs), "start": start, "length": length, "period": period, "exponent_milli": milli,
            "runs_sha256": sha256(listed.encode()).hexdigest(), "collapsed_sha256": _joined_digest(words, dropped),
            "runs": [{"start": a, "length": n, "period": p} for a, n, p in runs]}


_NUMBERS = ("start", "length", "period", "exponent_milli")
_RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
_FIELDS = [T.StructField("n_runs", T.LongType()), *[T.StructField(c, T.LongType()) for c in _NUMBERS],
           T.StructField("runs_sha256", T.StringType()), T.StructField("collapsed_sha256", T.StringType()),
           T.StructField("runs", T.ArrayType(_RUN))]


def periodic_runs(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None,
                  tail_id: str | None = None, min_words: int = MIN_WORDS, periods: int = MIN_PERIODS) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default), and per document
    ``n_runs``; ``start``, ``length``, ``period`` and ``exponent_milli`` of the
    run with the greatest length / period (ties: smallest start, then period; no
    run: nulls); ``runs_sha256`` and ``collapsed_sha256``, digests of the list of
    all runs and of the text without the repetitions (words joined by a space);
    and ``runs``, all of them.

    A run is a stretch of words (maximal runs of other characters than space
    and U+0009 to U+000D) with smallest period q, of at least ``min_words`` words
    and ``periods`` periods, that neither neighbour continues.  With ``tail_id``,
    the name of an id column, the tails of some documents are repeated first (see
    ``repeated_tail``).

    Null and blank texts have no words, no runs and the digest of nothing.  Rows
    with equal or null ids are described apart.  An empty table gives none.
    Input columns with the name of a result column are replaced by it.
    """
    at = None
    if tail_id is not None:
        names = {f.name for f in _FIELDS}
        kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
        if tail_id not in kept:
            raise ValueError(f"the column {tail_id} must be kept")
        at = kept.index(tail_id)

    def make():
        def one(texts: list[bytes | None], batch: pa.RecordBatch) -> dict:
            ids = batch.column(at).to_pylist() if at is not None else [None] * len(texts)
            rows = []
            for text, doc_id in zip(texts, ids, strict=True):
                words = repeated_tail(words_of(text or b""), doc_id)
                rows.append(described(words, runs_of_words(words, min_words, periods)))
            return {f.name: [r[f.name] for r in rows] for f in _FIELDS}

        return one

    return map_texts(docs, make, _FIELDS, text_col, keep)
