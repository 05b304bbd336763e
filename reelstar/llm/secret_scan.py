"""Secret scan: fixed patterns, widened by a linear-chain conditional random field.

The patterns below always count.  A conditional random field, trained on their
hits in a bounded sample of the documents, tags the tokens of every text as
beginning (B), inside (I) or outside (O) of a secret from the token's shape, its
neighbouring words and features of the whole file; Viterbi decoding gives the
best tag sequence.  What the patterns do not cover of the tagged tokens is added
as spans of kind ``crf``.

The hits of a corpus may all use one alphabet.  So the field also learns from
copies of the sampled texts in which every secret value is replaced, in its place,
by one drawn from another alphabet and length (``ALPHABETS``, ``LENGTHS``; the
draw follows from a checksum of the value).

Texts are cut into runs at blanks, and runs into tokens at quotes, commas,
semicolons, ampersands and braces, after a key and after ``PART`` characters, so
that the fields of dense text and the parts of a long run are tagged each on its own.
Every token of every line is tagged, whatever its characters and however far its
neighbours stand.  Scanning is one pass without a shuffle; every text is scanned whole.

A token's score is a sum over itself and its neighbours, so the parts are worked
out once per distinct token and worker (``Scorer``) and added up in arrays.  Where
staying outside (O) beats every other tag by more than all transitions around it
can make up for, O is part of the best sequence; Viterbi runs on the stretches
between such tokens, which gives the best sequence of the whole line.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, quoted, settled, texts_of

# The patterns of the base rule.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "crf")

#: Documents with and without a pattern hit that the field is trained on, and
#: the chains taken from them, at most.
SAMPLE_DOCS = 2_000
SAMPLE_CHAINS = 20_000
FEATURE_SPACE = 1 << 16
#: Features seen less often in training get no weight (rare neighbouring words).
MIN_SEEN = 10
_CHAIN_LIMIT = 64  # tokens of a training chain; longer ones are cut into several
_CHAIN_ROWS = 512  # training chains that leave a worker together
#: Of the tokens without digit or mark, one in so many is trained on.
PLAIN = 16
#: Alphabets and lengths of the values that take the place of found ones.
_LOWER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABETS = (
    _LOWER + _LOWER.upper() + _DIGITS, _LOWER + _DIGITS, _LOWER.upper() + _DIGITS,
    _LOWER + _LOWER.upper() + _DIGITS + "+/", _LOWER + _LOWER.upper() + _DIGITS + "_-", _DIGITS + "abcdef",
)
LENGTHS = (16, 44)
#: Copies with other values of every sampled text with a hit.
COPIES = 3

_ASSIGN_RE = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS_RE = re.compile(ACCESS)
_HEX_RE = re.compile(HEX.replace("+", "{%d,}" % MIN_HEX))
_KEYS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
#: The longest token.
PART = 400
_CUTS = "\"'`,;&{}"
_TOKEN_RE = re.compile(r"[^\x20\x09-\x0D%s]{1,%d}" % (_CUTS, PART))
_MARK_RE = re.compile(r"""[0-9=_+/\\:"'-]|[A-Z]{8}""")
_BLANK_RE = re.compile(r"[\x20\x09-\x0D]")
_BREAKS = "\n\x0b\x0c\r"
_RAW_RE = re.compile(r"[%s]+|%s" % (_BREAKS, _TOKEN_RE.pattern))
#: Distinct tokens whose scores a worker remembers (about 400 bytes each).
MEMO_TOKENS = 1 << 17
#: Texts are scored in groups of about this many bytes, and their results
#: leave the worker in parts of about so many.
GROUP_BYTES = 1 << 18
PART_BYTES = 1 << 22

Span = tuple[int, int, int]  # start, index of the kind, end


def base_spans(text: str, raw: bytes) -> list[tuple[Span, tuple[int, int]]]:
    """Pattern hits in order, each with the place of the secret value."""
    found = []
    low = raw.lower()
    if any(k in low for k in _KEYS):
        found += [((m.start(), 0, m.end()), m.span(2)) for m in _ASSIGN_RE.finditer(text)
                  if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if b"AKIA" in raw:
        found += [((m.start(), 1, m.end()), m.span()) for m in _ACCESS_RE.finditer(text)
                  if m.end() - m.start() >= MIN_ACCESS]
    found += [((m.start(), 2, m.end()), m.span()) for m in _HEX_RE.finditer(text)]
    return sorted(found)


_CLASSES = str.maketrans(_LOWER + _LOWER.upper() + _DIGITS, "a" * 26 + "A" * 26 + "9" * 10)
_RUN_RE = re.compile(r"(.)\1+", re.DOTALL)


def _shape(token: str) -> str:
    if token.isalpha():  # most tokens are words
        if token.islower():
            return "a"
        if token[0].isupper() and token[1:].islower():
            return "Aa"
    if token.isascii():
        short = _RUN_RE.sub(r"\1", token.translate(_CLASSES))
        return short[:8] + ("+" if len(short) > 8 else "")
    out = []
    for c in token:
        k = "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        if not out or out[-1] != k:
            out.append(k)
            if len(out) > 8:
                break
    return "".join(out[:8]) + ("+" if len(out) > 8 else "")


_NO_LETTERS = bytes(k for k in range(128) if not 97 <= k <= 122)


def _letters(token: str) -> bytes:
    """The first letters a to z of a token, lower-cased."""
    return token.lower().encode("ascii", "ignore").translate(None, _NO_LETTERS)[:24]


def _word(token: str) -> str:
    return _letters(token).decode()


_KEY_RE = re.compile(r"""["'(\[{]?([A-Za-z_]{1,40})["']?[:=]+["']?""")
_TRIM = "\"'`()[]{}<>,;"


def value_of(text: str, start: int, end: int) -> tuple[int, int]:
    """A token without a leading ``key=``, quotes and punctuation."""
    key = _KEY_RE.match(text, start, end)
    if key and key.end() < end:
        start = key.end()
    while start < end and text[start] in _TRIM:
        start += 1
    while end > start and text[end - 1] in _TRIM + ".:":
        end -= 1
    return start, end


def _own_features(token: str, blind: bool) -> list[str]:
    """Features of the token's value, and its key unless ``blind``."""
    key = _KEY_RE.match(token)
    start, end = value_of(token, 0, len(token))
    value = token[start:end] or token
    n = len(value)
    digits = sum(c.isdigit() for c in value)
    kinds = "".join(k for k, f in (("l", str.islower), ("u", str.isupper), ("d", str.isdigit)) if any(map(f, value)))
    marks = "".join(sorted({c for c in value if not c.isalnum()}))[:6]
    hexes = sum(c in "0123456789abcdef" for c in value) / len(value)
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(value, value[1:], strict=False))
    return [
        f"shape={_shape(value)}", f"length={min(n.bit_length(), 9)}", f"long={n >= 16}{n >= 24}{n >= 32}",
        f"digits={10 * digits // len(value)}", f"kinds={kinds}", f"marks={marks}", f"hex={hexes > 0.95}{n >= 16}",
        f"key={key[1].lower() if key and not blind else bool(key)}", f"mixed={kinds}{marks}{n >= 16}{turns > 3}",
    ]


def file_features(text: str, candidates: int) -> list[str]:
    return [f"size={len(text).bit_length() // 2}", f"assigns={'=' in text}",
            f"density={min((1000 * candidates // (len(text) + 1)).bit_length(), 6)}"]


def split_key(token: str) -> list[str]:
    """A token, cut after a leading key."""
    key = _KEY_RE.match(token) if "=" in token or ":" in token else None
    return [token[:key.end()], token[key.end():]] if key and key.end() < len(token) else [token]


def _assigned(token: str) -> str:
    # a colon assigns like an equals sign, as in the patterns
    return token.replace(":", "=")


def _last(token: str, blind: bool = False) -> list[str]:
    x = _assigned(token)
    return [f"last_shape={_shape(x)}"] + ([] if blind else [f"last={_word(x)}"])


def _next(token: str, blind: bool = False) -> list[str]:
    return [f"next_shape={_shape(token)}"] + ([] if blind else [f"next={_word(token)}"])


def _before(token: str) -> list[str]:
    return [f"before={_word(_assigned(token))}"]


def _keyed(before: str, last: str) -> list[str]:
    x = _assigned(last)
    return [f"keyed={_word(x) or _word(before)}|{x if len(x) < 3 else ''}"]


def numbers(names: list[str]) -> list[int]:
    return [zlib.crc32(n.encode()) % FEATURE_SPACE for n in names]


def marked_runs(text: str) -> list[tuple[int, int]]:
    """Places of the runs between blanks with a digit, a mark or eight capitals."""
    runs, at = [], 0
    while m := _MARK_RE.search(text, at):
        start = m.start()
        while start and not _BLANK_RE.match(text[start - 1]):
            start -= 1
        end = _BLANK_RE.search(text, m.end())
        at = end.start() if end else len(text)
        runs.append((start, at))
    return runs


@lru_cache(1 << 14)
def _own_numbers(token: str, blind: bool) -> list[int]:
    return numbers(_own_features(token, blind))


@lru_cache(1 << 14)
def _side_numbers(last: str, after: str, blind: bool) -> list[int]:
    return numbers([*_last(last, blind), *_next(after, blind)])


#: A token's place, the token, the two before it, the one after it.
Seen = tuple[tuple[int, int], str, tuple[str, str], str]


def seen_chains(text: str, pick: Callable[[int, int], bool] | None = None, near: list[tuple[int, int]] | None = None
                ) -> tuple[list[list[Seen]], list[int]]:
    """The tokens of every line as a chain, and the feature numbers all tokens
    share.  ``pick``: chains of neighbouring tokens with ``pick(start, end)`` only;
    ``near``: at least those that reach into one of these places."""
    raw = [m.span() for m in _RAW_RE.finditer(text)]
    at = [i for i, (s, _) in enumerate(raw) if text[s] not in _BREAKS]
    spans = [raw[i] for i in at]
    words = [text[s:e] for s, e in spans]
    common = numbers(["bias", *file_features(text, sum(1 for w in words if _MARK_RE.search(w)))])
    around = ["", "", *words, ""]
    found: list[list[Seen]] = []
    chain: list[Seen] = []
    last_k = -1
    for k in range(len(words)) if near is None else _reach(spans, words, at, pick, near):
        if chain and (k != last_k + 1 or at[k] != at[last_k] + 1):
            found.append(chain)
            chain = []
        last_k, (start, end) = k, spans[k]
        before, last, own, after = around[k: k + 4]
        pieces = split_key(own) if "=" in own or ":" in own else (own,)
        for j, piece in enumerate(pieces):
            place = (start, start + len(piece)) if not j else (end - len(piece), end)
            if pick and not pick(*place):
                if chain:
                    found.append(chain)
                    chain = []
                continue
            left = (last, pieces[0]) if j else (before, last)
            chain.append((place, piece, left, pieces[1] if not j and len(pieces) > 1 else after))
    if chain:
        found.append(chain)
    return found, common


def _reach(spans: list[tuple[int, int]], words: list[str], at: list[int], pick: Callable[[int, int], bool] | None,
           near: list[tuple[int, int]]) -> list[int]:
    """The words that the places ``near`` lie in, and those around them up to the
    end of the line or a word that is not picked (words with a key count as picked)."""
    def goes_on(k: int) -> bool:
        return not pick or "=" in words[k] or ":" in words[k] or pick(*spans[k])

    some: set[int] = set()
    for start, end in near:
        low = bisect.bisect_right(spans, start, key=lambda x: x[1])
        high = low
        while high < len(spans) and spans[high][0] < end:
            high += 1
        if low == high:
            continue
        while low and at[low - 1] == at[low] - 1 and goes_on(low - 1):
            low -= 1
        while high < len(spans) and at[high] == at[high - 1] + 1 and goes_on(high):
            high += 1
        some.update(range(low, high))
    return sorted(some)


def numbered(chain: list[Seen], common: list[int], blind: bool = False) -> list[tuple[int, int, list[int]]]:
    """A chain as (start, end, feature numbers).  ``blind``: without the words of
    keys and neighbours; these rows have as many numbers."""
    return [(*place, [*common[:1], *_own_numbers(piece, blind), *_side_numbers(left[1], right, blind),
                      *numbers(["blind"] * 4 if blind else [*_before(left[0]), *_keyed(*left)]), *common[1:]])
            for place, piece, left, right in chain]


def chains(text: str, blind: bool = False, pick: Callable[[int, int], bool] | None = None
           ) -> Iterator[list[tuple[int, int, list[int]]]]:
    """The tokens of every line as a chain: (start, end, feature numbers)."""
    found, common = seen_chains(text, pick)
    return (numbered(chain, common, blind) for chain in found)


O, B, I = 0, 1, 2  # noqa: E741
_FORBID = np.array([[0.0, 0.0, -np.inf], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]])  # from O not to I


class Field:
    """Weights of a linear-chain conditional random field over O, B, I."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves + _FORBID

    def decode(self, features: list[list[int]]) -> list[int]:
        """Viterbi; a chain begins after an outside token and ends before one."""
        return self.path(self.weights[np.array(features)].sum(axis=1))

    def path(self, score: np.ndarray) -> list[int]:
        best = score[0] + self.moves[O]
        back = []
        for emit in score[1:]:
            ways = best[:, None] + self.moves
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + emit
        tags = [int((best + self.moves[:, O]).argmax())]
        for step in reversed(back):
            tags.append(int(step[tags[-1]]))
        return tags[::-1]

    def outside(self, score: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where O is part of the best path for sure; ``ends``: the last of a chain.

        A path with another tag there is compared with one that has O instead,
        and B instead of a following I (O goes to no I)."""
        m = self.moves
        up = np.append(score[1:, I] - score[1:, B], -np.inf)
        up[ends] = -np.inf
        sure = np.ones(len(score), dtype=bool)
        for x in (B, I):
            turn = (m[:, x] - m[:, O]).max()
            plain = turn + (m[x, :I] - m[O, :I]).max()
            inner = turn + m[x, I] - m[O, B] + (m[I] - m[B]).max()
            sure &= score[:, O] - score[:, x] > np.maximum(plain, inner + up) + 1e-9
        return sure


#: Checksums of the beginnings of features; a word carries them on.
_LAST, _BEFORE, _NEXT, _KEYED = (zlib.crc32(x) for x in (b"last=", b"before=", b"next=", b"keyed="))


class Scorer:
    """Tags whole texts by a field; remembers the parts of the scores of
    distinct tokens, over ``most`` of them only of those that came again."""

    PARTS = 7  # own, of the part after the key, as last, before, next, and next and last inside of it

    def __init__(self, field: Field, most: int = MEMO_TOKENS):
        self.field, self.most = field, most
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.table = np.zeros((1024, self.PARTS, 3))
        self.flags = np.zeros((1024, 4), dtype=bool)  # cut after a key, a mark, no word, no word in the key
        self.breaks = np.zeros(1024, dtype=bool)
        self.again = np.zeros(1024, dtype=bool)  # came in a group after the one it was learned in
        self._clear_sums()
        self._learn({""})

    def _clear_sums(self) -> None:
        self.pairs: dict[tuple[str, str], np.ndarray] = {}
        self.own: dict[tuple, int] = {}
        self.own_sums: list[np.ndarray] = []
        self.files: dict[tuple, np.ndarray] = {}
        self.shapes: dict[str, int] = {}
        self.shape_weights: list[np.ndarray] = []

    def _forget(self) -> None:
        """Tokens that came once go; all of them if many came again."""
        kept = self.again[:len(self.at)].copy()
        kept[0] = True  # the empty token
        n = int(kept.sum())
        if n > self.most // 2:
            self._clear()
            return
        self.at = {token: k for k, token in enumerate(itertools.compress(self.at, kept.tolist()))}
        rows = max(1024, 2 * n)
        for name in ("table", "flags", "breaks", "again"):
            old = getattr(self, name)
            new = np.zeros((rows, *old.shape[1:]), dtype=old.dtype)
            if name != "again":
                new[:n] = old[:len(kept)][kept]
            setattr(self, name, new)
        self._clear_sums()

    def _sum(self, names: list[str]) -> np.ndarray:
        return self.field.weights[numbers(names)].sum(axis=0)

    def _own(self, token: str, shape: str) -> int:
        """Where the sums of the token's own features are; the token has no key."""
        if token.isalpha():
            value, n = token, len(token)
        else:
            start, end = value_of(token, 0, len(token))
            value = token[start:end] or token
            n = len(value)
            if n < len(token):
                shape = _shape(value)
        if n < 20 and value.isalpha():  # up to 19 letters are over 95 % hex where all are
            cased = None if value.isascii() else (any(map(str.islower, value)), any(map(str.isupper, value)))
            key = shape, n, cased, not value.strip("abcdef")
        else:
            key = tuple(_own_features(value, False))
        if key not in self.own:
            self.own[key] = len(self.own)
            self.own_sums.append(self._sum(_own_features(value, False)))
        return self.own[key]

    def _shaped(self, shape: str) -> int:
        """Where the weights of a shape, last or next, are."""
        if shape not in self.shapes:
            self.shapes[shape] = len(self.shapes)
            self.shape_weights.append(self.field.weights[numbers([f"last_shape={shape}", f"next_shape={shape}"])])
        return self.shapes[shape]

    def _learn(self, tokens: set[str]) -> None:
        size = len(self.at)
        while size + len(tokens) > len(self.table):
            self.table = np.concatenate((self.table, np.zeros_like(self.table)))
            self.flags = np.concatenate((self.flags, np.zeros_like(self.flags)))
            self.breaks = np.concatenate((self.breaks, np.zeros_like(self.breaks)))
            self.again = np.concatenate((self.again, np.zeros_like(self.again)))
        crc = zlib.crc32
        plain: list[int] = []
        own: list[int] = []
        shapes: list[int] = []
        words: list[int] = []
        for k, token in enumerate(tokens, size):
            self.at[token] = k
            if "=" in token or ":" in token or not token:
                self._learn_one(k, token)
                continue
            if token[0] in _BREAKS:
                self.breaks[k] = True
            word = _letters(token)
            shape = _shape(token)
            plain.append(k)
            own.append(self._own(token, shape))
            shapes.append(self._shaped(shape))
            tail = b"|" + token.encode() if len(token) < 3 else b"|"
            words += crc(word, _LAST), crc(word, _BEFORE), crc(word, _NEXT), crc(tail, crc(word, _KEYED))
            # letters without capitals but the first hold no mark
            if not word or not (token.isalpha() and token[1:].islower()):
                self.flags[k] = False, bool(_MARK_RE.search(token)), not word, False
        if plain:
            at = np.array(plain)
            w = self.field.weights[np.array(words).reshape(-1, 4) % FEATURE_SPACE]
            ends = np.stack(self.shape_weights)[shapes]
            self.table[at, 0] = np.stack(self.own_sums)[own]
            # without a word the key's features hang on the token before, too
            self.table[at, 2] = ends[:, 0] + w[:, 0] + np.where(self.flags[at, 2][:, None], 0, w[:, 3])
            self.table[at, 3] = w[:, 1]
            self.table[at, 4] = ends[:, 1] + w[:, 2]

    def _learn_one(self, k: int, token: str) -> None:
        row, pieces = np.zeros((self.PARTS, 3)), split_key(token)
        worded = [bool(_word(x)) for x in (token, pieces[0])]
        if token:
            row[0] = self._sum(_own_features(pieces[0], False))
        if len(pieces) > 1:
            row[1] = self._sum(_own_features(pieces[1], False))
            row[5] = self._sum(_next(pieces[1]))
            row[6] = self._sum(_last(pieces[0]) + (_keyed("", pieces[0]) if worded[1] else []))
        row[2] = self._sum(_last(token) + (_keyed("", token) if worded[0] else []))
        row[3], row[4] = self._sum(_before(token)), self._sum(_next(token))
        self.table[k] = row
        cut = len(pieces) > 1
        self.flags[k] = cut, bool(_MARK_RE.search(token)), not worded[0], cut and not worded[1]

    def _pair(self, before: str, last: str) -> np.ndarray:
        """The score of a key's features where the last token has no word."""
        key = (_word(before), _assigned(last) if len(last) < 3 else "")
        if key not in self.pairs:
            self.pairs[key] = self._sum(_keyed(before, last))
        return self.pairs[key]

    def scores(self, texts: list[str], found: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of the tokens of all texts, one text after another, for O, B,
        I; the last ones of the chains; and where the tokens of each text begin."""
        if len(self.at) > self.most:
            self._forget()
        elif max(map(len, (self.pairs, self.own, self.shapes))) > self.most // 4:
            self._clear_sums()
        known = len(self.at)
        if new := set().union(*found).difference(self.at):
            self._learn(new)
        # two empty tokens after every text keep its neighbours from the next one's
        line = [w for words in found for w in (*words, "", "")]
        every = np.fromiter(map(self.at.__getitem__, line), dtype=np.int64, count=len(line))
        self.again[every[every < known]] = True
        upto = np.cumsum([len(words) + 2 for words in found])
        cuts = self.breaks[every]
        ids = every[~cuts]
        begin = np.append(0, upto - np.cumsum(cuts)[upto - 1])  # of the texts in ``ids``
        last = np.concatenate(([0], ids[:-1]))
        before = np.concatenate(([0], last[:-1]))
        after = np.append(ids[1:], 0)
        t, (cut, mark, _, _) = self.table, self.flags[ids].T
        first = t[ids, 0] + t[last, 2] + t[before, 3] + np.where(cut[:, None], t[ids, 5], t[after, 4])
        bare = np.flatnonzero(self.flags[last, 2])
        words = [w for w in line if not w or w[0] not in _BREAKS] if len(bare) or cut.any() else []
        around = ["", "", *words]
        for k in bare.tolist():
            first[k] += self._pair(around[k], around[k + 1])
        place = np.arange(len(ids)) + np.cumsum(cut) - cut
        score = np.empty((len(ids) + int(cut.sum()), 3))
        score[place] = first
        if cut.any():
            at = np.flatnonzero(cut)
            second = t[ids[at], 1] + t[ids[at], 6] + t[last[at], 3] + t[after[at], 4]
            for j, k in enumerate(at.tolist()):
                if self.flags[ids[k], 3]:
                    second[j] += self._pair(around[k + 1], split_key(words[k])[0])
            score[place[at] + 1] = second
        rows = np.append(place, len(score))[begin]
        marks = np.append(0, np.cumsum(mark))[begin]
        common = [self._file(text, n) for text, n in zip(texts, np.diff(marks).tolist(), strict=True)]
        score += np.repeat(np.array(common).reshape(-1, 3), np.diff(rows), axis=0)
        # tokens before each break, and the last ones of the texts, in front of the empty ones
        breaks = np.flatnonzero(cuts)
        ended = np.concatenate((breaks - np.arange(len(breaks)), begin[1:] - 2))
        ends = (place + cut)[ended[ended > 0] - 1]
        empty = np.concatenate((rows[1:] - 2, rows[1:] - 1))
        kept = np.ones(len(score), dtype=bool)
        kept[empty] = False
        number = np.cumsum(kept) - 1
        return score[kept], number[ends[kept[ends]]], rows - 2 * np.arange(len(rows))

    def _file(self, text: str, marks: int) -> np.ndarray:
        key = tuple(file_features(text, marks))
        if key not in self.files:
            self.files[key] = self._sum(["bias", *key])
        return self.files[key]

    def tagged(self, text: str) -> list[tuple[int, int]]:
        """Start and end of every tagged stretch of tokens."""
        return self.tagged_all([text])[0]

    def tagged_all(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """The same for many texts at once."""
        score, ends, begin = self.scores(texts, [_RAW_RE.findall(text) for text in texts])
        made: list[list[tuple[int, int]]] = [[] for _ in texts]
        open_ = np.flatnonzero(~self.field.outside(score, ends)) if len(score) else []
        if not len(open_):
            return made
        # stretches: neighbours without the end of a chain between them
        new = np.ones(len(open_), dtype=bool)
        new[1:] = (np.diff(open_) > 1) | np.isin(open_[:-1], ends)
        stretches: dict[int, list[tuple[int, int]]] = {}
        for at in np.split(open_, np.flatnonzero(new)[1:]):
            tags = self.field.path(score[at])
            of = int(np.searchsorted(begin, at[0], side="right")) - 1
            k = 0
            while k < len(tags):
                e = k + 1
                if tags[k] != O:
                    while e < len(tags) and tags[e] == I:
                        e += 1
                    stretches.setdefault(of, []).append((int(at[k] - begin[of]), int(at[e - 1] - begin[of])))
                k = e
        for of, found in stretches.items():
            places = [p for m in _RAW_RE.finditer(texts[of]) if m[0][0] not in _BREAKS for p in _places(m)]
            made[of] = [(places[a][0], places[b][1]) for a, b in found]
        return made


_KEPT: dict[bytes, Scorer] = {}


def scorer_of(field: Field) -> Scorer:
    """The worker's scorer of a field, kept from task to task."""
    key = hashlib.sha256(field.weights.tobytes() + field.moves.tobytes()).digest()
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Scorer(field)
    return _KEPT[key]


def _places(m: re.Match) -> list[tuple[int, int]]:
    cut = m.start() + len(split_key(m[0])[0])
    return [(m.start(), cut)] + ([(cut, m.end())] if cut < m.end() else [])


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(samples: list[tuple[list[list[int]], list[int]]], rounds: int = 120, rate: float = 0.3,
        decay: float = 0.1) -> Field:
    """Regularised maximum likelihood by forward-backward and AdaGrad over all
    chains at once; deterministic."""
    samples = sorted(samples, key=lambda s: (-len(s[1]), s))
    x = np.array([f for feats, _ in samples for f in feats])
    y = np.array([t for _, tags in samples for t in tags])
    length = np.array([len(tags) for _, tags in samples])
    first = np.concatenate(([0], np.cumsum(length)[:-1]))
    last = first + length - 1
    steps = [first[length > t] + t for t in range(1, int(length.max()))]
    common = (np.bincount(x.ravel(), minlength=FEATURE_SPACE) >= MIN_SEEN)[:, None]
    w, m = np.zeros((FEATURE_SPACE, 3)), np.zeros((3, 3))
    gw, gm = np.full_like(w, 1e-6), np.full_like(m, 1e-6)
    hit = np.zeros((len(y), 3))
    hit[np.arange(len(y)), y] = 1
    for _ in range(rounds):
        moves = m + _FORBID
        emit = w[x].sum(axis=1)
        fore, rear = np.empty_like(emit), np.empty_like(emit)
        fore[first] = emit[first] + moves[O]
        for at in steps:
            fore[at] = _lse(fore[at - 1][:, :, None] + moves, 1) + emit[at]
        rear[last] = moves[:, O]
        for at in reversed(steps):
            rear[at - 1] = _lse(moves + (emit[at] + rear[at])[:, None, :], 2)
        total = np.repeat(_lse(fore[last] + moves[:, O], 1), length)
        wrong = np.exp(fore + rear - total[:, None]) - hit  # expected minus observed
        dw = np.stack([np.bincount(x.ravel(), np.repeat(wrong[:, k], x.shape[1]), FEATURE_SPACE) for k in range(3)], axis=1)
        dm = np.zeros((3, 3))
        dm[O] += wrong[first].sum(axis=0)
        dm[:, O] += wrong[last].sum(axis=0)
        for at in steps:
            joint = np.exp(fore[at - 1][:, :, None] + moves + (emit[at] + rear[at])[:, None, :] - total[at][:, None, None])
            dm += joint.sum(axis=0) - hit[at - 1].T @ hit[at]
        dw, dm = (dw + decay * w) * common, dm + decay * m
        gw, gm = gw + dw * dw, gm + dm * dm
        w -= rate * dw / np.sqrt(gw)
        m -= rate * dm / np.sqrt(gm)
    return Field(w, m)


def tags_of(chain: list[tuple[int, int, list[int]]], values: list[tuple[int, int]]) -> list[int]:
    """B, I, O of a chain from the places of secret values."""
    tags, open_ = [], None
    for start, end, _ in chain:
        over = next((v for v in values if v[0] < end and v[1] > start), None)
        tags.append(O if over is None else I if over == open_ else B)
        open_ = over
    return tags


def resampled(text: str, values: list[tuple[int, int]], copy: int) -> tuple[str, list[tuple[int, int]]]:
    """The text with other values in the places of ``values``, and their places.
    Equal values become equal ones."""
    parts, places, at, size = [], [], 0, 0
    for start, end in sorted(set(values)):
        if start < at:
            continue
        rng = np.random.default_rng([zlib.crc32(text[start:end].encode()), copy])
        letters = ALPHABETS[rng.integers(len(ALPHABETS))]
        value = "".join(letters[k] for k in rng.integers(0, len(letters), rng.integers(*LENGTHS)))
        parts += [text[at:start], value]
        size += start - at
        places.append((size, size + len(value)))
        size += len(value)
        at = end
    return "".join([*parts, text[at:]]), places


def training_tokens(text: str, values: list[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Which tokens the field is trained on: those of runs with a digit or mark,
    those of values, and of the others (nearly all of a text, all alike) those
    whose checksum is a multiple of ``PLAIN``."""
    runs = sorted([*marked_runs(text), *values])
    starts = [s for s, _ in runs]
    reach = list(itertools.accumulate((e for _, e in runs), max))

    def pick(start: int, end: int) -> bool:
        k = bisect.bisect_left(starts, end)  # runs before ``k`` begin before the token's end
        return (k > 0 and reach[k - 1] > start) or zlib.crc32(f"{start} {text[start:end]}".encode()) % PLAIN == 0

    return pick


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample_docs: int = SAMPLE_DOCS, sample_chains: int = SAMPLE_CHAINS) -> Field | None:
    """The field fitted on the pattern hits of at most ``sample_docs``
    documents with a hit and as many without (smallest hashes of the id first),
    with ``COPIES`` copies of other values, and at most ``sample_chains`` chains
    of them.  None without any hit.  One pass tells the documents with a hit."""
    key, text = F.col(quoted(id_col)), F.col(quoted(text_col))
    # a text without the word of a pattern is not searched for the pattern
    low, body = F.lower("text"), F.col("text")
    keyed = reduce(or_, (low.contains(k.decode()) for k in _KEYS))
    hit = (keyed & body.rlike(f"(?i:{ASSIGN.rsplit('(', 1)[0]})[A-Za-z0-9+/_.=-]{{{MIN_ASSIGN},}}")
           | body.contains("AKIA") & body.rlike(f"AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}")
           | body.rlike(f"[0-9a-f]{{{MIN_HEX},}}"))
    known = docs.select(key.alias("id"), text.alias("text")).filter("id IS NOT NULL AND text IS NOT NULL")

    flagged = settled(known.select("id", hit.alias("hit")))

    def some(which: DataFrame) -> DataFrame:
        return which.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample_docs)

    ids = some(flagged.filter("hit")).union(some(flagged.filter("NOT hit"))).collect()
    if not ids:
        return None
    chosen = known.sparkSession.createDataFrame(ids, known.select("id").schema).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in texts_of(batch.column(0)):
                body = raw.decode()
                values = [v for _, v in base_spans(body, raw)]
                # one copy at a time, and its chains in parts, however long the text is
                copies = ((body, values) if not k else resampled(body, values, k - 1) for k in range(1 + COPIES * bool(values)))
                # also without words, so that the weights rest on shapes as well
                every = ((c[at: at + _CHAIN_LIMIT], part)
                         for k, (made, places) in enumerate(copies)
                         for found, common in [seen_chains(made, training_tokens(made, places), places if k else None)]
                         for blind in (False, True) for chain in found for c in [numbered(chain, common, blind)]
                         for tags in [tags_of(c, places)]
                         for at in range(0, len(c), _CHAIN_LIMIT)
                         if B in (part := tags[at: at + _CHAIN_LIMIT]) or not k)
                while rows := list(itertools.islice(every, _CHAIN_ROWS)):
                    feats = [[f for _, _, fs in c for f in fs] for c, _ in rows]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([zlib.crc32(np.array(f).tobytes()) >> 2 * (B in t) for f, (_, t) in zip(feats, rows, strict=True)],
                                  type=pa.int64()),
                         pa.array(feats, type=pa.list_(pa.int32())),
                         pa.array([t for _, t in rows], type=pa.list_(pa.int32()))],
                        names=["h", "features", "tags"])

    # the chosen ids are at most 2 * sample_docs rows
    taken = known.join(F.broadcast(chosen), "id", "left_semi").select("text").mapInArrow(
        run, "h long, features array<int>, tags array<int>")
    rows = taken.orderBy("h", "features").limit(sample_chains).collect()
    samples = [(np.array(r["features"]).reshape(len(r["tags"]), -1).tolist(), list(r["tags"])) for r in rows]
    if not any(B in tags for _, tags in samples):
        return None
    return fit(samples)


def uncovered(start: int, end: int, spans: list[Span]) -> Iterator[tuple[int, int]]:
    """The parts of ``start`` to ``end`` outside of ``spans`` (in order)."""
    for s, _, e in spans:
        if s < end and e > start:
            if start < s:
                yield start, s
            start = max(start, e)
    if start < end:
        yield start, end


def scan(raw: bytes | None, field: Field | None, tagged: list[tuple[int, int]] | None = None) -> list[Span]:
    """All spans of a text by start, then kind; ``tagged``: what a scorer of
    ``field`` has found in it."""
    if not raw:
        return []
    text = raw.decode()
    found = [s for s, _ in base_spans(text, raw)]
    if field is None:
        return found
    extra: list[Span] = []
    for first, last in Scorer(field).tagged(text) if tagged is None else tagged:
        for part in uncovered(first, last, found):
            start, end = value_of(text, *part)
            if any(c.isalnum() for c in text[start:end]):
                extra.append((start, 3, end))
    return sorted(found + extra)


def grouped(texts: list[bytes | None], limit: int = GROUP_BYTES) -> Iterator[list[bytes | None]]:
    """Texts in groups of about ``limit`` bytes."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t or b"")
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redacted(raw: bytes | None, spans: list[Span], mark: str = "[SECRET]") -> str | None:
    """The text with every run of overlapping spans replaced by ``mark``."""
    if raw is None:
        return None
    text, parts, at = raw.decode(), [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


FIELDS = [
    *(T.StructField(c, T.LongType()) for c in ("n_assign", "n_access", "n_hex", "n_crf")),
    T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
]


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
                redact: bool = False, field: Field | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default) with the number of spans of
    every kind, ``base_sha256`` (of the pattern spans' list) and ``spans`` (the
    list of all: ``kind:start:end`` by start, then kind; code points, end
    exclusive).  With ``redact`` the kept text has ``[SECRET]`` for every run
    of overlapping spans.

    The field is trained on ``docs`` unless one is given; without any pattern
    hit there is none and only patterns count.  Spans by the field never
    overlap a pattern span: what a pattern covers is taken out of them.  Null or empty text has no span (null stays null).
    Rows with equal or null ids are scanned each on its own.  An empty table
    gives an empty table.  Input columns with the name of an output column are
    replaced.
    """
    field = field or train(docs, id_col, text_col)

    def make():
        scorer = scorer_of(field) if field else None

        def run(texts: list[bytes | None], _) -> dict:
            out: dict[str, list] = {f.name: [] for f in fields}
            for raw, tagged in ((r, t) for group in grouped(texts) for r, t in zip(
                    group, scorer.tagged_all([(r or b"").decode() for r in group]) if scorer else [None] * len(group), strict=True)):
                spans = scan(raw, field, tagged)
                for k, name in enumerate(("n_assign", "n_access", "n_hex", "n_crf")):
                    out[name].append(sum(s[1] == k for s in spans))
                base = listed([s for s in spans if s[1] < 3])
                out["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
                out["spans"].append(listed(spans))
                if redact:
                    out[text_col].append(redacted(raw, spans))
            return out

        return run

    fields = FIELDS + [T.StructField(text_col, T.StringType())] * redact
    out = map_texts(docs, make, fields, text_col, keep, PART_BYTES)
    order = [c for c in docs.columns if c in out.columns]
    return out.select(*[quoted(c) for c in order], *[quoted(c) for c in out.columns if c not in order])
