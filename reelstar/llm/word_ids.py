"""Token ids of whole texts by a tokenizer of the tokenizers library, fast
where texts are made of the same words again and again.

For a tokenizer that lower-cases, drops white space and encodes every word or
run of symbols by itself, a text's ids are those of its words one after another.
Texts of ASCII and common Latin letters are cut into words here, a group of texts
at once and by the tokenizer's own rule over arrays of bytes, and every distinct
word is encoded once and remembered; all other texts are encoded whole by the
library.  Both ways give the same ids (tests hold them against each other).
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa

from .common import slices

#: Bytes of words and their ids that a worker remembers.
MEMO_BYTES = 64 << 20
#: What a word takes beside its bytes.
ENTRY_BYTES = 120
#: Bytes of text encoded together.
GROUP = 1 << 22

# The form of the tokenizers whose words can be encoded one by one.
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# For these characters lower-casing and composing are simple: ASCII and the
# letters U+00C0 to U+017F but the capital I with a dot.
_OTHER = re.compile(r"[^\x00-\x7fÀ-ÖØ-öø-įı-ſ]")
_LOWER = bytes(range(256)).lower()
_BLANK, _LETTER, _DIGIT, _SYMBOL = range(4)


def _kind(byte: int) -> int:
    c = bytes((byte,))
    return _BLANK if c.isspace() else _DIGIT if c.isdigit() else _LETTER if byte >= 0x80 or c.isalpha() else _SYMBOL


#: The kind of every byte of these texts; bytes over 0x7f are parts of letters.
_KINDS = bytes(map(_kind, range(256)))
#: What an apostrophe at the start of a run of symbols forms a word with.
_SHORT = [b"'s", b"'t", b"'re", b"'ve", b"'m", b"'ll", b"'d"]


def words_of(text: bytes) -> tuple[np.ndarray, pa.Array]:
    """Where the words of a lower-case text start, and the words (``_WORDS``)."""
    data = np.frombuffer(text, dtype=np.uint8)
    kind = np.frombuffer(text.translate(_KINDS), dtype=np.uint8)
    first = kind == _DIGIT
    first[:1] = True
    first[1:] |= kind[1:] != kind[:-1]
    inside = kind != _BLANK
    first &= inside
    if b"'" in text:
        marks = np.nonzero(first & (data == ord("'")))[0]
        after = np.concatenate((data, np.zeros(2, dtype=np.uint8)))  # of a mark: the two bytes behind it
        one, two = after[marks + 1], after[marks + 2]
        for short in _SHORT:
            found = marks[(one == short[1]) & ((two == short[2]) if len(short) > 2 else True)]
            first[found + 1] = False
            end = found + len(short)
            end = end[end < len(data)]
            first[end] |= inside[end]
    ends = np.append(np.nonzero(first[inside])[0], np.count_nonzero(inside)).astype(np.int32)
    return np.nonzero(first)[0], _bytes_array(ends, data[inside])


def _bytes_array(ends: np.ndarray, data: np.ndarray) -> pa.Array:
    """A binary array whose values stand one after another in ``data``."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])


class WordIds:
    """``encode(texts)``: an id array per text (null: empty)."""

    def __init__(self, path: str, memo: int = MEMO_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one core
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            text = f.read()
        self.path, self.most, form = path, memo, json.loads(text)
        steps = (form.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_words = (
            (form.get("normalizer") or {}).get("normalizers") == _NORMALIZERS
            and steps[0].get("pattern") == {"Regex": _WORDS}
            and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
            and form.get("post_processor") is None
            and bool(form["model"].get("end_of_word_suffix"))
        )
        suffix, vocab = form["model"].get("end_of_word_suffix") or "", form["model"]["vocab"]
        self.closes = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.closes[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        #: Strings that the tokenizer takes out of a text before anything else.
        self.special = [t["content"].encode() for t in form["added_tokens"]]
        self.of_words = Tokenizer.from_str(text)
        self.of_words.normalizer = None
        self.of_words.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._clear()

    @cached_property
    def tokenizer(self):
        """The tokenizer as it is, for whole texts."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.held = 0
        self.ids = np.empty(1 << 16, dtype="<u4")
        self.ends = np.zeros(1 << 14, dtype=np.int32)  # ends[k + 1]: end of word k in the bytes of ids

    def _learn(self, words: list[bytes]) -> None:
        given = [w.decode() for w in words]
        made = self.of_words.encode_batch_fast(
            [given[k: k + 512] for k in range(0, len(given), 512)], is_pretokenized=True, add_special_tokens=False)
        ids = np.concatenate([np.array(x.ids, dtype=np.uint32) for x in made])
        # every word's last token, and no other, carries the word-end suffix
        last = np.nonzero(self.closes[ids])[0]
        if len(last) != len(words) or last[-1] != len(ids) - 1:
            raise ValueError("the tokenizer does not end every word with a word-end token")
        at = len(self.number)
        start = int(self.ends[at]) // 4
        need = start + len(ids)
        while need > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
        while at + len(words) + 1 > len(self.ends):
            self.ends = np.concatenate((self.ends, np.zeros_like(self.ends)))
        self.ids[start:need] = ids
        self.ends[at + 1: at + 1 + len(words)] = 4 * (start + 1 + last)
        self.number.update(zip(words, range(at, at + len(words)), strict=True))
        self.held += sum(map(len, words)) + ENTRY_BYTES * len(words) + 4 * len(ids)

    def _numbers(self, words: pa.Array) -> pa.Array:
        """The number of every word in the memory, new words learnt."""
        found = words.dictionary_encode()
        known = found.dictionary.to_numpy(zero_copy_only=False)
        numbers = np.fromiter(map(self.number.get, known, repeat(-1)), np.int32, len(known))
        new = np.nonzero(numbers < 0)[0]
        if len(new):
            numbers[new] = np.arange(len(self.number), len(self.number) + len(new))
            self._learn(known[new].tolist())
        return pa.array(numbers).take(found.indices)

    def encode(self, texts: Iterable[bytes | None]) -> list[np.ndarray]:
        texts = [t or b"" for t in texts]
        out: list[list[np.ndarray]] = [[] for _ in texts]
        group, size = [], 0
        for k, text in enumerate(texts):
            for part in slices(text, GROUP) if self.by_words else [text]:
                group.append((k, part))
                size += len(part)
                if size >= GROUP:
                    self._encode(group, out)
                    group, size = [], 0
        self._encode(group, out)
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]

    def _lowered(self, part: bytes) -> bytes | None:
        """``part`` in lower case if it can be cut into words here."""
        if not self.by_words or any(s in part for s in self.special):
            return None
        if part.isascii():
            return part.translate(_LOWER)
        text = part.decode()
        return None if _OTHER.search(text) else text.lower().encode()

    def _encode(self, group: list[tuple[int, bytes]], out: list[list[np.ndarray]]) -> None:
        """Appends the ids of every (text, part); the parts of a text come in order."""
        lowered = [self._lowered(part) for _, part in group]
        whole = [part.decode() for (_, part), low in zip(group, lowered, strict=True) if low is None]
        made = iter(self.tokenizer.encode_batch_fast(whole, add_special_tokens=False) if whole else ())
        plain = [x for x in lowered if x is not None]
        if self.held > self.most:
            self._clear()
        ids, ends = np.empty(0, dtype=np.uint32), repeat(0)
        starts, words = words_of(b"\n".join(plain))
        if len(words):
            numbers = self._numbers(words)
            taken = _bytes_array(self.ends[:len(self.number) + 1], self.ids).take(numbers)
            _, offsets, data = taken.buffers()
            ids = np.frombuffer(data, dtype="<u4")
            upto = np.searchsorted(starts, np.cumsum([len(x) + 1 for x in plain]))
            ends = iter((np.frombuffer(offsets, dtype=np.int32)[upto] // 4).tolist())
        before = 0
        for (k, _), low in zip(group, lowered, strict=True):
            if low is None:
                out[k].append(np.array(next(made).ids, dtype=np.uint32))
            else:
                end = next(ends)
                out[k].append(ids[before:end])
                before = end


_KEPT: dict[tuple[str, int, int], WordIds] = {}


def ids_of(path: str) -> WordIds:
    """The worker's ids of the tokenizer file at ``path``, kept from task to task."""
    found = os.stat(path)
    key = path, found.st_mtime_ns, found.st_size
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = WordIds(path)
    return _KEPT[key]
