"""SentencePiece encoding and decoding on the tokenizers library.

The model file (a protobuf) is read here, and from its pieces, scores and
normaliser settings a ``tokenizers.Tokenizer`` is rebuilt: the compiled
character map, the white-space marker with its leading dummy, unigram scores or
BPE merges (ordered by score), byte fallback, and the matching decoder.

If no piece has a marker after another character and the normaliser changes
nothing else, a text's ids are those of its *segments* (a run of spaces with
what follows up to the next space), one after another.  Then every distinct
segment is encoded once per worker as long as it is remembered, in multithreaded
batches; otherwise whole texts are.  Texts are cut and ids put together in arrays.  Decoding cuts the ids before every piece that begins with a marker
(no run of byte pieces crosses such a cut), and the tokenizers decoder makes the
text of every distinct stretch of ids, again in multithreaded batches.
Encoding, decoding and the parity check against the sentencepiece library run in
one pass over the partitions, without a shuffle.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, map_texts, quoted

MARK = "▁"
_MARK = MARK.encode()
#: Bytes of segments, and of stretches of ids, that a worker remembers (each).
MEMO_BYTES = 160 << 20
#: Longer segments are not remembered.
LONGEST = 512
#: What an entry of a dictionary takes beside its bytes.
ENTRY_BYTES = 160
#: Segments that are given to the tokenizers library as one text.
ROW = 64
#: Threads of a batch at least.
THREADS = 2
# Fixed values of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at: at + size]
        at += size


@dataclass
class Model:
    """What a model file holds that encoding needs."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # piece, score, type
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True  # runs of spaces become one, outer ones go
    suffix_marker: bool = False

    @property
    def unk_id(self) -> int:
        return next(k for k, p in enumerate(self.pieces) if p[2] == UNKNOWN)

    @cached_property
    def by_segments(self) -> bool:
        """Whether segments can be encoded one by one."""
        inner = re.compile(f"[^{MARK}]{MARK}")
        return (not self.charsmap and not self.squeeze and self.dummy_prefix
                and not any(inner.search(p) for p, _, t in self.pieces if t in (NORMAL, USER_DEFINED)))


def parse_model(data: bytes) -> Model:
    """The model of a serialized sentencepiece file."""
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model.pieces.append((piece, score, kind))
        elif number == 2:
            got = dict(_fields(value))
            model.kind = got.get(3, UNIGRAM)
            model.byte_fallback = bool(got.get(35, 0))
            model.suffix_marker = bool(got.get(24, 0))
        elif number == 3:
            got = dict(_fields(value))
            model.charsmap = got.get(2, b"")
            model.dummy_prefix = bool(got.get(3, 1))
            model.squeeze = bool(got.get(4, 1))
    if model.kind not in (UNIGRAM, BPE) or model.suffix_marker:
        raise ValueError("only unigram and BPE models with a leading marker are supported")
    if any(kind == USER_DEFINED for _, _, kind in model.pieces):
        raise ValueError("user-defined pieces are not supported")
    return model


def merges_of(model: Model) -> list[tuple[str, str]]:
    """All ways to make a piece of two others, best score first."""
    score = {p: s for p, s, kind in model.pieces if kind == NORMAL}
    ways = [(-s, p, cut) for p, s in score.items() for cut in range(1, len(p)) if p[:cut] in score and p[cut:] in score]
    return [(p[:cut], p[cut:]) for _, p, cut in sorted(ways, key=lambda w: (w[0], w[2]))]


def build(model: Model):
    """The ``tokenizers.Tokenizer`` of a model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unk_id, model.byte_fallback)
    else:
        vocab = {p: k for k, (p, _, _) in enumerate(model.pieces)}
        core = models.BPE(vocab=vocab, merges=merges_of(model), unk_token=model.pieces[model.unk_id][0],
                          fuse_unk=True, byte_fallback=model.byte_fallback)
    made = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    made.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    if model.by_segments:
        made.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    made.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(),
                                      *([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else [])])
    return made


def segments(text: bytes) -> list[bytes]:
    """The segments of a text, each without its first space (every segment of a
    text with its dummy prefix begins with one)."""
    if b"  " in text or text[:1] == b" " or text[-1:] == b" ":
        return [s[1:] for s in re.findall(rb" +[^ ]+| +", b" " + text)]
    return text.split(b" ") if text else []


_BETWEEN = re.compile(rb"(?<=[^ ]) (?=[^ ])")


def parts_of(text: bytes, limit: int = SLICE_BYTES) -> Iterator[bytes]:
    """Parts of a text, cut at single spaces, whose segments are the text's.  A
    marker in the text is a space to the model."""
    text = text.replace(_MARK, b" ")
    at = 0
    while len(text) - at > limit and (cut := _BETWEEN.search(text, at + limit)):
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:] if at else text


class Memo(dict):
    """A dictionary from bytes to bytes, emptied once it holds ``most`` bytes;
    keys over ``LONGEST`` bytes stay for one batch only."""

    def __init__(self, most: int = MEMO_BYTES):
        super().__init__()
        self.most, self.held, self.long = most, 0, []

    def new_batch(self) -> None:
        if self.held > self.most:
            self.clear()
            self.held = 0
        for key in self.long:
            self.pop(key, None)
        self.long = []

    def learn(self, keys: list[bytes], values: list[bytes]) -> None:
        self.update(zip(keys, values, strict=True))
        long = [k for k in keys if len(k) > LONGEST]
        self.long += long
        self.held += (sum(map(len, keys)) + sum(map(len, values)) + ENTRY_BYTES * len(keys)
                      - sum(len(k) + len(self[k]) for k in long))


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, data: bytes, threads: int = THREADS, memo: int = MEMO_BYTES):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        self.model = parse_model(data)
        self.tokenizer, self.ids_of, self.text_of = build(self.model), Memo(memo), Memo(memo)
        # where ids may be cut: before a piece with a leading marker
        self.opens = np.array([p[:1] == MARK and t != BYTE for p, _, t in self.model.pieces])

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of every text."""
        if not self.model.by_segments:
            made = self.tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False)
            return [np.array(x.ids, dtype=np.uint32) for x in made]
        # a marker in the text is a space to the model
        texts = [t.replace(_MARK, b" ") for t in texts]
        first = np.cumsum([0, *(len(t) + bool(t) for t in texts)])
        flat = np.frombuffer(b"".join(b" " + t for t in texts if t), dtype=np.uint8)
        blank = flat == 32
        blank[1:] &= flat[:-1] != 32
        words, index, at = _stretches(flat, blank, first)
        self.ids_of.new_batch()
        new = [w for w in words if w not in self.ids_of]
        one = [w for w in new if w[1:2] not in (b"", b" ")]
        other = [w for w in new if w[1:2] in (b"", b" ")]
        self.ids_of.learn(one, self._of_rows(one))
        self.ids_of.learn(other, self._each(other))
        lone = [t.id for t in self.tokenizer.model.tokenize(MARK)]  # a space with nothing after it
        self.ids_of[b" "] = array("I", lone).tobytes()
        ids, ends = _joined(map(self.ids_of.__getitem__, words), index, at)
        return [ids[s:e].view(np.uint32) for s, e in itertools.pairwise(ends)]

    def _each(self, words: list[bytes]) -> list[bytes]:
        """The ids of every segment; the normaliser puts back its first space."""
        made = self.tokenizer.encode_batch_fast([w[1:].decode() for w in words], add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in made]

    def _of_rows(self, words: list[bytes]) -> list[bytes]:
        """The same for segments with one leading space, ``ROW`` of them in a
        text; the first piece of each, and no other, opens with a marker."""
        rows = [b"".join(words[k: k + ROW])[1:].decode() for k in range(0, len(words), ROW)]
        made = self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)
        ids = np.frombuffer(b"".join(array("I", x.ids).tobytes() for x in made), dtype=np.uint32)
        found = _cut(ids.tobytes(), np.append(4 * np.flatnonzero(self.opens[ids]), 4 * len(ids)))
        return found if len(found) == len(words) else self._each(words)  # a model without a piece for the marker alone

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The text of every id sequence, in UTF-8."""
        if not self.model.dummy_prefix:
            return [t.encode() for t in self.tokenizer.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)]
        flat = np.concatenate([np.empty(0, dtype=np.uint32), *ids]).astype(np.uint32, copy=False)
        first = np.cumsum([0, *map(len, ids)])
        runs, index, at = _stretches(flat, self.opens[flat], first)
        self.text_of.new_batch()
        new = [r for r in runs if r not in self.text_of]
        made = self.tokenizer.decode_batch([array("I", r).tolist() for r in new],
                                           skip_special_tokens=False)
        # the decoder takes the space of the leading marker off every stretch
        self.text_of.learn(new, [b" " + t.encode() for t in made])
        text, ends = _joined(map(self.text_of.__getitem__, runs), index, at)
        return [text[s + 1:e].tobytes() for s, e in itertools.pairwise(ends)]


def _stretches(flat: np.ndarray, opens: np.ndarray, first: np.ndarray) -> tuple[list[bytes], pa.Array, np.ndarray]:
    """``flat``, cut where ``opens`` says and at the places ``first`` (of the
    texts, and the end): the distinct stretches as bytes, the number of each
    stretch among them, and where the stretches of every text begin and end."""
    opens = opens.copy()
    opens[first[:-1][first[:-1] < len(flat)]] = True
    starts = np.append(np.flatnonzero(opens), len(flat))
    offsets = pa.py_buffer((starts * flat.itemsize).astype(np.int64))
    cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, offsets, pa.py_buffer(flat)])
    named = cut.dictionary_encode()
    _, places, data = named.dictionary.buffers()
    words = _cut(data.to_pybytes(), np.frombuffer(places, dtype=np.int64)[:len(named.dictionary) + 1]) if len(cut) else []
    return words, named.indices, np.searchsorted(starts, first)


def _cut(raw: bytes, places: np.ndarray) -> list[bytes]:
    return [raw[s:e] for s, e in itertools.pairwise(places.tolist())]


def _joined(values: Iterable[bytes], index: pa.Array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values numbered by ``index``, one after another, as bytes, and the
    places of those from ``at`` on."""
    taken = pa.array(values, type=pa.large_binary()).take(index)
    _, offsets, data = taken.buffers()
    # without a value there may be no buffer
    ends = np.frombuffer(offsets, dtype=np.int64)[:len(taken) + 1] if len(taken) else np.zeros(1, dtype=np.int64)
    return np.frombuffer(data or b"", dtype=np.uint8), ends[at]


_KEPT: dict[tuple[bytes, int], Codec] = {}


def codec_of(data: bytes, threads: int) -> Codec:
    """The worker's codec of a model, kept from task to task."""
    key = hashlib.sha256(data).digest(), threads
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Codec(data, threads)
    return _KEPT[key]


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _grouped(texts: list[bytes | None], limit: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """Texts in groups of about ``limit`` bytes; null as empty."""
    group, size = [], 0
    for t in texts:
        group.append(t or b"")
        size += len(group[-1])
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


FIELDS = [
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("round_trip", T.BooleanType()), T.StructField("parity", T.BooleanType()),
]


def encode_texts(docs: DataFrame, model: bytes, text_col: str = "text", keep: list[str] | None = None,
                 with_ids: bool = False, verify: bool = True, threads: int | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default) with ``n_tokens``,
    ``ids_crc32`` (ids as little-endian 32-bit), ``round_trip`` (decoding the ids
    gives the text back), ``parity`` (the sentencepiece library gives the same
    ids; null without ``verify``) and, if asked for, ``ids``.  Batches are
    encoded, decoded and verified by ``threads`` threads: as many as the cores
    Spark gives a task (``spark.task.cpus``), two at least, unless said otherwise.

    Each text is encoded whole.  Null text stays null with null results; an
    empty text has no ids.  A model that normalises texts gives ``round_trip``
    false where it changes them.  Rows are encoded each on its own; an empty
    table gives an empty table.  Input columns with the name of an output
    column are replaced.
    """
    def make() -> Callable:
        many = threads or max(THREADS, TaskContext.get().cpus())
        codec = codec_of(model, many)
        native = None
        if verify:
            import sentencepiece

            native = sentencepiece.SentencePieceProcessor(model_proto=model)

        def run(texts: list[bytes | None], _) -> dict:
            out: dict[str, list] = {f.name: [] for f in fields}
            for group in _grouped(texts):
                ids = codec.encode(group)
                out["n_tokens"] += map(len, ids)
                out["ids_crc32"] += [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
                out["round_trip"] += [x == t for x, t in zip(codec.decode(ids), group, strict=True)]
                if native is None:
                    out["parity"] += [None] * len(ids)
                else:
                    want = native.encode([t.decode() for t in group], num_threads=many)
                    out["parity"] += [x.tolist() == y for x, y in zip(ids, want, strict=True)]
                if with_ids:
                    out["ids"] += [x.astype(np.int64) for x in ids]
            return {k: [None if t is None else v for t, v in zip(texts, vs, strict=True)] for k, vs in out.items()}

        return run

    fields = FIELDS + [T.StructField("ids", T.ArrayType(T.LongType()))] * with_ids
    return map_texts(docs, make, fields, text_col, keep)


def decode_ids(rows: DataFrame, model: bytes, ids_col: str = "ids", text_col: str = "text",
               threads: int | None = None) -> DataFrame:
    """``rows`` with the text of ``ids_col`` in ``text_col``; null ids give
    null, no ids the empty text."""
    kept = [c for c in rows.columns if c != text_col]
    inner = [f"c{k}" for k in range(len(kept))]
    schema = T.StructType([T.StructField(n, rows.schema[c].dataType) for c, n in zip(kept, inner, strict=True)]
                          + [T.StructField("text", T.StringType())])
    at = f"c{kept.index(ids_col)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model, threads or max(THREADS, TaskContext.get().cpus()))
        for batch in batches:
            given = batch.column(at).to_pylist()
            texts = codec.decode([np.array(x or [], dtype=np.uint32) for x in given])
            texts = [None if x is None else t.decode() for x, t in zip(given, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in inner), pa.array(texts, type=pa.string())],
                                             names=[*inner, "text"])

    plain = rows.select(*[F.col(quoted(c)).alias(n) for c, n in zip(kept, inner, strict=True)])
    return plain.mapInArrow(run, schema).toDF(*kept, text_col)
