"""Token counts of a unigram tokenizer without making the tokens.

For every distinct segment of the texts (see ``sentencepiece_codec``) an
Aho-Corasick automaton enumerates all pieces of the vocabulary that occur in it,
and a Viterbi pass over the ends of these matches carries the best score and its
number of tokens only.  Rules of the tokenizer that decide ties are kept: of
equal scores the earliest start wins (a match replaces another only if it is
strictly better, in the order of the starts); a character without a piece of its
own can be an unknown, at 10 below the worst score; neighbouring unknowns are one
token, or with byte fallback one token per UTF-8 byte.

Segments repeat, so a worker remembers their counts; a document's count is the
sum.  One pass over the partitions, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_texts
from .sentencepiece_codec import BYTE, ENTRY_BYTES, LONGEST, MARK, Model, parse_model, parts_of, segments

#: Bytes of segments whose counts a worker remembers; longer ones than LONGEST are not.
MEMO_BYTES = 160 << 20
_UNK_PENALTY = 10.0


class Counter:
    """Best score and number of tokens of a segment."""

    def __init__(self, model: Model):
        import ahocorasick

        self.find = ahocorasick.Automaton()
        known = {p for p, _, kind in model.pieces if kind == BYTE}
        self.bytes_too = model.byte_fallback and len(known) == 256
        # control, unknown and byte pieces are text to the search as in the tokenizer: by their string
        for p, score, _ in model.pieces:
            if p:
                self.find.add_word(p, (len(p), score))
        self.find.make_automaton()
        self.ring = max([len(p) for p, _, _ in model.pieces] + [1]) + 2
        self.unknown = min(s for _, s, _ in model.pieces) - _UNK_PENALTY

    def __call__(self, text: str) -> tuple[float, int]:
        n, ring = len(text), self.ring
        # what is known of an end stands at its number modulo the ring, which is
        # two longer than the longest piece, so that no match looks back further
        best: list[float | None] = [0.0, *[None] * (ring - 1)]
        count = [0] * ring
        # whether the best path to an end closes with an unknown
        closed = bytearray(ring)
        single = bytearray(ring)
        done = 0  # ends up to here are final

        def finish(last: int) -> None:
            """Offer the unknown character, the latest start, to the ends up to
            ``last``, and clear the place of the end after each."""
            for end in range(done + 1, last + 1):
                at, before, after = end % ring, (end - 1) % ring, (end + 1) % ring
                if not single[at]:
                    total = best[before] + self.unknown
                    if best[at] is None or total > best[at]:
                        if self.bytes_too:
                            more = len(text[end - 1].encode())
                        else:
                            more = 0 if closed[before] else 1
                        best[at], count[at], closed[at] = total, count[before] + more, 1
                best[after], closed[after], single[after] = None, 0, 0

        # matches come by their ends, those of one end by ascending starts
        for at, (size, score) in self.find.iter(text):
            if at > done:
                finish(at)
                done = at
            end, start = (at + 1) % ring, (at + 1 - size) % ring
            total = best[start] + score
            if best[end] is None or total > best[end]:
                best[end], count[end] = total, count[start] + 1
            if size == 1:
                single[end] = 1
        finish(n)
        return best[n % ring], count[n % ring]


def token_counts(docs: DataFrame, model: bytes, text_col: str = "text", keep: list[str] | None = None,
                 memo: int = MEMO_BYTES) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default) with ``n_tokens`` (long) and
    ``score`` (double, the best path's) under the pieces and scores of a
    sentencepiece model file, taken as a unigram vocabulary.

    The model must mark words in front and not normalise otherwise.  Null text
    has null counts; an empty text 0 tokens and score 0.  Texts of any length
    are counted whole.  Rows are counted each on its own; an empty table gives
    an empty table.  Input columns with the name of an output column are
    replaced.
    """
    if not parse_model(model).by_segments:
        raise ValueError("the model's texts cannot be counted by segments")

    def make() -> Callable:
        counter = Counter(parse_model(model))
        seen: dict[bytes, tuple[float, int]] = {}
        held = 0

        def count(raw: bytes | None) -> tuple[float | None, int | None]:
            nonlocal held
            if raw is None:
                return None, None
            score, n = 0.0, 0
            for part in parts_of(raw):
                words = segments(part)
                if held > memo:
                    seen.clear()
                    held = 0
                for s in (new := set(words).difference(seen)):
                    seen[s] = counter((MARK + s.decode()).replace(" ", MARK))
                    held += len(s) + ENTRY_BYTES
                got = list(map(seen.__getitem__, words))
                for s in new:
                    if len(s) > LONGEST:
                        del seen[s]
                        held -= len(s) + ENTRY_BYTES
                score += sum(g[0] for g in got)
                n += sum(g[1] for g in got)
            return score, n

        def run(texts: list[bytes | None], _) -> dict:
            got = list(map(count, texts))
            return {"n_tokens": [n for _, n in got], "score": [s for s, _ in got]}

        return run

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())]
    return map_texts(docs, make, fields, text_col, keep)
