"""Quality rules: a base rule on counts, then a log-likelihood ratio.

The ratio compares two multinomials over hashed n-grams (words and pairs of
neighbouring words, one bucket each): the trusted target, fitted on all rows
labelled good, and the raw corpus, counted over all documents.  A
document's score is the mean of log p_target - log p_raw over its n-grams; it
is kept from a threshold on that the trusted documents give themselves: each
half of them is scored under a model fitted on the other half, and the
threshold is a low quantile of these held-out scores.  A mean over few n-grams
strays further, so the distance from the held-out mean is taken times the root
of the n-grams, up to ``FULL`` of them.  The threshold tightens as counts grow,
and the same text always gets the same verdict under the same model.

Three passes over the texts: the first counts the buckets per task (one row per
bucket and task is shuffled), the second scores every document under the models
of both halves, which gives the threshold from the scores of the trusted ones, and
the third judges.  Trusted ids are joined, so any number of them can be
named: the first pass shuffles ids and texts once, the second one row of numbers for
a document.  The model is three arrays of ``buckets`` numbers, whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keys import allocate_keys
from .common import BLANKS, map_texts, quoted, settled, slices, texts_of

BUCKETS = 1 << 13
#: The loosest threshold: used as it is where fewer than ``MIN_HELD`` trusted
#: documents pass the base rule.
THRESHOLD = -0.2
MIN_HELD = 100
#: Share of the held-out trusted documents that may score below the threshold
#: (with under 1 / QUANTILE of them: none).
QUANTILE = 0.0002
#: N-grams from which on a score's distance is no longer a matter of length.
FULL = 200
_STEPS = 10_000  # steps of a score of one, for the quantile
#: The target is mixed with the raw distribution as if that were this share of
#: its own size, so a bucket that a small target lacks counts little.
MIX = 0.25
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
_SYMBOLS = "#*$%&|<>"

_PAIR_A = np.uint64(0x9E3779B97F4A7C15)
_PAIR_B = np.uint64(0xC2B2AE3D27D4EB4F)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word, in order."""
    from xxhash import xxh3_64_intdigest

    parts = [np.array(list(map(xxh3_64_intdigest, p.split())), dtype=np.uint64) for p in slices(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def ngram_buckets(h: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of every word and of every pair of neighbouring words."""
    pairs = (h[:-1] * _PAIR_A) ^ (h[1:] * _PAIR_B)
    pairs ^= pairs >> np.uint64(29)
    return np.concatenate((h, pairs * _PAIR_A >> np.uint64(7))) % np.uint64(buckets)


def repeat_words(h: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more."""
    n = len(h) - window + 1
    if n < 2:
        return 0
    mix = np.zeros(n, dtype=np.uint64)
    for k in range(window):
        mix = (mix ^ h[k: k + n]) * _PAIR_A
        mix ^= mix >> np.uint64(31)
    order = np.sort(mix)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.nonzero(np.isin(mix, twice))[0]
    cover = np.zeros(len(h) + 1, dtype=np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def text_counts(text: str) -> tuple[int, int, int]:
    """word_chars, n_symbols, n_dup_lines."""
    blanks = sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, _SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)] if "\n" in text else []
    return len(text) - blanks, symbols, len(lines) - len(set(lines))


def dealt(trusted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, half)``: every id of ``trusted`` once, dealt to the halves 0 and 1
    in turn (by the hash of the id, so the order of the table does not count)."""
    ids = trusted.filter(F.col(quoted(id_col)).isNotNull()).select(F.col(quoted(id_col)).alias("id")).distinct()
    keyed = allocate_keys(ids.withColumn("h", F.xxhash64("id")), ["h", "id"], "at")
    return keyed.select("id", ((F.col("at") - 1) % 2).cast("int").alias("half"))


def trusted_halves(trusted: DataFrame, id_col: str = "doc_id") -> tuple[frozenset, frozenset]:
    """The ids of each half as sets, for a look at small tables; the operator
    joins ``dealt`` instead."""
    rows = dealt(trusted, id_col).collect()
    return frozenset(r["id"] for r in rows if not r["half"]), frozenset(r["id"] for r in rows if r["half"])


def ngram_counts(docs: DataFrame, halves: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n_raw, n_first, n_second)``: n-gram counts over all documents
    and over the documents of each half of the trusted ids (``dealt``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, first, second = (np.zeros(buckets, dtype=np.int64) for _ in range(3))
        for batch in batches:
            for half, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                if text:
                    n = np.bincount(ngram_buckets(word_hashes(text), buckets).astype(np.int64), minlength=buckets)
                    raw += n
                    if half == 0:
                        first += n
                    elif half == 1:
                        second += n
        some = np.nonzero(raw)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), *(pa.array(x[some]) for x in (raw, first, second))],
            names=["bucket", "n_raw", "n_first", "n_second"])

    known = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    # one plan at any size: no broadcast of the ids, no sort of the texts
    counts = known.join(halves.hint("shuffle_hash"), "id", "left").select("half", "text").mapInArrow(
        run, "bucket int, n_raw long, n_first long, n_second long")
    return counts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("n_raw", "n_first", "n_second")])


def log_ratios(raw: np.ndarray, target: np.ndarray, mix: float = MIX) -> np.ndarray:
    """log p_target - log p_raw of every bucket.  All zero where there is no
    trusted text."""
    buckets = len(raw)
    if not target.sum():
        return np.zeros(buckets)
    p_raw = (raw + 0.5) / (raw.sum() + 0.5 * buckets)
    weight = mix * target.sum()
    return np.log((target + weight * p_raw) / (target.sum() + weight)) - np.log(p_raw)


def base_fails(n_words: int, n_repeated: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeated > MAX_REPEAT_PERCENT * n_words


def held_out_threshold(docs: DataFrame, halves: DataFrame | tuple[frozenset, frozenset], models: tuple[np.ndarray, np.ndarray],
                       id_col: str = "doc_id", text_col: str = "text", loosest: float = THRESHOLD,
                       quantile: float = QUANTILE) -> np.ndarray:
    """The threshold of texts with 0, 1, ..., ``FULL`` (and more) n-grams, none
    below ``loosest``, from the trusted documents that pass the base rule;
    ``models``: for each half, the one fitted on the other half.  ``halves``:
    ``dealt``, or two small sets of ids."""
    fixed = np.full(FULL + 1, loosest)
    known = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    if not isinstance(halves, DataFrame):
        kind = T.StructType([known.schema["id"], T.StructField("half", T.IntegerType())])
        halves = docs.sparkSession.createDataFrame([(i, k) for k, ids in enumerate(halves) for i in sorted(ids)], kind)
    both = np.stack(models, axis=1)

    def make():
        def score(text: bytes | None) -> tuple:
            h = word_hashes(text) if text else np.empty(0, dtype=np.uint64)
            if base_fails(len(h), repeat_words(h)):
                return None, None, None
            grams = ngram_buckets(h, len(both))
            return min(len(grams), FULL), *map(int, np.floor(both[grams].mean(axis=0) * _STEPS))

        def run(texts: list[bytes | None], _) -> dict:
            return dict(zip(("grams", "first", "second"), zip(*map(score, texts), strict=True), strict=True))

        return run

    # scored before the join: a row of numbers is shuffled for a document, not its text
    fields = [T.StructField(c, T.LongType()) for c in ("grams", "first", "second")]
    scored = map_texts(known.filter("id IS NOT NULL"), make, fields, keep=["id"]).filter("grams IS NOT NULL")
    at = F.when(F.col("half") == 0, F.col("first")).otherwise(F.col("second")).alias("at")
    scores = settled(scored.join(halves, "id").groupBy("grams", at).agg(F.count(F.lit(1)).alias("n")))
    total, points = scores.agg(F.sum("n"), F.sum(F.col("at") * F.col("n"))).first()
    if not total or total < MIN_HELD:
        return fixed
    mean = points / total / _STEPS
    # every row counts one document at least, so these reach over the quantile
    lowest = scores.orderBy((F.col("at") / _STEPS - mean) * F.sqrt("grams")).limit(int(quantile * total) + 1)
    below = 0
    for away, n in sorted(((r["at"] / _STEPS - mean) * r["grams"] ** 0.5, r["n"]) for r in lowest.collect()):
        below += n
        if below > quantile * total:
            break
    return np.maximum(mean + away / np.sqrt(np.maximum(np.arange(FULL + 1), 1)), loosest)


FIELDS = [
    *(T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("llr", T.DoubleType()),
    T.StructField("kept", T.BooleanType()),
]


def quality_rules(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  keep: list[str] | None = None, threshold: float | None = None,
                  buckets: int = BUCKETS) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default) with the base counts, the
    length-normalised log-likelihood ratio ``llr`` and the verdict ``kept``.

    Words are runs of other characters than blanks (space, U+0009 to U+000D).
    ``base_failed``: fewer than 20 words, or over 30 % of the words lie in
    windows of 8 words that the text repeats.  ``kept``: the base rule passed
    and ``llr >= threshold``; without a given threshold that of
    ``held_out_threshold`` for the number of its n-grams is taken.

    ``trusted`` names good documents by id; all of them are used.  Without
    any, every ``llr`` is 0.  Null text has no words (all counts 0,
    base_failed, llr 0).  Rows with equal ids are judged one by one and all
    count.  An empty table gives an empty table.  Input columns with the name
    of an output column are replaced.
    """
    halves = dealt(trusted, id_col)
    raw, first, second = np.zeros((3, buckets))
    for r in ngram_counts(docs, halves, id_col, text_col, buckets).collect():  # at most ``buckets`` rows
        raw[r["bucket"]], first[r["bucket"]], second[r["bucket"]] = r["n_raw"], r["n_first"], r["n_second"]
    model = log_ratios(raw, first + second)
    if threshold is None:
        least = held_out_threshold(docs, halves, (log_ratios(raw, second), log_ratios(raw, first)), id_col, text_col)
    else:
        least = np.full(FULL + 1, threshold)

    def judge(text: bytes | None) -> tuple:
        h = word_hashes(text) if text else np.empty(0, dtype=np.uint64)
        counts = text_counts(text.decode()) if text else (0, 0, 0)
        n, repeated = len(h), repeat_words(h)
        failed = base_fails(n, repeated)
        grams = ngram_buckets(h, buckets)
        llr = float(model[grams].mean()) if n else 0.0
        return n, *counts, repeated, failed, llr, bool(not failed and llr >= least[min(len(grams), FULL)])

    def make():
        def run(texts: list[bytes | None], _) -> dict:
            rows = [judge(t) for t in texts]
            return {f.name: [r[k] for r in rows] for k, f in enumerate(FIELDS)}

        return run

    return map_texts(docs, make, FIELDS, text_col, keep)


def trusted_rows_of(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Ids that the labels call good and not toxic."""
    return labels.filter("quality = 1 AND toxic = 0").select(quoted(id_col))
