"""Line dedup: lines that many documents share stay in one of them only.

Plan (DataFrame operations only): explode the normalised lines of every text,
hash each key to 128 bits, count the distinct documents of every hash, and drop
the lines over the threshold by position.  Only hashes, ids and positions are
shuffled for the counts; the text itself moves once, in the join that brings
each document its list of dropped positions.  The counts combine on the map
side, so a line that a third of all documents share is no hot group; the two
joins are inner and left joins whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, quoted, settled

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Second hash of a key: the same function after another leading value.
_SECOND = 7


def lower_ascii(c: Column) -> Column:
    """``c`` with A-Z lower-cased and nothing else changed.  ``lower`` does
    that, and fast, where all characters are ASCII."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, _UPPER, _UPPER.lower())
    )


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
) -> DataFrame:
    """All columns of ``docs``, the text without its dropped lines, and
    ``n_lines`` (before dropping) and ``n_dropped`` (both long).

    A line's key is the line with blanks stripped at both ends and A-Z
    lower-cased.  Keys of at least ``min_chars`` code points that occur in at
    least ``min_docs`` documents lose all their lines except in the largest id
    holding them (there every occurrence stays).

    Null or empty text: one empty line, and the text becomes "".  Rows with
    the same id are one document when documents are counted, and each row
    keeps its own text.  Null ids together are one document, smaller than any
    other.  An empty table gives an empty table.  Input columns named
    ``n_lines`` or ``n_dropped`` are replaced.
    """
    rest = [c for c in docs.columns if c not in (id_col, text_col, "n_lines", "n_dropped")]
    whole = docs.select(
        F.col(quoted(id_col)).alias("__id"),
        F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("__text"),
        *[F.col(quoted(c)) for c in rest],
    )
    # A row's positions hold for all rows with its id and text.
    which = F.xxhash64("__text").alias("__which")
    lines = (
        whole.select("__id", which, F.posexplode(F.split("__text", "\n", -1)).alias("__pos", "__line"))
        .select("__id", "__which", "__pos", line_key(F.col("__line")).alias("__key"))
        .filter(F.char_length("__key") >= min_chars)
        .select("__id", "__which", "__pos", F.xxhash64("__key").alias("__h"),
                F.xxhash64(F.lit(_SECOND), "__key").alias("__g"))
    )
    held = lines.select("__h", "__g", "__id").distinct()
    # Written down: the join below then exchanges both its sides anew, so that
    # adaptive execution can split the rows of a line that is everywhere.
    shared = settled(
        held.groupBy("__h", "__g")
        .agg(F.count(F.lit(1)).alias("__n"), F.max("__id").alias("__keeper"))
        .filter(F.col("__n") >= min_docs)
        .drop("__n")
    )
    drops = (
        lines.join(shared, ["__h", "__g"])
        .filter(~F.col("__id").eqNullSafe(F.col("__keeper")))
        .groupBy(F.col("__id").alias("__did"), F.col("__which").alias("__dwhich"))
        .agg(F.collect_set("__pos").alias("__drop"))
    )
    joined = whole.withColumn("__which", which).join(
        drops, F.col("__id").eqNullSafe(F.col("__did")) & (F.col("__which") == F.col("__dwhich")), "left"
    )
    parts = joined.withColumn("__lines", F.split("__text", "\n", -1))
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__drop"))
    kept = F.when(F.col("__drop").isNull(), F.col("__text")).otherwise(
        F.array_join(F.transform(stay, lambda p: F.get(F.col("__lines"), p)), "\n")
    )
    made = {id_col: F.col("__id"), text_col: kept}
    return parts.select(
        *[(made[c] if c in made else F.col(quoted(c))).alias(c) for c in docs.columns if c in made or c in rest],
        F.size("__lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("__drop"), F.lit(0)).cast("long").alias("n_dropped"),
    )
