"""Words of texts with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a longest run of ASCII letters, digits and non-ASCII characters.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BROADCAST_BYTES = 16 << 20


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is; ``lower`` does the same to ASCII
    text and is much quicker."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_list(text: Column) -> Column:
    """The words of a text in order, as they are written; null: none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BREAK, -1), lambda w: w != F.lit(""))


def word_places(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key``, pos (from 0) and word (ASCII lower case) of every word. The
    text is split once per row, and the words stream out of the generator."""
    parts = docs.select(key, F.when(F.col(text).rlike("^" + BREAK), 1).otherwise(0).alias("__lead"),
                        F.posexplode(F.split(F.col(text), BREAK, -1)).alias("__pos", "__word"))
    return (parts.where("__word <> ''")
            .select(key, (F.col("__pos") - F.col("__lead")).alias("pos"), ascii_lower(F.col("__word")).alias("word")))


def small(df: DataFrame, *text: str) -> DataFrame:
    """``df`` marked for broadcast if its rows and the bytes of its ``text``
    columns are counted and small; otherwise unmarked, for a shuffled join."""
    size = F.lit(0).cast("long")
    for c in text:
        size = size + F.coalesce(F.sum(F.octet_length(c)), F.lit(0))
    n = df.agg((F.count(F.lit(1)) * 48 + size).alias("n")).first()["n"]
    return F.broadcast(df) if n <= BROADCAST_BYTES else df
