"""Pairs of time spans that overlap, by bins of their own size.

Bins of one width either cut long spans into very many pieces or put far too
many short ones into one bin. Here a span's level is chosen so that a bin
there is longer than the span, which then touches two bins at most. A pair
meets at the level of its longer span: that one stands in its own bins alone,
the shorter one in its (at most two) bins of every level the other side uses.
So two short spans never meet in a wide bin, and every bin a pair meets in is
at most twice as wide as its longer span or the smallest width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LEVEL, _BIN, _FROM, _TO = "__level", "__bin", "__from", "__to"


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def _spans(df: DataFrame, span: tuple[str, str], base: int) -> DataFrame:
    """``df`` with its spans in microseconds and their level; the rest is left out."""
    start, end = _micros(span[0]), _micros(span[1])
    length = F.expr(f"({_TO} - {_FROM}) div {base}")
    return (df.withColumn(_FROM, start).withColumn(_TO, end).where(F.col(_TO) >= F.col(_FROM))
            .withColumn("__own", F.when(length == 0, 0).otherwise(F.length(F.bin(length)))))


def _levels(spans: DataFrame) -> list[int]:
    """The levels in use: under 64, as a length has as many bits."""
    return sorted(r[0] for r in spans.select("__own").distinct().collect())


def _in_bins(spans: DataFrame, levels: Column, base: int) -> DataFrame:
    at = spans.withColumn(_LEVEL, F.explode(levels))
    return at.withColumn(_BIN, F.explode(F.expr(
        f"sequence(floor({_FROM} / shiftleft({base}L, {_LEVEL})), floor({_TO} / shiftleft({base}L, {_LEVEL})))")))


def overlaps(left: DataFrame, right: DataFrame, key: str, left_span: tuple[str, str], right_span: tuple[str, str],
             bin_seconds: int = 3600) -> DataFrame:
    """Every pair of a row of ``left`` and one of ``right`` of the same ``key``
    whose spans (start, end; both belong to the span) share an instant, once,
    with all columns of both and ``overlap_seconds``.

    Spans without a start or an end, or that end before they start, take no
    part, nor do null keys. Equal rows give a pair each. Only equi-joins on
    (key, level, bin), so a hot key is dealt by time and split by AQE.
    """
    clash = sorted((set(left.columns) & set(right.columns)) - {key})
    if clash or "overlap_seconds" in {*left.columns, *right.columns}:
        raise ValueError(f"columns of both sides, or named like the result's: {clash or ['overlap_seconds']}")
    base = bin_seconds * 1_000_000
    a, b = _spans(left, left_span, base), _spans(right, right_span, base)

    def upward(levels: list[int], also_own: bool) -> Column:
        used = F.array(*[F.lit(i) for i in levels]).cast("array<int>")
        return F.filter(used, lambda i: (i >= F.col("__own")) if also_own else (i > F.col("__own")))

    own = F.array("__own")
    outer = [c for c in left.columns] + [c for c in right.columns if c != key]

    def meet(x: DataFrame, y: DataFrame) -> DataFrame:
        renamed = y.select(F.col(key).alias("__key"), *[c for c in right.columns if c != key], F.col(_LEVEL).alias("__l2"),
                           F.col(_BIN).alias("__b2"), F.col(_FROM).alias("__from2"), F.col(_TO).alias("__to2"))
        first, last = F.greatest(_FROM, "__from2"), F.least(_TO, "__to2")
        here = F.expr(f"floor(greatest({_FROM}, __from2) / shiftleft({base}L, {_LEVEL}))")
        return (x.join(renamed, (F.col(key) == F.col("__key")) & (F.col(_LEVEL) == F.col("__l2"))
                       & (F.col(_BIN) == F.col("__b2")))
                .where((first <= last) & (here == F.col(_BIN)))  # a pair counts in the bin where its overlap starts
                .select(*outer, ((last - first) / 1_000_000).alias("overlap_seconds")))

    longer_left = meet(_in_bins(a, own, base), _in_bins(b, upward(_levels(a), True), base))
    longer_right = meet(_in_bins(a, upward(_levels(b), False), base), _in_bins(b, own, base))
    return longer_left.unionByName(longer_right)
