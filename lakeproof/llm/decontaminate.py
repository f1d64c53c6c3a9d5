"""Operator 6: benchmark decontamination by a distributed positional index.

DataFrame functions only. The index holds postings (term, document, position)
of training tokens. Each benchmark window looks for its rarest term first: its
postings, moved by the term's offset, are the window's possible starts; the
list of the second rarest term, moved likewise, is intersected with them. The
few starts left are compared word by word, which settles the match exactly.

Only terms that some window has among its two rarest are posted, so the index
is small beside the corpus however common the benchmark's other words are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeproof.llm.common import load, materialise, merged, only
from lakeproof.llm.words import ascii_lower, small, word_list, word_places

WINDOW = 10


def benchmark_windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """item_id, window_no, words: every run of ``width`` words of an item; an
    item of fewer words, but not none, is one window."""
    items = only(benchmark, "item_id", "text").select(
        "item_id", F.transform(word_list(F.col("text")), ascii_lower).alias("w")).where("size(w) > 0")
    return items.select(
        "item_id", F.posexplode(F.expr(
            f"transform(sequence(1, greatest(size(w) - {width - 1}, 1)), i -> slice(w, i, {width}))"))
        .alias("window_no", "words"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The positional index: doc_id, pos, word of every place of a term."""
    return word_places(docs, "doc_id").join(terms, "word").select("doc_id", "pos", "word")


def rarest_terms(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """windows with word1, off1 and word2, off2: the two terms of the window
    that are rarest in the corpus, and where they first stand in it. A window
    of one term has it twice."""
    vocabulary = materialise(merged(windows.select(F.explode("words").alias("word")).distinct()), "vocabulary")
    counts = word_places(docs, "doc_id").join(small(vocabulary, "word"), "word").groupBy("word").agg(
        F.count("*").alias("n"))
    placed = (windows.select("item_id", "window_no", "words", F.posexplode("words").alias("off", "word"))
              .join(materialise(merged(counts), "term-counts"), "word", "left")
              .groupBy("item_id", "window_no", "words", "word")
              .agg(F.min("off").alias("off"), F.first("n").alias("n")))
    ranked = placed.withColumn("r", F.row_number().over(
        Window.partitionBy("item_id", "window_no", "words").orderBy(F.coalesce("n", F.lit(0)), "word")))
    return (ranked.where("r <= 2").groupBy("item_id", "window_no", "words")
            .agg(F.min_by("word", "r").alias("word1"), F.min_by("off", "r").alias("off1"),
                 F.max_by("word", "r").alias("word2"), F.max_by("off", "r").alias("off2")))


def rows_of(docs: DataFrame) -> DataFrame:
    """``docs``, written once with ``__row``, a number of each row's own. Lists
    are kept by it, so a null or repeated doc_id is like any other."""
    return materialise(merged(docs.withColumn("__row", F.monotonically_increasing_id()), 2), "decontamination-texts")


def indexed(docs: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``windows`` with their two rarest terms, and the postings of these."""
    windows = materialise(merged(rarest_terms(windows, docs)), "windows")
    terms = windows.select(F.explode(F.array("word1", "word2")).alias("word")).distinct()
    return windows, materialise(merged(postings(docs, small(terms, "word")), 2), "postings")


def window_starts(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """doc_id, start, item_id, words: places where a window's two rarest terms
    stand as the window has them. ``doc_id`` has to be unique."""
    windows, index = indexed(docs, windows)
    first = (index.join(small(windows.withColumnRenamed("word1", "word")
                              .withColumn("__bytes", F.concat_ws(" ", "words")), "__bytes"), "word")
             .select("doc_id", (F.col("pos") - F.col("off1")).alias("start"), "item_id", "words", "word2", "off2")
             .where("start >= 0"))
    second = index.select(F.col("doc_id").alias("doc2"), F.col("pos").alias("pos2"), F.col("word").alias("word3"))
    return (first.withColumn("at2", F.col("start") + F.col("off2"))
            .join(second, (F.col("doc_id") == F.col("doc2")) & (F.col("at2") == F.col("pos2"))
                  & (F.col("word2") == F.col("word3")))
            .select("doc_id", "start", "item_id", "words").distinct())


def decontaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256, contaminated.

    Null and empty texts have no words and no hits. Rows that share a doc_id
    are each compared with their own text, as are rows without one. An empty
    benchmark hits nothing; repeated items count once per item_id.
    """
    docs = rows_of(docs)
    starts = window_starts(docs.select(F.col("__row").alias("doc_id"), "text"), benchmark_windows(benchmark, width))
    found = starts.groupBy(F.col("doc_id").alias("__doc")).agg(
        F.collect_list(F.struct("start", "item_id", "words")).alias("__found"))
    joined = docs.join(found, F.col("__row") == F.col("__doc"), "left")
    words = F.transform(word_list(F.col("text")), ascii_lower)
    sized = joined.withColumn("n_words", F.size(word_list(F.col("text"))).cast("long"))
    true = (F.when(F.col("__found").isNotNull(), F.filter(
        "__found", lambda c: F.slice(F.col("__words"), c["start"] + 1, F.size(c["words"])) == c["words"]))
        .otherwise(F.array().cast(found.schema["__found"].dataType)))
    out = (sized.withColumn("__words", F.when(F.col("__found").isNotNull(), words)).withColumn("__true", true)
           .withColumn("n_hit", F.size(F.array_distinct(F.flatten(F.transform(
               "__true", lambda c: F.sequence(c["start"], c["start"] + F.size(c["words"]) - 1))))).cast("long"))
           .withColumn("__items", F.array_sort(F.array_distinct(F.transform(
               "__true", lambda c: c["item_id"].cast("string")))))
           .withColumn("n_items", F.size("__items").cast("long"))
           .withColumn("items_sha256", F.sha2(F.array_join("__items", ","), 256))
           .withColumn("contaminated", F.col("n_hit") > 0))
    return out.drop("__row", "__doc", "__found", "__words", "__true", "__items")


def proximity_matches(index: DataFrame, pairs: DataFrame, distance: int) -> DataFrame:
    """doc_id, left, right, pos_left, pos_right: places of two terms of
    ``pairs`` (left, right) at most ``distance`` words apart, in any order.
    Positions meet by buckets of ``distance`` words and their neighbours, so
    that a list is never combined with a whole other list."""
    bucket = F.floor(F.col("pos") / F.lit(distance))
    left = (index.join(small(pairs, "left", "right"), F.col("word") == F.col("left"))
            .select("doc_id", "left", "right", F.col("pos").alias("pos_left"),
                    F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("bucket")))
    right = index.select("doc_id", F.col("word").alias("right"), F.col("pos").alias("pos_right"), bucket.alias("bucket"))
    return (left.join(right, ["doc_id", "right", "bucket"])
            .where((F.abs(F.col("pos_left") - F.col("pos_right")) <= distance)
                   & (F.col("pos_left") != F.col("pos_right")))
            .select("doc_id", "left", "right", "pos_left", "pos_right"))


def near_matches(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, distance: int = WINDOW) -> DataFrame:
    """doc_id, item_id, n_windows: per row of ``docs`` and item the windows
    whose two rarest terms stand at most ``distance`` words apart, in any
    order; a passage with words put in or moved shows here. Pairs without a
    match give no row, nor do windows of one term. Nulls as in ``decontaminated``."""
    rows = rows_of(only(docs, "doc_id", "text"))
    windows, index = indexed(rows.select(F.col("__row").alias("doc_id"), "text"), benchmark_windows(benchmark, width))
    windows = windows.where("word1 <> word2")
    pairs = windows.select(F.col("word1").alias("left"), F.col("word2").alias("right")).distinct()
    near = proximity_matches(index, pairs, distance).select("doc_id", "left", "right").distinct()
    per_item = windows.select(F.col("word1").alias("left"), F.col("word2").alias("right"), "item_id", "words").distinct()
    found = (near.join(per_item, ["left", "right"]).groupBy(F.col("doc_id").alias("__row"), "item_id")
             .agg(F.count(F.lit(1)).alias("n_windows")))
    return rows.join(found, "__row").select("doc_id", "item_id", "n_windows")


def op6_positional_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of all benchmark items in all documents."""
    docs = only(load(spark, sf_dir, "documents"), "doc_id", "text")
    return decontaminated(docs, load(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, i, i + least(len(w), 10) - 1) AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM w, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
             string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
      FROM h GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(p.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.items, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""
