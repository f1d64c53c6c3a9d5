r"""Operator 9: personal data by information-theoretic sanitisation.

DataFrame functions only. Base spans (addresses, IPs, card and phone numbers)
are found by pattern; each distinct value is a protected entity. Over the
whole corpus, co-occurrence of terms with mentions of an entity tells how much
a term, wherever it stands in a document, gives away: the pointwise mutual information
``log2(N * n(e, t) / (n(e) * n(t)))`` in bits, as a share of the entity's own
information ``log2(N / n(e))``, and the chance ``n(e, t) / n(t)`` that a
document with the term names the entity. Terms that reach both thresholds,
seen with the entity in enough different texts, are generalised in the
documents that name it. The share is 1 for a term that never stands without
the entity, however common the entity or small the corpus; an entity that all
documents name has no information to give away.

Patterns are written so that Java matches them without recursion or
rescanning (possessive groups; a match starts where the last one ended or at
the start of a run), and find what the plain forms find:
email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``,
ip ``[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)``, card ``[0-9]([\x20-]?[0-9])+``,
phone ``\+[0-9][\x20().0-9-]+[0-9]``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.llm.common import load, materialise, merged, only
from lakeproof.llm.words import BREAK, WORD, ascii_lower, small

KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a search of the kind to be worth while.
HINT = {"email": "@", "ip": ".", "card": None, "phone": "+"}
ORDER = {**{k: i for i, k in enumerate(KINDS)}, "term": len(KINDS)}

MIN_TEXTS, MIN_SHARE, MIN_CHANCE = 3, 0.5, 0.5
CHUNK = 256

SPAN = "struct<start:int,kind_no:int,end:int,kind:string,value:string>"


def _sql(text: str) -> str:
    return "r'" + text + "'"


def located(text: str, pattern: str) -> str:
    """SQL for an array of (start, end, value) of a pattern's matches in code
    points. Matches and the parts between them alternate, so places are sums
    of lengths; they are summed in chunks, then chunk by chunk, to stay near
    linear in the number of matches."""
    p = _sql(pattern)
    return f"""
    transform(array(struct(regexp_extract_all({text}, {p}, 0) AS m, split({text}, {p}, -1) AS s)), z ->
      transform(array(transform(sequence(0, cast((size(z.m) - 1) / {CHUNK} AS int)), c ->
          aggregate(slice(arrays_zip(z.m, z.s), c * {CHUNK} + 1, least({CHUNK}, size(z.m) - c * {CHUNK})),
            struct(0 AS at, cast(array() AS array<struct<start:int,end:int,value:string>>) AS a),
            (acc, x) -> struct(acc.at + length(x.s) + length(x.m) AS at,
              concat(acc.a, array(struct(acc.at + length(x.s) AS start, acc.at + length(x.s) + length(x.m) AS end,
                                         x.m AS value))) AS a)))), cs ->
        aggregate(cs, struct(0 AS at, cast(array() AS array<array<struct<start:int,end:int,value:string>>>) AS a),
          (acc, c) -> struct(acc.at + c.at AS at, concat(acc.a, array(transform(c.a, x ->
              struct(acc.at + x.start AS start, acc.at + x.end AS end, x.value AS value)))) AS a),
          acc -> flatten(acc.a)))[0])[0]"""


def _luhn(digits: str) -> str:
    """Digits from the right, every second doubled, sum divisible by ten."""
    return (f"aggregate(transform(split(reverse({digits}), ''), (d, i) -> if(i % 2 = 0, cast(d AS int), "
            "cast(d AS int) * 2 - if(cast(d AS int) > 4, 9, 0))), 0, (a, d) -> a + d) % 10 = 0")


def _valid(kind: str, v: str) -> str:
    digits = f"regexp_replace({v}, '[^0-9]', '')"
    if kind == "ip":
        return f"forall(split({v}, '[.]'), p -> p RLIKE '^0*([0-9]{{1,2}}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$')"
    if kind == "card":
        return f"if(length({digits}) BETWEEN 12 AND 19, {_luhn(digits)}, false)"
    if kind == "phone":
        return f"length({digits}) BETWEEN 9 AND 15"
    return "true"


def base_spans(text: str) -> Column:
    """All base spans of ``text`` (not null), sorted by start, then kind."""
    parts = []
    for kind, pattern in KINDS.items():
        hint = HINT[kind]
        here = f"contains({text}, '{hint}') AND " if hint else ""
        found = (f"transform(filter({located(text, pattern)}, x -> {_valid(kind, 'x.value')}), x -> "
                 f"struct(x.start AS start, {ORDER[kind]} AS kind_no, x.end AS end, '{kind}' AS kind, x.value AS value))")
        # one quick search spares most texts the two that place the matches
        parts.append(f"if({here}{text} RLIKE {_sql(pattern)}, {found}, cast(array() AS array<{SPAN}>))")
    return F.expr(f"array_sort(concat({', '.join(parts)}))")


def listed(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')")


def _named(spans: str = "spans") -> Column:
    """The distinct entities of base spans."""
    return F.array_distinct(F.transform(spans, lambda s: F.lower(s["value"])))


def disclosing_terms(named: DataFrame, docs: DataFrame, min_texts: int = MIN_TEXTS, min_share: float = MIN_SHARE,
                     min_chance: float = MIN_CHANCE) -> DataFrame:
    """id (SHA-256 of a text), words: the terms in the text that give away an
    entity the text names.

    ``named``: text and spans of the documents with base spans. Copies of a
    text weigh as documents in n(e), n(t) and n(e, t), but are one text for
    ``min_texts``. All words of a text are counted with all of its entities;
    entities and words that can't reach a threshold with any partner are taken
    out before they are paired, which changes no result.
    """
    texts = materialise(merged(
        named.groupBy(F.xxhash64("text").alias("h"), F.sha2("text", 256).alias("id"))
        .agg(F.count("*").alias("copies"), F.first("text").alias("text"), F.first("spans").alias("spans"))
        .select("id", "copies", _named().alias("entities"),
                F.array_distinct(F.split(ascii_lower(F.col("text")), BREAK, -1)).alias("words")), 2), "named-texts")
    n = docs.count()
    entities = texts.select("id", "copies", F.explode("entities").alias("entity"))
    # (an entity that all documents name has no information)
    n_e = materialise(merged(entities.groupBy("entity").agg(F.count("*").alias("texts"), F.sum("copies").alias("n_e"))
                      .where((F.col("texts") >= min_texts) & (F.col("n_e") < n)).select("entity", "n_e")), "n-e")
    asked = materialise(merged(entities.select("id", "entity").join(small(n_e, "entity"), "entity")), "asked")
    words = (texts.join(small(asked.select("id").distinct(), "id"), "id", "left_semi")
             .select("id", "copies", F.explode("words").alias("word")).where("word <> ''"))
    near = materialise(merged(words.groupBy("word").agg(F.count("*").alias("texts"), F.sum("copies").alias("n_near"))
                       .where(F.col("texts") >= min_texts).select("word", "n_near")), "near-terms")
    # n(t) over the whole corpus, for the words in question only
    # (a text's own words are made distinct in place, so counts alone are dealt)
    own = F.array_distinct(F.split(ascii_lower(F.col("text")), BREAK, -1))
    n_t = (docs.select(F.explode(own).alias("word")).join(small(near.select("word"), "word"), "word")
           .groupBy("word").agg(F.count("*").alias("n_t")))
    # n(e, t) is at most n(e) and at most the documents in question with the word
    candidates = materialise(merged(near.join(n_t, "word").where(F.col("n_near") / F.col("n_t") >= min_chance)
                             .select("word", "n_t")), "candidates")
    seen = materialise(merged(
        words.join(small(candidates, "word"), "word").join(small(asked, "id", "entity"), "id")
        .where(F.col("n_e") / F.col("n_t") >= min_chance), 2), "seen")
    bits = F.log2(F.lit(float(n)) * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    own_bits = F.log2(F.lit(float(n)) / F.col("n_e"))
    # (1e-9: shares equal to the threshold count, whatever the logarithms' rounding)
    pairs = (seen.groupBy("entity", "word", "n_e", "n_t").agg(F.count("*").alias("texts"), F.sum("copies").alias("n_et"))
             .where((F.col("texts") >= min_texts) & (bits >= own_bits * min_share - 1e-9)
                    & (F.col("n_et") / F.col("n_t") >= min_chance)))
    pairs = materialise(merged(pairs.select("entity", "word")), "pairs")
    return (seen.join(small(pairs, "entity", "word"), ["entity", "word"])
            .groupBy("id").agg(F.collect_set("word").alias("words")))


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with base (base spans) and spans (base and term spans), arrays
    of start, kind_no, end, kind, value in code points, end exclusive.

    Null and empty texts have no spans. Equal texts get equal spans. Term
    spans that touch a base span are left out.
    """
    found = docs.withColumn("base", base_spans("coalesce(text, '')"))
    named = materialise(merged(found.where("size(base) > 0").select("text", F.col("base").alias("spans")), 2), "named")
    told = materialise(merged(disclosing_terms(named, docs).select(F.col("id").alias("__id"), F.col("words").alias("__terms"))), "told")
    told = small(told.withColumn("__size", F.concat_ws(" ", "__terms")), "__id", "__size").drop("__size")
    key = F.when(F.size("base") > 0, F.sha2("text", 256))
    joined = found.withColumn("__key", key).join(told, F.col("__key") == F.col("__id"), "left")
    extra = F.expr(f"""if(__terms IS NULL, cast(array() AS array<{SPAN}>),
      transform(filter({located('text', WORD)}, x -> array_contains(__terms, {_lower_sql('x.value')})
          AND NOT exists(base, b -> b.start < x.end AND x.start < b.end)),
        x -> struct(x.start AS start, {ORDER['term']} AS kind_no, x.end AS end, 'term' AS kind, x.value AS value)))""")
    return joined.withColumn("spans", F.array_sort(F.concat("base", extra))).drop("__key", "__id", "__terms")


def _lower_sql(v: str) -> str:
    from lakeproof.llm.words import LOWER, UPPER
    return f"translate({v}, '{UPPER}', '{LOWER}')"


def sanitised(text: str = "text", spans: str = "spans") -> Column:
    """The text with each span replaced by its kind in brackets; overlapping
    spans are replaced as one, under the kind of the first."""
    return F.expr(f"""if(size({spans}) = 0, {text}, aggregate({spans}, struct(0 AS at, '' AS done),
      (a, s) -> struct(greatest(a.at, s.end) AS at, if(s.start < a.at, a.done,
        concat(a.done, substring({text}, a.at + 1, s.start - a.at), '[', upper(s.kind), ']')) AS done),
      a -> concat(a.done, substring({text}, a.at + 1))))""")


def op9_information_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents."""
    found = with_spans(only(load(spark, sf_dir, "documents"), "doc_id", "text"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) AS long) AS n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"),
                        listed("spans").alias("spans"))
