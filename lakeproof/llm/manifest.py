"""Operator 12: a Merkle manifest of a dataset as a content-addressed DAG.

The leaves of each group ascend by key and are hashed pairwise, level by
level, to the group's subroot; the subroots are the leaves of one more tree
with the dataset's root. What is stored is records: a node's digest and its
descendants ``BITS`` levels below, in order. So a tree of n leaves has
log(n) / ``BITS`` levels of records, and no task holds more than one record's
descendants at a time.

A proof is found by descent: requests start at the root, the digits of a
leaf's rank (base 2**``BITS``) choose the way through each record, the children
not chosen are collected, and the collected segments are reversed in the end.
Requests that share their first digits go down as one, so that the records
near the root are read once, not once a leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.llm.common import load, materialise, only
from lakeproof.llm.sharding import number_rows
from lakeproof.llm.words import small

BITS = 8
FAN = 1 << BITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(*fields: Column) -> Column:
    """sha256 of the fields, each as its byte count, a colon and its value, or ``-`` for null."""
    parts = []
    for f in fields:
        value = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


@dataclass
class Manifest:
    """``records[i]``: digest and children (the digests ``BITS`` levels below,
    fewer at the top of a tree) of the nodes of record level i. ``trees``: the
    group, its number ``tree``, its number of leaves ``n`` and its ``subroot``.
    ``leaves``: the given rows with ``tree`` and ``pos``, the rank in the group.
    ``top``: records and height of the tree over the subroots. ``root`` is None
    for an empty dataset."""

    leaves: DataFrame
    trees: DataFrame
    records: list[DataFrame]
    top: list[DataFrame]
    root: str | None


def _record_levels(n: Column) -> Column:
    """Record levels of a tree with n leaves; a lone leaf has none."""
    height = F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)
    return F.ceil(height / BITS).cast("int")


_FOLD = """aggregate(sequence(1, least({bits}, length(bin(n - 1)))), children, (a, step) ->
    transform(sequence(0, (size(a) - 1) div 2), i -> sha2(concat(a[2 * i], coalesce(get(a, 2 * i + 1), '')), 256)))[0]"""


def _grow(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The records of the trees whose leaves are ``nodes`` (tree, n, pos,
    digest), level by level, and the trees' roots (tree, digest)."""
    records, roots = [], nodes.where("n = 1").select("tree", "digest")
    nodes = nodes.where("n > 1")
    for _ in range(levels):
        blocks = materialise(
            nodes.groupBy("tree", "n", F.shiftright("pos", BITS).alias("at"))
            .agg(F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("found"))
            .select("tree", "n", F.col("at").alias("pos"), F.expr("transform(found, f -> f.digest)").alias("children"))
            .withColumn("digest", F.expr(_FOLD.format(bits=BITS))), "manifest-level")
        records.append(blocks.select("digest", "children").dropDuplicates(["digest"]))
        nodes = blocks.select("tree", F.ceil(F.col("n") / FAN).cast("long").alias("n"), "pos", "digest")
        roots = roots.unionByName(nodes.where("n = 1").select("tree", "digest"))
        nodes = nodes.where("n > 1")
    return records, roots


def build(rows: DataFrame, group: str, order: str, digest: str = "leaf") -> Manifest:
    """The manifest of ``rows``, whose ``digest`` column holds their leaves.
    Null groups and keys come first; rows with equal keys stand in the order
    of their digests; identical rows in any order, which changes nothing."""
    rows = materialise(rows, "manifest-leaves")
    tied = rows.withColumn("__tie", F.monotonically_increasing_id())
    ranked = number_rows(tied, [group, order, digest, "__tie"], "__no").drop("__tie")
    groups = ranked.groupBy(group).agg(F.min("__no").alias("__first"), F.count(F.lit(1)).alias("n"))
    trees = materialise(number_rows(groups, ["__first"], "tree"), "manifest-trees")
    biggest, n_trees = trees.agg(F.max("n"), F.count(F.lit(1))).first()
    if not n_trees:
        return Manifest(rows.limit(0).withColumns({"tree": F.lit(0).cast("long"), "pos": F.lit(0).cast("long"),
                                                   "n": F.lit(0).cast("long")}), trees, [], [], None)
    of_tree = trees.withColumnRenamed(group, "__group")
    leaves = materialise(ranked.join(small(of_tree, "__group"), F.col(group).eqNullSafe(F.col("__group")))
                         .withColumn("pos", F.col("__no") - F.col("__first"))
                         .drop("__group", "__no", "__first"), "manifest-ranked")
    records, roots = _grow(leaves.select("tree", "n", "pos", F.col(digest).alias("digest")), _levels_of(biggest))
    trees = materialise(trees.drop("__first").join(roots.withColumnRenamed("digest", "subroot"), "tree"),
                        "manifest-subroots")
    top, whole = _grow(trees.select(F.lit(-1).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("n"),
                                    F.col("tree").alias("pos"), F.col("subroot").alias("digest")), _levels_of(n_trees))
    return Manifest(leaves, trees, records, top, whole.first()["digest"])


def _levels_of(n: int) -> int:
    return -(-max(n - 1, 0).bit_length() // BITS)


def _segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each record the ways to the wanted digits: the children not chosen,
    from the record's node down. ``<`` and ``>`` tell on which side a sibling
    stands; a node without one gives an empty entry."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            levels = [list(row.children)]
            while len(levels[-1]) > 1 or len(levels) <= row.levels:
                a = levels[-1]
                levels.append([hashlib.sha256((a[i] + (a[i + 1] if i + 1 < len(a) else "")).encode()).hexdigest()
                               for i in range(0, len(a), 2)])
            if levels[-1] != [row.digest]:
                raise ValueError("a record's children do not hash to its digest")
            above, ways = list(row.path), []
            for digit in row.digits:
                way = []
                for depth in range(len(levels) - 2, -1, -1):
                    i, level = digit >> depth, levels[depth]
                    other = i ^ 1
                    way.append(("<" if other < i else ">") + level[other] if other < len(level) else "")
                ways.append([*above, *way])
            yield pd.DataFrame({"tree": [row.tree], "pos": [row.pos],
                                "below": [[row.children[d] for d in row.digits]], "ways": [ways]})


_STEP = "tree long, pos long, below array<string>, ways array<array<string>>"


def _step(frontier: DataFrame, record: DataFrame, wanted: DataFrame, bottom: Column) -> DataFrame:
    """Requests at the nodes of ``frontier`` (tree, pos, height, digest, path)
    go down one record: one row per wanted descendant."""
    at = (frontier.join(record, "digest")
          .join(wanted.select("tree", "pos", F.expr("transform(items, i -> i.digit)").alias("digits")), ["tree", "pos"])
          .select("tree", "pos", "digest", "path", "children", "digits", bottom.cast("int").alias("levels")))
    return at.mapInPandas(_segments, _STEP)


def _wanted(requests: DataFrame, payload: list[str]) -> DataFrame:
    # in the order of their digits: the list is made more than once, and what goes down one
    # reading of it is matched by place with another
    digit = F.col("pos").bitwiseAND(FAN - 1).cast("int").alias("digit")
    return (requests.select("tree", F.shiftright("pos", BITS).alias("at"), F.struct(digit, *payload).alias("item"))
            .groupBy("tree", F.col("at").alias("pos")).agg(F.sort_array(F.collect_list("item")).alias("items")))


def _descend(records: list[DataFrame], starts: DataFrame, requests: DataFrame, payload: list[str]) -> DataFrame:
    """``requests`` (tree, pos, payload) with ``path``, from the top of their
    tree down. ``starts``: tree, n, digest, path of the trees' roots."""
    starts = starts.withColumn("height", F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0))
    lone = starts.where("height = 0").select("tree", "path")
    if not records:
        return requests.join(small(lone), "tree").select("tree", "pos", "path", *payload)
    wanted = [_wanted(requests, payload)]
    for _ in records[1:]:
        wanted.append(_wanted(wanted[-1].select("tree", "pos"), []))
    heights, frontier = starts.select("tree", "height"), None
    for level in range(len(records) - 1, -1, -1):
        fresh = (starts.where(_record_levels(F.col("n")) == level + 1)
                 .select("tree", F.lit(0).cast("long").alias("pos"), "digest", "path"))
        frontier = fresh if frontier is None else frontier.unionByName(fresh)
        known = frontier.join(small(heights), "tree")
        bottom = F.least(F.lit(BITS), F.col("height") - BITS * level)
        ways = _step(known, records[level], wanted[level], bottom)
        if level:
            frontier = (ways.join(wanted[level], ["tree", "pos"])
                        .select("tree", "pos", F.explode(F.arrays_zip(F.col("items.digit").alias("digit"), "below", "ways")
                                                         ).alias("d"))
                        .select("tree", (F.col("pos") * FAN + F.col("d.digit")).alias("pos"),
                                F.col("d.below").alias("digest"), F.col("d.ways").alias("path")))
        else:
            frontier = (ways.join(wanted[0], ["tree", "pos"])
                        .select("tree", "pos", F.explode(F.arrays_zip("items", "ways")).alias("d"))
                        .select("tree", (F.col("pos") * FAN + F.col("d.items.digit")).alias("pos"),
                                F.col("d.ways").alias("path"), *[F.col(f"d.items.{c}").alias(c) for c in payload]))
    single = requests.join(small(lone), "tree").select("tree", "pos", "path", *payload)
    return frontier.select("tree", "pos", "path", *payload).unionByName(single)


def prove(manifest: Manifest, requests: DataFrame, payload: list[str]) -> DataFrame:
    """``requests`` (tree, pos and the ``payload`` columns, rows of
    ``manifest.leaves`` as a rule) with ``subroot`` and ``path``: the siblings
    from the leaf up to the root, marked ``<`` left and ``>`` right, an empty
    entry where a node is hashed alone."""
    spark = requests.sparkSession
    if manifest.root is None:
        return requests.select("tree", "pos", *payload, F.lit(None).cast("string").alias("subroot"),
                               F.lit(None).cast("array<string>").alias("path"))
    n = manifest.trees.count()
    root = spark.range(1).select(F.lit(-1).cast("long").alias("tree"), F.lit(n).cast("long").alias("n"),
                                 F.lit(manifest.root).alias("digest"), F.array().cast("array<string>").alias("path"))
    of_trees = manifest.trees.select(F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("pos"),
                                     F.col("tree").alias("lang_tree"), F.col("n").alias("leaves"), "subroot")
    starts = materialise(_descend(manifest.top, root, of_trees, ["lang_tree", "leaves", "subroot"]).select(
        F.col("lang_tree").alias("tree"), F.col("leaves").alias("n"), F.col("subroot").alias("digest"), "path"),
        "manifest-starts")
    found = _descend(manifest.records, starts, requests, payload)
    return (found.join(small(starts.select("tree", F.col("digest").alias("subroot")), "subroot"), "tree")
            .withColumn("path", F.reverse("path")))


def folded(leaf: str, path: str = "path") -> Column:
    """The root that ``leaf`` and the siblings on its ``path`` hash to."""
    return F.expr(f"""aggregate({path}, {leaf}, (a, s) -> sha2(CASE left(s, 1)
        WHEN '<' THEN concat(substr(s, 2), a) WHEN '>' THEN concat(a, substr(s, 2)) ELSE a END, 256))""")


def proof_digest(path: str = "path") -> Column:
    return F.expr(f"sha2(array_join(transform({path}, s -> substr(s, 2)), ''), 256)")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and what the proof of
    a row tampered with (n_chars plus 1, where 7 divides the crc32 of the
    doc_id) folds to.

    Null fields are hashed as ``-``; a null doc_id comes first in its group and
    is never tampered with, nor does a null n_chars change. Rows that share a
    doc_id stand in the order of their leaves; identical rows are leaves of
    their own with proofs of their own. An empty table gives no rows.
    """
    docs = only(load(spark, sf_dir, "documents"), *FIELDS)
    leaf = digest_of(*[F.col(c) for c in FIELDS])
    changed = digest_of(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS])
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = docs.select("doc_id", "lang", leaf.alias("leaf"),
                       F.when(hit & F.col("n_chars").isNotNull(), changed).alias("tampered"))
    manifest = build(rows, "lang", "doc_id")
    proofs = prove(manifest, manifest.leaves, ["doc_id", "leaf", "tampered"])
    return (proofs.withColumn("root", F.lit(manifest.root))
            .withColumn("__from", F.coalesce("tampered", "leaf"))
            .withColumn("folded_root", folded("__from"))
            .select("doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified"), "pos", F.size("path").alias("height")))
