"""The Merkle manifest against a brute-force tree."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeproof.llm import manifest
from lakeproof.llm.manifest import op12_merkle_manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        a = levels[-1]
        levels.append([h(*a[i:i + 2]) for i in range(0, len(a), 2)])
    return levels


def way(levels, i):
    out = []
    for level in levels[:-1]:
        other = i ^ 1
        out.append((other < i, level[other]) if other < len(level) else None)
        i //= 2
    return out


def fold(node, path):
    for s in path:
        node = h(node) if s is None else h(s[1], node) if s[0] else h(node, s[1])
    return node


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf_of(r), r))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels_of([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in langs}
    top = levels_of([trees[g][-1][0] for g in langs])
    out = Counter()
    for k, g in enumerate(langs):
        for i, (_, _, leaf, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path = way(trees[g], i) + way(top, k)
            start = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                start = leaf_of((*r[:3], r[3] + 1, r[4]))
            found = fold(start, path)
            out[r[0], leaf, trees[g][-1][0], top[-1][0], h(*[s[1] for s in path if s]), found, found == top[-1][0]] += 1
    return out


def got(spark, folder):
    return Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"])
                   for r in op12_merkle_manifest(spark, str(folder)).collect())


def rows_in(folder):
    t = pq.read_table(f"{folder}/documents.parquet").to_pydict()
    return list(zip(t["doc_id"], t["source"], t["lang"], t["n_chars"], t["text"]))


def test_manifest_of_the_awkward_table(spark, tables):
    want = brute(rows_in(tables))
    assert got(spark, tables) == want
    assert {r[6] for r in want} == {True, False}


@pytest.mark.parametrize("bits", [1, 2, 8])
def test_records_of_any_size_give_the_same_proofs(spark, tmp_path, monkeypatch, bits):
    """Groups of 1, 2, 3, 16, 17 and 300 leaves, ids beside 2**63 and nulls, rows repeated."""
    monkeypatch.setattr(manifest, "BITS", bits)
    monkeypatch.setattr(manifest, "FAN", 1 << bits)
    rows = []
    for lang, n in ((None, 3), ("a", 1), ("b", 2), ("é", 16), ("z", 17), ("zz", 300)):
        rows += [((1 << 63) - 1 - i, f"s{i % 3}", lang, i if i % 5 else None, f"text {i} é") for i in range(n)]
    rows += [(None, None, None, None, None), (None, "s", "z", 4, ""), rows[-1], rows[-1], (rows[-1][0], "other", "zz", 1, "t")]
    if bits == 1:
        rows = rows[:45]
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    pq.write_table(pa.table({n: pa.array(c, t) for n, c, t in zip(names, zip(*rows), types)}),
                   tmp_path / "documents.parquet")
    assert got(spark, tmp_path) == brute(rows)


def test_proof_of_a_few_requests(spark, tables):
    """Requests for some leaves alone get the proofs they get among all."""
    docs = spark.read.parquet(f"{tables}/documents.parquet").select(*manifest.FIELDS)
    m = manifest.build(docs.select("doc_id", "lang", manifest.digest_of(*[F.col(c) for c in manifest.FIELDS]).alias("leaf")),
                       "lang", "doc_id")
    some = m.leaves.where("pos % 11 = 3")
    proofs = manifest.prove(m, some, ["leaf"]).withColumn("root", manifest.folded("leaf")).collect()
    assert len(proofs) == some.count() > 3
    assert {p["root"] for p in proofs} == {m.root}


@pytest.mark.parametrize("parts", [1, 7])
def test_wanted_digits_stand_in_order_however_they_arrive(spark, parts):
    n = 2 * manifest.FAN + 29
    requests = spark.range(n).select(F.lit(0).cast("long").alias("tree"), (F.lit(n - 1) - F.col("id")).alias("pos"),
                                     F.hash("id").alias("x")).repartition(parts)
    for row in manifest._wanted(requests, ["x"]).collect():
        digits = [i["digit"] for i in row["items"]]
        assert digits == list(range(29 if row["pos"] == 2 else manifest.FAN))
