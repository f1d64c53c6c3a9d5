"""Rows that share an id or have none: each is a query or a document of its own."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb

from lakeproof.llm import decontaminate, topk
from tests.llm.conftest import prose


def test_repeated_queries_rank_apart(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(6)]) for i in range(70)]
    rows += [rows[20], rows[20], (40, rows[3][1]), (41, rows[40][1])]
    q = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    want = Counter()
    for a, (i, x) in enumerate(q):
        if i % 20 == 0:
            best = sorted((-sum(s * t for s, t in zip(x, y)), j) for b, (j, y) in enumerate(q) if b != a)[:20]
            want.update((i, r + 1, j, -s) for r, (s, j) in enumerate(best))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    vectors = topk.numbered(frame)
    got = topk.bit_sliced_top_k(vectors, vectors.where("vec_id % 20 = 0"), block_rows=16, query_group=3)
    assert Counter(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == want
    assert sum(want.values()) == 20 * 7
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    sql = f'SELECT query_id, "rank", vec_id, score FROM ({topk.ORACLE})'
    assert Counter(con.execute(sql).fetchall()) == want


def words_of(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def windows_of(text):
    w = words_of(text)
    return {tuple(w[i:i + 10]) for i in range(max(len(w) - 9, 1))} if w else set()


def batch():
    rng = random.Random(11)
    passage, other = prose(rng, 25), prose(rng, 12)
    moved = " ".join(w + (" inserted" if i % 3 == 2 else "") for i, w in enumerate(passage.split(" ")))
    docs = [(None, "so " + passage), (None, prose(rng, 30)), (None, other), (5, moved), (6, None), (2 ** 62 + 1, passage)]
    docs += [(7, f"n{i} " + passage) for i in range(40)] + [(7, prose(rng, 15)), (8, ""), (9, "w " * 3000 + other)]
    return docs, [(1, passage), (2, other), (3, passage), (4, "Lone, word"), (4, "and"), (5, None), (6, "!")]


def test_documents_without_an_id_or_with_a_shared_one_are_hit(spark):
    docs, items = batch()
    want = Counter()
    for doc_id, text in docs:
        w, hit, found = words_of(text), set(), set()
        for item, passage in items:
            for g in windows_of(passage):
                for i in range(len(w) - len(g) + 1):
                    if tuple(w[i:i + len(g)]) == g:
                        hit.update(range(i, i + len(g)))
                        found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        want[doc_id, len(w), len(hit), len(found), digest, bool(hit)] += 1
    got = decontaminate.decontaminated(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                                       spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == ["doc_id", "text", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert Counter(tuple(r) for r in got.drop("text").collect()) == want
    assert sum(n for k, n in want.items() if k[0] is None and k[-1]) == 2


def test_near_matches(spark):
    docs, items = batch()
    counts = Counter(w for _, text in docs for w in words_of(text))
    want = Counter()
    for doc_id, text in docs:
        places = {}
        for i, w in enumerate(words_of(text)):
            places.setdefault(w, []).append(i)
        for item in {i for i, _ in items}:
            n = 0
            for g in set().union(*(windows_of(p) for i, p in items if i == item)):
                two = sorted(set(g), key=lambda w: (counts[w], w.encode()))[:2]
                n += len(two) == 2 and any(abs(a - b) <= 10 for a in places.get(two[0], []) for b in places.get(two[1], []))
            if n:
                want[doc_id, item, n] += 1
    got = decontaminate.near_matches(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                                     spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == want
    assert any(k[0] == 5 for k in want)  # words put in: no phrase, but near
