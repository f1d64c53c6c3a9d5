"""Small tables with the awkward cases: nulls, empty and long texts, repeated
rows, near copies, benchmark passages, personal data, and extra columns whose
names the operators use themselves."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

WORDS = [a + b + c for a in "bdfgklm" for b in "aeiou" for c in ("n", "rt", "sk", "l")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def make_tables(folder, empty=False):
    rng = random.Random(7)
    base = [prose(rng, rng.randint(3, 220)) for _ in range(60)]
    passage = prose(rng, 70)
    items = [prose(rng, 30), prose(rng, 14), prose(rng, 4), "", None]
    texts = [*base, base[3], base[3], base[5]]
    long = prose(rng, 20_000)
    texts += [None, "", "   ", "a", "x" * 5000, "ab" * 700, long, "é ñ ß " + base[7], base[7] + " tail"]
    for i in range(12):  # near copies, and a passage that many share
        words = base[8].split(" ") + base[9].split(" ") + base[10].split(" ")
        words[rng.randrange(len(words))] = f"new{i}"
        texts.append(" ".join(words))
        texts.append(prose(rng, 20) + "\n" + passage + "\n" + prose(rng, 15))
    texts += [prose(rng, 20) + " " + items[0] + " " + prose(rng, 5), items[1].upper(), "Zzz " + items[2] + "!", items[0][:60]]
    texts += [f"write to jo.{i % 3}@mail.example.org, call +49 (30) 12345-67{i} or 10.0.{i}.255; " + base[i] for i in range(6)]
    texts += ["4111 1111 1111 1111 and 4111-1111-1111-1112, 300.1.2.3 1.2.3.4.5 a@b@c.de", "9" * 3000, "1 " * 900, "a" * 4000]
    texts += ["Melvin Quastorp asks " + prose(rng, 12) + f" Melvin Quastorp box{i} secret.one@mail.example.org Melvin" for i in range(5)]
    doc = list(range(100, 100 + len(texts)))
    doc[20] = None
    texts.append(texts[0]); doc.append(doc[0])  # a repeated row  # noqa: E702
    n = len(texts)
    documents = pa.table({
        "doc_id": pa.array(doc, pa.int64()), "text": pa.array(texts, pa.string()),
        "lang": pa.array([None if i % 9 == 0 else "en" for i in range(n)], pa.string()),
        "source": pa.array([f"s{i % 4}" for i in range(n)], pa.string()),
        "n_chars": pa.array([None if t is None else len(t) for t in texts], pa.int64()),
        "key": pa.array(["clash"] * n), "n": pa.array([1] * n), "word": pa.array(["w"] * n), "core": pa.array([0] * n)})
    vectors = [[rng.gauss(0, 0.2) for _ in range(8)] for _ in range(130)]
    vectors[30] = vectors[31] = vectors[32] = vectors[20]
    vectors += [None, [None] * 8, [float("nan")] * 8, [0.1] * 5, [0.2] * 5]
    ids = [*range(130), 140, 160, 180, 200, 201]
    embeddings = pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())),
                           "label": pa.array([0] * len(ids)), "dim": pa.array([9] * len(ids))})
    benchmark = pa.table({"item_id": pa.array([9, 10, 11, 12, 13], pa.int64()), "text": pa.array(items, pa.string()),
                          "word": pa.array(["x"] * 5)})
    labels = pa.table({"doc_id": pa.array([d for d in doc if d], pa.int64()),
                       "quality": pa.array([None if i == 4 else int(i % 3 > 0) for i in range(n - 1)], pa.int32()),
                       "toxic": pa.array([int(i % 5 == 0) for i in range(n - 1)], pa.int32())})
    for name, t in dict(documents=documents, embeddings=embeddings, benchmark=benchmark, labels=labels).items():
        pq.write_table(t.slice(0, 0) if empty else t, f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def tables(tmp_path_factory):
    return make_tables(tmp_path_factory.mktemp("tables"))


@pytest.fixture(scope="session")
def no_rows(tmp_path_factory):
    return make_tables(tmp_path_factory.mktemp("no_rows"), empty=True)


@pytest.fixture(scope="session")
def rows(tables):
    t = pq.read_table(f"{tables}/documents.parquet").to_pydict()
    return list(zip(t["doc_id"], t["text"]))
