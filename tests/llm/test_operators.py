"""Every training-data query against brute force on the awkward tables."""

import hashlib
import pathlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lakeproof.llm import neardup, packing, privacy, quality, sharding, suffix, topk
from lakeproof.llm.common import materialise
from lakeproof.llm.queries import ORACLES, QUERIES
from lakeproof.session import ensure_checkpoint_dir


@pytest.fixture(scope="module")
def ids():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda text: np.array(t.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def rows_of(spark, name, tables):
    return [r.asDict() for r in QUERIES[name](spark, tables).collect()]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, no_rows, name):
    assert QUERIES[name](spark, no_rows).count() == 0


def removed(texts, span=200):
    """(text number) -> mask of its covered bytes."""
    places = defaultdict(list)
    for i, t in enumerate(texts):
        for p in range(len(t) - span + 1):
            places[t[p:p + span]].append((i, p))
    masks = [np.zeros(len(t), bool) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for i, p in found:
                masks[i][p:p + span] = True
    return masks


@pytest.mark.parametrize("hot", [suffix.HOT, 1])
def test_suffix_dedup(spark, tables, rows, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT", hot)  # 1: every core goes by window hashes
    texts = [(t or "").encode() for _, t in rows]
    want = Counter()
    for (doc, _), t, m in zip(rows, texts, removed(texts)):
        runs = int((np.diff(np.concatenate(([0], m.astype(int)))) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~m].tobytes()
        want[doc, len(t), int(m.sum()), runs, hashlib.sha256(kept).hexdigest()] += 1
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                  for r in rows_of(spark, "op1_suffix_dedup", tables))
    assert got == want


def test_merge_never_loses_order():
    rng = np.random.default_rng(3)
    for k in range(1, 8):
        runs = [sorted(bytes(rng.integers(97, 99, rng.integers(0, 12)).tolist()) for _ in range(rng.integers(0, 30)))
                for _ in range(k)]
        shared = [suffix.front_code(r)[0].tolist() for r in runs]
        order, prefixes = suffix.merge_runs(runs, shared)
        out = [runs[r][i] for r, i in order]
        assert out == sorted(x for r in runs for x in r)
        assert prefixes[1:] == [suffix.common_prefix(a, b, 0) for a, b in zip(out, out[1:])]


def test_quality_scores_every_row(spark, tables, rows):
    got = rows_of(spark, "op2_co_training_quality", tables)
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, _ in rows)
    assert all(r["kept"] == (r["p_low_quality"] < 0.5 and r["p_toxic"] < 0.5) for r in got)


def test_quality_held_out_accuracy(spark):
    """Labels that training never sees, at sf0.1."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    models = quality.train(docs, labels.where("doc_id % 3 <> 0"))
    scored = quality.score(docs, models).join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    wrong = ((scored.quality == 0) | (scored.toxic == 1)) == scored.kept
    assert len(scored) > 1000 and wrong.mean() < 0.02


def test_quality_learns_from_whole_texts(spark):
    """Only the last word, past 12,000 characters, tells toxic texts from others."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["lorem", "ipsum", "dolor", "amet"]) for _ in range(2400))
             + (" vilezork" if i % 5 < 2 else " goodzork")) for i in range(400)]
    assert min(len(t) for _, t in rows) > 12_000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 5 < 2)) for i in range(300)], "doc_id long, quality int, toxic int")
    scored = quality.score(docs, quality.train(docs, labels)).toPandas()
    assert len(scored) == 400 and (scored.kept == (scored.doc_id % 5 >= 2)).all()


def test_top_k(spark, tables):
    columns = ["query_id", '"rank"', "vec_id", "score"]
    got = Counter((r["query_id"], r["rank"], r["vec_id"], r["score"])
                  for r in rows_of(spark, "op3_bit_sliced_top_k", tables) if r["query_id"] < 200)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tables}/embeddings.parquet' WHERE vec_id < 200")
    want = Counter(con.execute(f"SELECT {', '.join(columns)} FROM ({topk.ORACLE})").fetchall())
    assert got == want


def test_block_top_against_sorting():
    rng = np.random.default_rng(1)
    x = rng.integers(-9, 9, (500, 6))
    block = topk.SlicedBlock(np.arange(500), x)
    for own in (-1, 17):
        q = rng.integers(-9, 9, 6)
        scores = x @ q
        order = [i for i in np.lexsort((np.arange(500), -scores)) if i != own][:25]
        rows, score = block.top(q, 25, own)
        assert set(rows) == set(order) and (score == scores[rows]).all()


def test_sharding(spark, tables, rows):
    got = rows_of(spark, "op4_feistel_sharding", tables)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert set(by) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    for n in (1, 2, 5, 64, 1000):
        p = sharding.permute(np.arange(n), n)
        assert sorted(p) == list(range(n)) and (sharding.permute(p, n, inverse=True) == np.arange(n)).all()


def test_packing(spark, tables, rows, ids):
    got = sorted(rows_of(spark, "op5_best_fit_packing", tables), key=lambda r: (r["sequence_id"], r["offset"]))
    want = Counter()
    for d, t in rows:
        x = ids(t)
        for i, lo in enumerate(range(0, len(x), 4096)):
            want[d, i, lo, len(x[lo:lo + 4096]), zlib.crc32(x[lo:lo + 4096].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    ends = Counter()
    for r in got:
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 4096


def test_packing_writes_few_files_of_many_splits(spark):
    cores = spark.sparkContext.defaultParallelism
    docs = spark.range(2000).selectExpr("id AS doc_id", "concat('text ', id) AS text").repartition(cores * 4 + 20)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesced = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", str(cores + 30))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        packed = packing.pack_documents(docs)
        assert len(packed.inputFiles()) <= cores * 4
        assert packed.rdd.getNumPartitions() <= cores
        assert sorted(r["doc_id"] for r in packed.collect()) == list(range(2000))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)


def test_fullest_bin_against_all_subsets():
    counts = {7: 2, 5: 1, 3: 2, 2: 1}
    items = [n for n, k in counts.items() for _ in range(k)]
    for capacity in range(7, 30):
        best = max(7 + sum(items[i] for i in range(1, len(items)) if m >> i & 1)
                   for m in range(1 << len(items))
                   if 7 + sum(items[i] for i in range(1, len(items)) if m >> i & 1) <= capacity)
        assert sum(n * k for n, k in packing.fullest(7, sorted(counts, reverse=True), counts, capacity).items()) == best


def test_decontamination(spark, tables):
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{tables}/benchmark.parquet'")
    con.execute(f"CREATE VIEW documents AS SELECT DISTINCT doc_id, text FROM '{tables}/documents.parquet'")
    want = Counter(con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES['op6_positional_decontamination']}) "
                               "WHERE doc_id IS NOT NULL").fetchall())
    got = rows_of(spark, "op6_positional_decontamination", tables)
    assert sum(r["contaminated"] for r in got) >= 3
    assert {tuple(r[c] for c in columns) for r in got if r["doc_id"] is not None} == set(want)


def test_token_files(spark, tables, rows, ids):
    got = sorted(rows_of(spark, "op7_token_files", tables), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(
        (d, len(ids(t)), zlib.crc32(ids(t).tobytes())) for d, t in rows)
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1]]


def test_separator_scan(spark, tables, rows, ids):
    got = rows_of(spark, "op8_separator_scan", tables)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == Counter((d, len(ids(t))) for d, t in rows)


def test_separator_scan_stitches_blocks(spark, tmp_path):
    from lakeproof.llm.tokenfiles import scan_separators
    flat = np.array([5, 5, 9, 9, 5, 5, 5, 5, 5, 5, 9, 5, 5], "<u2")
    flat.tofile(tmp_path / "f.bin")
    files = spark.createDataFrame([("f.bin", len(flat))], "file string, file_tokens long")
    got = scan_separators(files, f"file://{tmp_path}", end_id=9, block_tokens=2).orderBy("ordinal").collect()
    assert [(r.ordinal, r.start, r.n_tokens, r.terminated) for r in got] == [
        (0, 0, 3, True), (1, 3, 1, True), (2, 4, 7, True), (3, 11, 2, False)]


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in twice) % 10 == 0


def base_of(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 12 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 9 <= len(digits) <= 15):
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


def test_privacy(spark, tables, rows):
    got = rows_of(spark, "op9_information_sanitisation", tables)
    want = Counter()
    for d, t in rows:
        spans = base_of(t or "")
        text = ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)
        want[d, *[sum(x[3] == k for x in spans) for k in PLAIN], hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"])
                   for r in got) == want
    clean = {d for d, t in rows if not base_of(t or "")}
    assert all(r["spans"] == "" for r in got if r["doc_id"] in clean)


def test_terms_that_give_an_entity_away(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text")
    found = privacy.with_spans(docs).withColumn("safe", privacy.sanitised()).where("text LIKE '%Quastorp%'").collect()
    assert len(found) == 5
    for r in found:
        assert "secret.one" not in r.safe and "[EMAIL]" in r.safe


def test_terms_of_small_tables_and_hot_entities(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text")
    found = privacy.with_spans(docs).withColumn("safe", privacy.sanitised()).where("text LIKE '%Quastorp%'").collect()
    assert len(found) == 5 and not any("Quastorp" in r.safe or "Melvin" in r.safe for r in found)
    # an address in a third of 24 documents; "common" stands in all, "hall" with it in 4 of 10
    texts = [f"common Velgard at hot.one@mail.example.org{' hall' * (i < 4)}" if i < 8 else
             f"common prose at{' hall' * (i < 14)}" for i in range(24)]
    docs = spark.createDataFrame([(i, t.replace("common", "common " + "xyzuvw"[i % 6] * (3 + i))) for i, t in enumerate(texts)],
                                 "doc_id long, text string")
    for r in privacy.with_spans(docs).collect():
        assert [s.value for s in r.spans if s.kind == "term"] == ["Velgard"] * (r.doc_id < 8)


def test_terms_anywhere_in_a_text(spark):
    """Telling words 400 characters and more from the address, near it in some texts and far in others."""
    gap = " ".join(["filler"] * 60)
    texts = [f"Velgard {gap} write to far.one@mail.example.org {gap} Meldorf" if i < 6 else f"{gap} {i}" for i in range(200)]
    texts[:2] = [f"{gap} Velgard write to far.one@mail.example.org Meldorf {i}" for i in range(2)]
    texts[2:6] = [f"{t} {'xyzu'[i] * 9}" for i, t in enumerate(texts[2:6])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in privacy.with_spans(docs).collect():
        told = {s.value for s in r.spans if s.kind == "term"}
        assert (told >= {"Velgard", "Meldorf"} and "filler" not in told) if r.doc_id < 6 else not told


def spans_with_terms(texts):
    """Brute force: base and term spans of each text."""
    lower = [re.sub("[A-Z]+", lambda m: m[0].lower(), t or "") for t in texts]
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    words = [set(re.findall(word, t)) for t in lower]
    names = [{(t or "")[s:e].lower() for s, _, e, _ in base_of(t or "")} for t in texts]
    n_e, n_t = Counter(e for x in names for e in x), Counter(w for x in words for w in x)
    n_et = Counter((e, w) for x, y in zip(names, words) for e in x for w in y)
    where = defaultdict(set)
    for t, x, y in zip(texts, names, words):
        for e in x:
            for w in y:
                where[e, w].add(t)
    n = len(texts)
    tell = {(e, w) for (e, w), k in n_et.items() if len(where[e, w]) >= 3 and n_e[e] < n and 2 * k >= n_t[w]
            and np.log2(n * k / (n_e[e] * n_t[w])) >= 0.5 * np.log2(n / n_e[e]) - 1e-9}
    out = []
    for t, low, x in zip(texts, lower, names):
        base = base_of(t or "")
        terms = [(m.start(), len(PLAIN), m.end(), "term") for m in re.finditer(word, low) if any((e, m[0]) in tell for e in x)
                 and not any(s < m.end() and m.start() < stop for s, _, stop, _ in base)]
        out.append(",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(base + terms)))
    return out


def test_term_spans_against_brute_force(spark, rows):
    rng = random.Random(11)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in ("", "1", "22", "io", "rtz")]
    people = [("Quastorp Li jo77", "a@b.cd"), ("\u674e\u660e 24105", "10.1.2.3"), ("K9 Meldorf", "+49 (30) 123456-78"),
              ("Ana", "hot@b.cd"), ("Ana Bo", "rare@b.cd")]
    texts = [t for _, t in rows] + [None, ""]
    for i in range(150):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60)))
        for j, (about, entity) in enumerate(people):
            if rng.random() < (0.5 if j == 3 else 0.1):
                a, b = rng.sample(about.split() * 2, 2)
                text = rng.choice([f"{a} writes to {entity} from {b}", f"{about} {text} {entity}", f"{entity.upper()} {text} {b}"])
        texts += [text] * rng.choice([1, 1, 1, 3])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = privacy.with_spans(docs).select("doc_id", privacy.listed("spans").alias("spans")).collect()
    want = spans_with_terms(texts)
    assert {r.doc_id: r.spans for r in got} == dict(enumerate(want))
    told = Counter(texts[i][int(s.split(":")[1]):int(s.split(":")[2])] for i, w in enumerate(want) for s in w.split(",") if "term" in s)
    assert all(told[w] for w in ("Quastorp", "Li", "jo77", "\u674e\u660e", "24105", "K9"))


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_roots(rows, threshold):
    """The sets by doc_id, and each one's smallest reachable doc_id."""
    sets = {d: shingle_set(t) for d, t in rows if d is not None}
    root = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= threshold * len(sets[a] | sets[b]) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return sets, root


def test_near_duplicates(spark, tables, rows):
    sets, root = near_roots(rows, 85)
    got = rows_of(spark, "op10_minhash_near_dedup", tables)
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), root[r["doc_id"]])
            assert r["kept"] == (r["doc_id"] == r["component_id"])
        else:
            assert r["component_id"] is None and r["kept"]


def test_matches_miss_one_pair_in_a_million():
    assert (neardup.matches_for(85), neardup.matches_for(80)) == (16, 13)


def test_pipeline_drops_near_copies_at_080(spark, tmp_path):
    rng = random.Random(3)
    texts = []
    for _ in range(40):  # one changed word leaves 0.79 to 0.86 of the shingles
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.randint(46, 66))]
        texts.append(" ".join(words))
        words[rng.randrange(10, 30)] = "other"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    assert near_roots(rows, 80)[1] != near_roots(rows, 85)[1]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert kept == {d for d, r in near_roots(rows, 80)[1].items() if d == r}


def test_pipeline_stages(spark, tables, no_rows):
    for folder in (tables, no_rows):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == corpus_pipeline.COLUMNS, name
    assert corpus_pipeline.run(spark, tables).select("doc_id").distinct().count() > 20


def test_pipeline_stages_merge_small_splits(spark, tables):
    cores = spark.sparkContext.defaultParallelism
    docs = spark.read.parquet(f"{tables}/documents.parquet").repartition(cores * 4 + 20)
    for stage in (corpus_pipeline.quality, corpus_pipeline.near_dedup):
        assert stage(spark, docs, tables).rdd.getNumPartitions() <= cores * 4
    assert corpus_pipeline.parts(docs, spark.range(1)).count() == docs.count()


def test_tables_written_inside_merge_small_parts(spark, tables):
    cores = spark.sparkContext.defaultParallelism
    held = {"spark.sql.shuffle.partitions": str(cores * 4 + 20), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    home = pathlib.Path(ensure_checkpoint_dir(spark).removeprefix("file:")) / "llm"
    old = set(home.glob("*"))
    rows = spark.read.parquet(f"{tables}/documents.parquet").repartition(cores * 4 + 20)
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        docs = materialise(rows, "small-parts")
        assert len(docs.inputFiles()) > cores * 4
        for stage in (corpus_pipeline.near_dedup, corpus_pipeline.decontamination, corpus_pipeline.pii):
            stage(spark, docs, tables).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {f.name.rsplit("-", 1)[0]: len(list(f.glob("part-*"))) for f in set(home.glob("*")) - old}
    assert files.pop("small-parts") > cores * 4
    assert len(files) > 12 and max(files.values()) <= cores * 2, files
    assert max(files[n] for n in ("classes", "vocabulary", "term-counts", "windows", "near-terms")) <= cores, files
