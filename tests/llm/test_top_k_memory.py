"""What a task of the top-k search holds depends neither on the number of queries nor on their length."""

import os
import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

from lakeproof.llm import topk

#: One block of 64 dimensions and 80 groups of queries: 80 copies of its raw values take 1.4 GB.
SMALL_HEAP = """
import numpy as np
from lakeproof.llm import topk
from lakeproof.session import local_session

spark = local_session(2, 4, extra={"spark.driver.memory": "700m", "spark.driver.host": "127.0.0.1"})
frame = spark.range(topk.BLOCK_ROWS).selectExpr(
    "id AS vec_id", "transform(sequence(0, 63), i -> cast(hash(id, i) % 16 AS double) / 64) AS embedding")
vectors = topk.numbered(frame)
got = topk.bit_sliced_top_k(vectors, vectors.where("vec_id < 160"), query_group=2).collect()
rows = sorted(vectors.select("vec_id", "q").collect())
x = np.array([r["q"] for r in rows])
want = set()
for i in range(160):
    score = x @ x[i]
    best = [j for j in np.lexsort((np.arange(len(x)), -score))[:21] if j != i][:20]
    want |= {(i, r + 1, int(j), int(score[j])) for r, j in enumerate(best)}
assert len(got) == 3200 and {tuple(r) for r in got} == want
print("as wanted")
"""


def test_many_query_groups_in_a_small_heap(tmp_path):
    root = str(Path(topk.__file__).parents[2])
    env = {k: v for k, v in os.environ.items() if not k.startswith(("SPARK_", "PYSPARK_"))}
    env |= {"PYTHONPATH": root, "PYSPARK_PYTHON": sys.executable, "TMPDIR": str(tmp_path)}
    run = subprocess.run([sys.executable, "-c", SMALL_HEAP], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "as wanted" in run.stdout, run.stderr[-2000:]


def test_blocks_and_lanes_by_bytes(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, [rng.randint(-40, 40) / 64 for _ in range(dim)]) for i, dim in enumerate([0, 3, 24] * 110)]
    rows += [rows[20], rows[20], (None, rows[2][1]), (40, None)]
    q = [(i, [round(64 * x) for x in v]) for i, v in rows if i is not None and v is not None]
    want = Counter()
    for a, (i, x) in enumerate(q):
        if i % 5 == 0:
            best = sorted((-sum(s * t for s, t in zip(x, y)), j) for b, (j, y) in enumerate(q) if b != a and len(x) == len(y))
            want.update((i, r + 1, j, -s) for r, (s, j) in enumerate(best[:20]))
    monkeypatch.setattr(topk, "BLOCK_BYTES", 64 * 8 * 3)  # 64 rows of 3 dimensions, and of 24
    monkeypatch.setattr(topk, "LANE_BYTES", 2000)
    vectors = topk.numbered(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5))
    got = topk.bit_sliced_top_k(vectors, vectors.where("vec_id % 5 = 0"))
    assert Counter(tuple(r) for r in got.collect()) == want
