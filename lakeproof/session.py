"""Session construction and shared scratch locations.

Engine functions never create or stop a session: the caller owns it. This
module only helps tests, the benchmark and the command line build one with
settings that suit the engine (UTC clock, AQE, no UI).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every session running the engine should carry. At cluster scale the
# shuffle partition count is a starting point only: AQE coalesces small
# partitions and splits skewed ones at run time.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "lakeproof", extra: dict | None = None) -> SparkSession:
    """A local-mode session for tests and the benchmark."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for key, value in {**ENGINE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is. Only when it is unset (local tests, the benchmark) a folder of our
    own is created so that ``checkpoint()`` and scratch tables have a home.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the client has no SparkContext
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            raise RuntimeError("spark.checkpoint.dir is not set on the Spark Connect server")
        return current
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS, object store) "
                           "for checkpoints and scratch tables")
    local = tempfile.mkdtemp(prefix="lakeproof-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "lakeproof-scratch", f"{label}-{uuid.uuid4().hex[:12]}")


def scale_conf(input_bytes: int, partition_bytes: int = 512 * 1024 ** 2) -> dict[str, str]:
    """Shuffle and scan sizing for a job reading ``input_bytes``.

    Map splits and shuffle partitions both target ``partition_bytes`` so a
    task's share fits executor memory; AQE then coalesces partitions that
    turn out small and splits skewed ones. At 100 TB and 512 MiB this is about
    200k map tasks and 200k initial reducers before coalescing.
    """
    n = max(200, -(-int(input_bytes) // int(partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        **{k: v for k, v in ENGINE_CONF.items() if k != "spark.ui.enabled"},
    }


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files behind a frame that reads files, by the plan's statistics."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def read_bytes(df: DataFrame) -> int:
    """Bytes of all tables that a frame is made from, by the plan's statistics."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.length()))


@contextmanager
def sized_shuffle(spark: SparkSession, n_bytes: int) -> Iterator[None]:
    """While the block runs, at least as many shuffle partitions as ``scale_conf``
    gives for the input; a larger setting of the session's own is kept."""
    key = "spark.sql.shuffle.partitions"
    before, target = spark.conf.get(key), int(scale_conf(n_bytes)["spark.sql.adaptive.advisoryPartitionSizeInBytes"])
    wanted = -(-n_bytes // target)
    if wanted > int(before):
        spark.conf.set(key, str(wanted))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of the engine's own, on whatever store it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of ``spark``: as a
    zip sent once per application, unless PYTHONPATH names its folder already."""
    import pathlib
    import zipfile

    root = pathlib.Path(__file__).resolve().parent.parent
    sc = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_lakeproof_shipped", False):
        return
    path = pathlib.Path(tempfile.mkdtemp(prefix="lakeproof-zip-")) / "lakeproof.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted((root / "lakeproof").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(str(path))
    sc._lakeproof_shipped = True
