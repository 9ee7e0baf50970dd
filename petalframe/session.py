"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the operators assume. AQE re-plans joins from runtime sizes and
# splits skewed shuffle partitions; the session zone is pinned so that
# timestamp arithmetic does not depend on the machine.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "petalframe", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the session-level SQL settings to an existing session."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    On a cluster ``spark.checkpoint.dir`` names a shared file system and is
    taken as is. Only when it is unset and the master is local (tests, a
    laptop) a scratch folder is made here.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="petalframe-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


_scratch: list[str] = []


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table: under the shared checkpoint folder, or
    under the :func:`scratch` folder in use."""
    base = _scratch[-1] if _scratch else f"{ensure_checkpoint_dir(spark).rstrip('/')}/petalframe"
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch(spark: SparkSession):
    """Tables that operators write inside the block are deleted at its end. What
    they return reads those tables: use it up, or write it elsewhere, inside."""
    path = work_dir(spark, "scratch")
    _scratch.append(path)
    try:
        yield path
    finally:
        _scratch.remove(path)
        delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df, name: str = "stage"):
    """Write ``df`` once as a parquet table under the shared checkpoint folder
    and read it back.

    For an intermediate that several later branches reuse: it is computed
    once instead of once per branch, and its lineage is cut, so a lost
    executor re-reads the files instead of recomputing the input. (A reliable
    ``checkpoint()`` of an unpersisted frame would compute it twice: once for
    the action, once more to write the files.) The files also give the
    planner exact sizes for its broadcast decisions.
    """
    return materialize_counted(df, name)[0]


def materialize_counted(df, name: str = "stage"):
    """:func:`materialize` that also returns the row count, observed during
    the write (no second job)."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    spark = df.sparkSession
    path = work_dir(spark, name)
    obs = Observation(f"rows-{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path), int(obs.get["rows"])


# A side of a join is broadcast only after counting it; beyond this many rows
# the join is left to the planner (AQE picks a shuffle join from run-time sizes).
BROADCAST_MAX_ROWS, BROADCAST_MAX_BYTES = 2_000_000, 64 << 20


def bounded_broadcast(df, max_rows: int = BROADCAST_MAX_ROWS):
    """Materialise a small derived frame, check its size, then broadcast it.

    Returns ``(frame, rows)``. The frame is written once (so the count and the
    later join read the same files instead of recomputing the lineage); it
    carries a broadcast hint only when ``rows <= max_rows`` and its files take
    at most :data:`BROADCAST_MAX_BYTES`.
    """
    from pyspark.sql import functions as F

    m, n = materialize_counted(df, "small")
    return (F.broadcast(m) if n <= max_rows and _file_bytes(m) <= BROADCAST_MAX_BYTES else m), n


def _file_bytes(df) -> int:
    """Bytes of the files behind a frame that was just read back."""
    jvm, spark = df.sparkSession._jvm, df.sparkSession
    conf = spark._jsc.hadoopConfiguration()
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in (jvm.org.apache.hadoop.fs.Path(f) for f in df.inputFiles()))
