"""Session, checkpoint and small-table join helpers."""

from __future__ import annotations

import contextlib
import logging
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def build_session(
    master: str | None = None,
    app_name: str = "pairloom",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Session with the settings the library expects (AQE on, UI off, UTC)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only where unset.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; the
    session's value is always used when present.  Only a local-mode session
    without one (tests, benchmarks) gets a fresh folder under the system
    temporary directory.  Materialised stages are Parquet tables under this
    folder, so only the path is needed (also without a SparkContext handle).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # pragma: no cover - e.g. Spark Connect
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir()
        return configured
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a shared folder"
        )
    path = tempfile.mkdtemp(prefix="pairloom-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(path)
        path = sc.getCheckpointDir()
    else:
        spark.conf.set("spark.checkpoint.dir", path)
    log.warning("spark.checkpoint.dir unset; using local folder %s (local mode only)", path)
    return path


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` as a Parquet table under the session's
    checkpoint folder and reading it back.

    Unlike ``Dataset.checkpoint`` on an unpersisted plan, the data is
    computed once (an RDD checkpoint runs the plan again to write it).  The
    files are columnar and compressed, later readers prune columns and push
    filters into them, and a lost executor re-reads them instead of
    recomputing the lineage.  The folder must be shared on a cluster.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


class Stages:
    """Written stages of one run, in a folder of their own under the checkpoint folder.

    ``close()`` (or leaving the ``with`` block) deletes that folder and nothing else;
    results that still read it must have been written by then.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._path: str | None = None
        self._entries: list[str] = []

    @property
    def path(self) -> str:
        if self._path is None:
            self._path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/tables/run-{uuid.uuid4().hex}"
        return self._path

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.parquet(path)

    def write_buckets(self, df: DataFrame, name: str, column: str, n: int) -> DataFrame:
        """As ``write``, in ``n`` hash buckets of ``column``: a join on it, and on more columns,
        reads the stage in place.  The table's entry in the catalog goes with ``close()``."""
        folder = f"{name}-{uuid.uuid4().hex}"
        entry = folder.replace("-", "_")
        out = df.write.mode("errorifexists").format("parquet").bucketBy(n, column)
        out.option("path", f"{self.path}/{folder}").saveAsTable(entry)
        self._entries.append(entry)
        return self.spark.table(entry)

    def close(self) -> None:
        while self._entries:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._entries.pop()}")
        if self._path is None:
            return
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(self._path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
        self._path = None

    def __enter__(self) -> "Stages":
        return self

    def __exit__(self, *exc) -> None:
        self.close()


@contextlib.contextmanager
def stored_partitioning(spark: SparkSession):
    """Within it, a join on more columns than its inputs are partitioned by keeps their
    partitioning, where both have the same; the setting is put back afterwards.  Plans are made
    when a result is written, so that has to happen inside."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def join_small(
    big: DataFrame,
    small: DataFrame,
    on,
    how: str = "inner",
    row_bound: int | None = None,
    max_rows: int | None = None,
    row_bytes: int = 64,
) -> DataFrame:
    """Join with ``small`` broadcast only when its size is proven bounded.

    ``row_bound`` is an upper bound on the rows of ``small`` (counted, or known from
    the plan: bucket count, documents) and ``row_bytes`` on the bytes of one.  Above
    ``max_rows`` or the byte limit the join stays a shuffle join, which AQE may still
    turn into a broadcast at run time when the materialised side is small.
    """
    from .config import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS

    limit = BROADCAST_MAX_ROWS if max_rows is None else max_rows
    if row_bound is not None and row_bound <= limit and row_bound * row_bytes <= BROADCAST_MAX_BYTES:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


def default_parallelism(spark: SparkSession) -> int:
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover - conf always present
        return os.cpu_count() or 8
