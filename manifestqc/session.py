"""Session helpers: a local session for tests/bench and lineage cutting."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LEAST_SPLITS = "spark.sql.files.minPartitionNum"


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "manifestqc") -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def submitted_session(app: str = "manifestqc") -> SparkSession:
    """The session of ``spark-submit`` (or one that is running), a local one where no master is set."""
    from pyspark import SparkConf
    if SparkSession.getActiveSession() is None and SparkConf().get("spark.master") is None:
        return local_session(app=app)
    return SparkSession.builder.appName(app).getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared folder and is used as is.  Only
    on a local master a scratch folder is made where it is unset; elsewhere a
    folder of one machine would be another disk on every executor.
    """
    sc = spark.sparkContext
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        try:
            conf = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # pragma: no cover
            conf = None
    if not conf and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not conf:
        conf = tempfile.mkdtemp(prefix="manifestqc-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", conf)
        except Exception:  # pragma: no cover - some deployments refuse runtime core confs
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(conf)
    return conf


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder
    (survives executor loss, unlike a cache or a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder (never a
    machine-local temporary folder on a cluster)."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/manifestqc-scratch/{name}-{uuid.uuid4().hex}"


@contextmanager
def sparing_disk(spark: SparkSession) -> Iterator[None]:
    """Writes and actions called in here remove their shuffle files when they end (otherwise these stay until the driver's
    garbage collection finds them) and read small files in as many tasks as there are shuffle partitions, so that sorts need not spill.
    Frames made in here are not to be handed out: read twice, they would shuffle again."""
    wanted = {SHUFFLES_GO: "true", LEAST_SPLITS: spark.conf.get(LEAST_SPLITS, None) or spark.conf.get("spark.sql.shuffle.partitions")}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def kept(df: DataFrame) -> DataFrame:
    """Cut lineage like ``materialize``, in the same shared folder, but as compressed columns: a table with many repeated
    cells takes a fraction of the disk, and branches read the columns they need.  Column names may be any text."""
    spark = df.sparkSession
    path = scratch_path(spark, "kept")
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    with sparing_disk(spark):
        plain.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(plain.schema).parquet(path).toDF(*df.columns)


def forget(df: DataFrame) -> None:
    """Deletes the checkpoints that the plan of ``df`` reads, once no other frame reads them."""
    sc = df.sparkSession.sparkContext
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        if leaf.getClass().getSimpleName() == "LogicalRDD" and leaf.rdd().getCheckpointFile().isDefined():
            folder = sc._jvm.org.apache.hadoop.fs.Path(leaf.rdd().getCheckpointFile().get())
            folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)
