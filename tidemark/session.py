"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # HotSpot never compiles methods above 8000 bytes; wide projections run faster split up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
RUNTIME = ("spark.sql.codegen.hugeMethodLimit",)

#: Folders written by ``materialize`` and not yet released, per application.
_WRITTEN: dict[str, list[str]] = {}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tuned(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session that was built elsewhere."""
    for key in RUNTIME:
        spark.conf.set(key, SETTINGS[key])
    return spark


def is_single_machine(master: str) -> bool:
    """True for ``local`` and ``local[...]``; a ``local-cluster`` has executors of its own."""
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without that setting a single-machine session gets a temporary folder; on a cluster, where such
    a folder would be a different one on each machine, the call raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder is None:
        if not is_single_machine(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, remembered until ``release``."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def mounted_path(spark: SparkSession, path: str) -> str | None:
    """The plain path of a file or folder that every executor sees through its operating system, otherwise None."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return place.toUri().getPath() if system.getUri().getScheme() == "file" else None


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and stays columnar so later readers prune. The files
    stay until ``release``, because a lazy result may still read them.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Partitions that the sums of a short pass are put together in: a pass yields few rows.
SUM_PARTITIONS = 16


#: Bytes of a row group of blocks; a reader holds few blocks of it at once, and a writer one group.
BLOCK_GROUP = 16 << 20
#: Blocks are large values: sizes are looked at after every row, not after the first hundred.
BLOCK_FILES = {
    "parquet.block.size": BLOCK_GROUP, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1,
    "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1, "parquet.enable.dictionary": "false",
}


def write_blocks(df: DataFrame, path: str) -> None:
    """Write rows that hold whole blocks in small row groups and pages; read them in a ``plain_session``."""
    df.write.options(**BLOCK_FILES).parquet(path)


def plain_session(spark: SparkSession, batch_rows: int) -> SparkSession:
    """A session for hundreds of short passes of one shape over rows that hold whole blocks: nothing is left to re-plan at run
    time, and the caller's settings stay as they are."""
    plain = spark.newSession()
    plain.conf.set("spark.sql.adaptive.enabled", "false")
    plain.conf.set("spark.sql.shuffle.partitions", str(min(SUM_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    plain.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    plain.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    # The reader decodes this many rows at once: its default of 4096 would be gigabytes of blocks.
    plain.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(batch_rows))
    return plain


def mark(spark: SparkSession) -> int:
    """How many intermediate folders exist now; ``release(spark, mark)`` removes the later ones."""
    return len(_WRITTEN.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, since: int = 0) -> int:
    """Delete the folders written after ``since``; call it once nothing lazy reads them any more."""
    paths = _WRITTEN.get(spark.sparkContext.applicationId, [])
    gone, paths[since:] = paths[since:], []
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in gone:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    return len(gone)


def checkpoint_trees(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder."""
    spark.sparkContext.setCheckpointDir(scratch_path(spark, "trees"))
