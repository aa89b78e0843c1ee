"""Ownership of intermediate tables."""

import os
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark import session


class Other:
    """A session of a cluster without a shared folder, as far as ``shared_folder`` looks."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"
        getConf = staticmethod(dict)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Other)
    assert session.is_single_machine("local[8]") and not session.is_single_machine("local-cluster[2,1,512]")


def test_release_leaves_nothing_behind(spark):
    start = session.mark(spark)
    df = session.materialize(spark.range(5).toDF("n"), "kept")
    folder = session._WRITTEN[spark.sparkContext.applicationId][start].removeprefix("file://")
    assert df.count() == 5 and os.path.isdir(folder)
    assert session.release(spark, start) == 1 and not os.path.exists(folder)


def test_blocks_are_written_and_read_a_few_at_a_time(spark, tmp_path):
    path = f"{tmp_path}/blocks"
    rows = spark.range(0, 120, 1, 1).select(F.expr("randstr(400000, 7)").cast("binary").alias("x"))
    session.write_blocks(rows, path)
    part, = Path(path).glob("*.parquet")
    found = pq.ParquetFile(part).metadata
    assert max(found.row_group(i).total_byte_size for i in range(found.num_row_groups)) < 2 * session.BLOCK_GROUP
    plain = session.plain_session(spark, 8)
    assert plain.conf.get("spark.sql.parquet.columnarReaderBatchSize") == "8"
    assert plain.read.parquet(path).count() == 120
