"""The folder that driver and executors share, and tables written to it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`, else (tests on one machine) a local folder."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"/tmp/checkpoints/{sc.applicationId}"


def new_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under this application's own folder, which goes when the application ends."""
    own = f"{work_dir(spark)}/tables-{spark.sparkContext.applicationId}"
    where = spark._jvm.org.apache.hadoop.fs.Path(own)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        fs.mkdirs(where)
        fs.deleteOnExit(where)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def spread(frame: DataFrame) -> DataFrame:
    """`frame` dealt evenly, so that heavy work on each row doesn't hang on the few files or row groups that hold it."""
    return frame.repartition(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))


#: Bytes of input files to a slice of work, and the least number of slices worth dealing.
SLICE, FEW = 4 << 20, 32


def slices(*frames: DataFrame) -> int:
    """The number of slices by which the input files of `frames` are cut; 0 if they are few, and for what comes from no files."""
    spark, total = frames[0].sparkSession, 0
    for file in {f for frame in frames for f in frame.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))
        total += where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).getLen()
    n = -(-total // SLICE)
    return n if n >= FEW else 0


def dealt(n: int, frame: DataFrame, *keys: str) -> DataFrame:
    """`frame` in `n` partitions by the hash of `keys`; as it is if `n` is 0.

    Narrow rows compress well, so partitions that adaptive execution merges by their shuffled bytes may
    hold millions of rows, and a task sorts or groups them all.  It leaves a number that is given alone.
    """
    return frame.repartition(n, *keys) if n else frame


def join_dealt(n: int, left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """The inner join by equal `on`, in `n` tasks if that is not 0."""
    return dealt(n, left, *on).join(dealt(n, right, *on), on)


def drop_written(frame: DataFrame) -> None:
    """Delete a table made by `written` that nothing reads any more."""
    spark = frame.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(file)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def written(frame: DataFrame, name: str) -> DataFrame:
    """`frame`, written once to the shared folder and read back: later uses see the same rows, also after a lost executor."""
    path = new_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
