"""Session helpers: a tuned local session and materialised intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; on a cluster use the session the cluster gives."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("labelmill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors: spark.checkpoint.dir, or on local[N] a new one where that is unset (tests).

    A cluster without one is refused: a folder of one machine isn't seen by the others.
    """
    sc = spark.sparkContext
    given = sc.getConf().get("spark.checkpoint.dir")
    if given:
        return given.rstrip("/")
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return str(current.get()).rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="spark-labelmill-")
    sc.setCheckpointDir(f"file://{made}")
    return f"file://{made}"


def materialize(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage, survives the loss of executors and keeps the files compact. The files go
    when the driver's JVM ends, or by :func:`free`. ``compression``: the session's codec, unless given;
    for very long values ``zstd``, as snappy holds a value whole outside of the heap.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/labelmill-{uuid.uuid4().hex}"
    df.write.options(**{"compression": compression} if compression else {}).parquet(path)
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return spark.read.schema(df.schema).parquet(path)


def free(*tables: DataFrame | None) -> None:
    """Deletes the files of tables written by :func:`materialize` that nothing reads any more."""
    for df in tables:
        for file in df.inputFiles()[:1] if df is not None else []:
            folder = file.rsplit("/", 1)[0]
            if folder.rsplit("/", 1)[-1].startswith("labelmill-"):
                hpath = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                hpath.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
