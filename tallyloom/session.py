"""Session settings and the shared scratch folder."""

import tempfile
import uuid
from urllib.parse import urlsplit

import pyarrow
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

_own_folders: dict[str, str] = {}


def local_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A single-node session for tests and benchmarks; clusters bring their own."""
    parallel = 8 if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(parallel))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="tallyloom-")
    return _own_folders[app]


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path not used before under the shared folder, which is scratch to be emptied later."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def mounted(spark: SparkSession, path: str) -> str | None:
    """A folder's plain path if it is of the file system that all machines have mounted, else None."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    url = urlsplit(path if urlsplit(path).scheme else default.rstrip("/") + path)
    return url.path if url.scheme == "file" else None


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here.

    Partition-dependent columns are fixed by the write, and lost executors
    are served from the files.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, by: str) -> DataFrame:
    """All rows of a value of ``by`` in one task, over as many tasks as a shuffle or the cores have.

    For writing a file for each value, whose cost is that of the file, not of its rows: a small
    table is read by one task, and a shuffle without a number is coalesced by its bytes.
    """
    spark = df.sparkSession
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(shuffled, spark.sparkContext.defaultParallelism), by)


def small_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A table of a few known rows, held in the plan itself."""
    struct = StructType.fromDDL(schema)
    return spark.createDataFrame(
        pyarrow.Table.from_pylist(rows, to_arrow_schema(struct)), struct
    )
