"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a batch of rows that a Python worker gets at once, so that long texts don't fill it.
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers of every executor, once per Spark context.

    Also turns off a planner setting of Spark 4.1 that lets a union pass its inputs' partitioning on: joins above such
    a union lost rows or failed with "Can't zip RDDs with unequal numbers of partitions" while these operators were
    written. No small case that shows it is known, so no test does; the setting only costs a shuffle.
    """
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if not getattr(context, "_tidemark_shipped", False):
        root = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="tidemark-")) / "tidemark_package.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        context.addPyFile(str(target))
        context._tidemark_shipped = True
        if context.master.startswith("local"):
            shared_base(spark)
    return spark


def shared_base(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Only a local session may do without: it gets a temporary one, once per context."""
    base = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark.sparkContext, "_tidemark_base", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = spark.sparkContext._tidemark_base = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(base)
    return base


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: what reads it several times skips the columns and rows that it does not need."""
    path = f"{shared_base(df.sparkSession).rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    conf = {
        "spark.master": f"local[{cores}]", "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(partitions), "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true",
    }
    spark = SparkSession.builder.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
