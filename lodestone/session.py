"""Session, table and stage helpers shared by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lodestone", cores: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks; a cluster supplies its own."""
    cores = cores or os.cpu_count() or 4
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LODESTONE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage_folder(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. Only a local session, as in tests, may do without it and gets a temporary one."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.lodestone.stage.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lodestone-stage-")
        atexit.register(shutil.rmtree, folder, True)
        folder = "file://" + folder
        spark.conf.set("spark.lodestone.stage.dir", folder)
    return folder


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write df as a table in the shared folder and read it back.

    This cuts the lineage at a durable copy: a lost executor only repeats the
    tasks after the table, and the plan before it runs once however often the
    result is used. The shuffle files of the finished job are let go, so that
    a query of many stages holds those of one stage at a time.
    """
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    spark.sparkContext._jvm.System.gc()  # Spark's cleaner removes the shuffle files of plans that are gone
    return spark.read.schema(df.schema).parquet(path)


def release(*staged: DataFrame) -> None:
    """Delete staged tables that no frame still to be computed reads."""
    for df in staged:
        for file in df.inputFiles()[:1]:
            path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def unused_name(base: str, *frames: DataFrame) -> str:
    """base, lengthened until no frame has a column of that name (case does not count)."""
    taken = {c.lower() for f in frames for c in f.columns}
    while base.lower() in taken:
        base += "_"
    return base


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
