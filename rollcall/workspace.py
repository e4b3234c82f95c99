"""Where jobs keep checkpoints and intermediate tables.

On a cluster this is the shared folder named by ``spark.checkpoint.dir``: a lost executor, or a new
driver, finds everything again. A machine-local folder is only ever used in local mode.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {SETTING} to a folder every executor can reach")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"{application}-")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name for one run, so that no two runs share a checkpoint or a table."""
    return f"{shared_folder(spark)}/rollcall/{purpose}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this package has made; does nothing where it is gone."""
    system, place = _file_system(spark, path)
    system.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _file_system(spark, path)
    return system.exists(place)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes in a folder."""
    system, place = _file_system(spark, path)
    return system.getContentSummary(place).getLength()


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file where there is none; False where there is one."""
    system, place = _file_system(spark, path)
    try:
        out = system.create(place, False)
    except Exception as error:  # the JVM's, whose class differs between file systems
        if not system.exists(place):
            raise error
        return False
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    return True


def read_file(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None where there is none."""
    system, place = _file_system(spark, path)
    if not system.exists(place):
        return None
    source = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def file_names(spark: SparkSession, path: str) -> list[str]:
    """The names of the files in a folder."""
    system, place = _file_system(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place) if status.isFile())


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder."""
    system, place = _file_system(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place) if status.isDirectory())


def local_session(cpus: int | str = "*", **settings: str) -> SparkSession:
    """The session of tests and benchmarks on one machine. On a cluster, spark-submit configures it."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("rollcall")
    defaults = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    for name, value in {**defaults, **settings}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
