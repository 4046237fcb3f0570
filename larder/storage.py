"""Where intermediate tables go, and the few file operations that jobs need on the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local session that names none uses a folder in its warehouse, which is then set as its
    ``spark.checkpoint.dir``.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if shared:
        return shared.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        own = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/larder-work"
        spark.conf.set("spark.checkpoint.dir", own)
        return own
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of a few fixed rows whose size the planner knows: what is joined with it need not be shuffled.

    Rows from a list alone come to the plan as a table of unknown size, which counts as very large.
    """
    held = spark.createDataFrame(rows, schema)
    return spark.createDataFrame(held.toArrow(), held.schema)


#: Folders that this process wrote to the work folder and that ``remove_staged`` takes away.
_staged: list[str] = []


def fresh_folder(spark: SparkSession, what: str) -> str:
    """A new name in the work folder; ``remove_staged`` removes what is written there."""
    path = f"{work_folder(spark)}/{what}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


def staged(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the work folder and read back: its readers do not compute it again, nor does a lost
    executor make them."""
    path = fresh_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_staged(spark: SparkSession) -> None:
    """Remove all staged tables of this process; call it when their results are no longer read."""
    while _staged:
        delete(spark, _staged.pop())


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    files, target = _file_system(spark, path)
    files.delete(target, True)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes below a folder."""
    files, target = _file_system(spark, path)
    return files.getContentSummary(target).getLength()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; none if it does not exist."""
    files, target = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears under its name only when it is whole."""
    files, target = _file_system(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    out = files.create(part, False)
    out.write(bytearray(text.encode()))
    out.close()
    if files.exists(target) or not files.rename(part, target):
        files.delete(part, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]
