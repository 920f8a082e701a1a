"""Folders of tables, on whatever file system a path names."""

from pyspark.sql import SparkSession


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder is there, on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path is a folder, on whatever file system it is."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(target) and files.getFileStatus(target).isDirectory()


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder and those above it; nothing happens if it is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of ours; nothing happens if it is not there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """The names of the files in a folder; none if it is not there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in files.listStatus(target)] if files.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(target)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that is there whole or not at all."""
    jvm = spark.sparkContext._jvm
    target, part = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = files.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not files.rename(part, target):
        raise OSError(f"could not put {path} in place")
