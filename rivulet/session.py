"""Session helpers shared by the operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that removes a query's shuffle files when the query ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "rivulet", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; anything in ``conf`` wins."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        "spark.sql.variant.allowDuplicateKeys": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def last_key_wins(df: DataFrame) -> DataFrame:
    """Let the last of repeated keys win in maps and in parsed JSON, where Spark would raise by default."""
    df.sparkSession.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return df


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` as the cluster names it.

    Where the session names none (local tests) a fresh temporary folder is chosen once and set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="rivulet-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_folder(spark), "rivulet", f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` computed once into a parquet table in the shared folder, and read back from there.

    For a costly result that an operator reads several times; it also cuts the lineage. The shuffle files of the query
    go with its end (from Spark 4.1 on; before, the setting has no effect): what is read from now on is the table.
    """
    path, conf = work_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(FREE_SHUFFLES, None)
    conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(FREE_SHUFFLES)
        else:
            conf.set(FREE_SHUFFLES, before)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`written` returned and that nothing reads any more."""
    for table in tables:
        delete_path(table.sparkSession, table.written_to, recursive=True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whichever file system its scheme names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and authority of its file system, in the one form used for every spelling of it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop_path).toString()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; empty when it does not exist."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def is_directory(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is an existing directory."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path) and fs.getFileStatus(hadoop_path).isDirectory()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small text file (an XSD, say) to a shared path."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.create(hadoop_path, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The text of one small file."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file to a name that must be new; False where it is taken."""
    jvm = spark._jvm
    source_path, target_path = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    conf = spark._jsc.hadoopConfiguration()
    # FileContext, since FileSystem.rename silently replaces an existing file on some file systems
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source_path.getFileSystem(conf).getUri(), conf)
    no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(source_path, target_path, no_options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def delete_path(spark: SparkSession, path: str, recursive: bool = False) -> bool:
    """Delete one file, or with ``recursive`` a folder; True when it was there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, recursive)
