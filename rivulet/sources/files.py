"""Directories of files as rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.routing import failing, with_route
from ..session import delete_path, path_exists, qualified

# File name endings of the compression codecs that are undone, and the route and reason of a missing directory.
CODEC_ENDINGS = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst")
MISSING, NO_DIRECTORY = "comms.failure", "dir_does_not_exist"


def _plain_name(name: Column) -> Column:
    pattern = "(" + "|".join(ending.replace(".", r"\.") for ending in CODEC_ENDINGS) + ")$"
    return F.regexp_replace(name, pattern, "")


def _normal(path: Column) -> Column:
    """A local path without its scheme, any other with scheme and authority; no trailing slashes."""
    return F.regexp_replace(F.regexp_replace(path, r"^file:/*(?=/)", ""), r"(?<=.)/+$", "")


def _full_path() -> Column:
    return F.url_decode(F.replace(F.col("file_path"), F.lit("+"), F.lit("%2B")))


def _base_name() -> Column:
    return F.regexp_extract(_full_path(), r"[^/]*$", 0)


def _location() -> list[Column]:
    """``path`` and ``source_file`` from the reader's metadata, whose paths are URL-encoded."""
    full = _full_path()
    return [_normal(F.regexp_replace(full, r"/[^/]*$", "")).alias("path"), full.alias("source_file")]


def _unpacked(content: Column | str, ending: Column) -> Column:
    """Decompressed content, or what is wrong with it. Everything is defined inside, to travel to the workers by value."""

    def unpack(contents: pa.Array, endings: pa.Array) -> pa.Array:
        import bz2
        import gzip
        import io
        import zlib

        def framed(codec: str, data: bytes) -> bytes:
            # blocks of several chunks: the size of the block, then size and data of each chunk, sizes in four bytes
            out, at = [], 0
            while at < len(data):
                left, at = int.from_bytes(data[at : at + 4], "big"), at + 4
                while left > 0:
                    size, at = int.from_bytes(data[at : at + 4], "big"), at + 4
                    if at + size > len(data):
                        raise ValueError("the file ends within a block")
                    made = pa.Codec(codec).decompress(data[at : at + size], decompressed_size=left, asbytes=True)
                    out.append(made)
                    left, at = left - len(made), at + size
            return b"".join(out)

        def zstd(data: bytes) -> bytes:
            with pa.CompressedInputStream(pa.BufferReader(data), "zstd") as stream:
                return stream.read()

        readers = {
            ".gz": gzip.decompress, ".bz2": bz2.decompress, ".deflate": zlib.decompress, ".zst": zstd,
            ".lz4": lambda data: framed("lz4_raw", data), ".snappy": lambda data: framed("snappy", data),
        }
        found, errors = [], []
        for content, ending in zip(contents.to_pylist(), endings.to_pylist()):
            try:
                found.append(readers[ending](content) if ending else content)
                errors.append(None)
            except Exception as error:  # whatever a broken file leads to is that file's failure
                found.append(None)
                errors.append(f"{type(error).__name__}: {error}")
        return pa.StructArray.from_arrays([pa.array(found, pa.binary()), pa.array(errors, pa.string())], names=["content", "error"])

    return F.arrow_udf(unpack, "struct<content: binary, error: string>")(content, ending)


def read_files(spark: SparkSession, directories: list[str], as_binary: bool = False) -> DataFrame:
    """One row per file directly inside the directories: ``path``, ``filename``, ``source_file``, ``content``, ``error``.

    Compressed text is decompressed file by file; one that cannot be has no content and an ``error``. Bytes that are no
    UTF-8 become replacement characters.
    """
    files = spark.read.format("binaryFile").load(directories).select("content", "_metadata.*")
    name, error, content = _base_name(), F.lit(None).cast("string"), F.col("content")
    if not as_binary:
        pattern = "(" + "|".join(ending.replace(".", r"\.") for ending in CODEC_ENDINGS) + ")$"
        ending = F.regexp_extract(name, pattern, 1)
        files = files.select("*", _unpacked("content", ending).alias("_rv_got"))
        error, content = F.col("_rv_got.error"), F.make_valid_utf8(F.col("_rv_got.content").cast("string"))
        name = _plain_name(name)
    return files.select(*_location(), name.alias("filename"), _base_name().alias("_rv_file"), content.alias("content"), error.alias("error"))


def ingest_files(
    spark: SparkSession,
    dirs_df: DataFrame,
    directory: str = "directory",
    *,
    regex: str | None = None,
    as_binary: bool = False,
    emit_original: bool = True,
) -> DataFrame:
    """For each input row naming a directory, one row per file in it (not in sub-directories).

    ``regex`` must match the whole file name. Compressed text is decompressed and loses its codec ending.
    Names that start with a dot or underscore are skipped. Routes: ``success``, ``original``, ``failure`` for a file that
    cannot be decompressed, and ``comms.failure`` for a missing directory. Remove sources afterwards with :func:`remove_sources`.
    """
    # Directory names are configuration-sized; each is checked on the file system once.
    names = [r[0] for r in dirs_df.select(F.col(directory)).distinct().toLocalIterator()]
    places = {name: qualified(spark, name) for name in names if name and path_exists(spark, name)}
    found = sorted(set(places.values()))
    parents = dirs_df.drop("content")
    known = spark.createDataFrame(list(places.items()), "_rv_dir string, _rv_place string")
    with_dir = parents.join(known, parents[directory] == known["_rv_dir"], "left")
    present = with_dir.filter("_rv_dir is not null").drop("_rv_dir")
    missing = with_dir.filter("_rv_dir is null").drop("_rv_dir", "_rv_place")
    out = with_route(missing, MISSING, F.lit(NO_DIRECTORY))
    if emit_original:
        out = out.unionByName(with_route(present.drop("_rv_place"), "original"))
    if not found:
        return out.withColumns({c: F.lit(None).cast("string") for c in ("filename", "source_file", "path", "content")})
    files = read_files(spark, found, as_binary)
    if regex:
        files = files.filter(F.col("_rv_file").rlike(f"^(?:{regex})$"))
    files = files.drop("_rv_file").withColumnRenamed("error", "_rv_error")
    joined = present.join(files, _normal(present["_rv_place"]) == files["path"], "inner").drop("_rv_place")
    reason = F.when(
        F.col("_rv_error").isNotNull(), F.concat(F.lit("cannot read "), F.col("source_file"), F.lit(": "), F.col("_rv_error"))
    )
    return out.unionByName(failing(joined, reason).drop("_rv_error"), allowMissingColumns=True)


def remove_sources(spark: SparkSession, ingested: DataFrame) -> int:
    """Delete the source files of rows that were ingested and safely stored; returns how many went."""
    names = ingested.filter("route = 'success'").select("source_file").distinct()
    return sum(delete_path(spark, r[0]) for r in names.toLocalIterator())


def stream_files(
    spark: SparkSession, directory: str, *, regex: str | None = None, keep_source: bool = True, archive: str | None = None
) -> DataFrame:
    """The same rows as a stream of newly arriving files; ``keep_source=False`` deletes files once processed."""
    reader = spark.readStream
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    elif not keep_source:
        reader = reader.option("cleanSource", "delete")
    files = reader.text(directory, wholetext=True).select(F.col("value").alias("content"), "_metadata.file_path")
    if regex:
        files = files.filter(_base_name().rlike(f"^(?:{regex})$"))
    return with_route(
        files.select(
            *_location(),
            _plain_name(_base_name()).alias("filename"),
            "content",
        ),
        "success",
    )
