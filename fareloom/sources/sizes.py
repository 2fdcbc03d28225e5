"""Expanded size of compressed files."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CODECS = {".gz": "gzip", ".bz2": "bz2", ".zst": "zstd", ".lz4": "lz4"}
_READ_BYTES = 1 << 20


def _measurer():
    """Adds the bytes of each file's content, read piece by piece and thrown away; a suffix tells how it is compressed."""

    def expanded_bytes(path: str) -> int:
        if path.startswith("file:"):
            system, place = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
        else:
            # A listed path is spelled as it is, a URI has no blanks.
            system, place = fs.FileSystem.from_uri(quote(path, safe=":/@"))
        codec = next((codec for suffix, codec in _CODECS.items() if place.endswith(suffix)), None)
        if not system.get_file_info(place).size:
            return 0
        total = 0
        with system.open_input_stream(place, compression=codec) as stream:
            while piece := stream.read(_READ_BYTES):
                total += len(piece)
        return total

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [expanded_bytes(path) for path in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("file_name"), pa.array(sizes, pa.int64())], ["file_name", "bytes"])

    return run


def expanded_sizes(spark: SparkSession, paths: str | list[str], group: Column | None = None) -> DataFrame:
    """Uncompressed bytes, and MiB to one decimal, by file (or by an expression over ``_metadata``).

    Exact for any content: bytes are counted, not lines. The files are listed as for any scan, tasks open them
    through Arrow's file systems and hold a piece of one at a time.
    """
    # A scan would leave out files of no bytes, so what the planner has listed is taken as a table.
    as_path, as_uri = spark._jvm.org.apache.hadoop.fs.Path, spark._jvm.java.net.URI
    found = [as_path(as_uri(path)).toString() for path in spark.read.format("binaryFile").load(paths).inputFiles()]
    files = spark.createDataFrame([(path, path.rpartition("/")[2]) for path in found], "file_path string, file_name string")
    described = files.select(F.struct("file_path", "file_name").alias("_metadata"))
    name = F.col("_metadata.file_name") if group is None else group
    listed = described.select(F.col("_metadata.file_path").alias("path"), name.alias("file_name"))
    # Not by hash, which would deal some tasks several large files and others none.
    dealt = listed.repartition(max(1, len(found)))
    measured = dealt.mapInArrow(_measurer(), "file_name string, bytes bigint")
    if group is not None:
        measured = measured.groupBy("file_name").agg(F.sum("bytes").alias("bytes"))
    return measured.select("file_name", "bytes", F.round(F.col("bytes") / F.lit(1024 * 1024), 1).alias("mib"))
