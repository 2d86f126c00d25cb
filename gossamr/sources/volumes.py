"""Loose files and ZIP volumes of pages."""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gossamr.session import materialize, ship, sized

_MEMBERS = T.StructType([T.StructField("volume_id", T.LongType()), T.StructField("url_id", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("body", T.BinaryType()), T.StructField("siz", T.LongType())])


def read_loose(spark: SparkSession, root: str, schema: str | None = None, alternative: str | None = None) -> DataFrame:
    """(url_id, kind, body, siz) of loose files: kind is "" for a body, h for headers. Sizes alone read no bytes."""
    path = "/".join(x for x in (root.rstrip("/"), "tmp", schema, alternative, "*") if x)
    name = F.regexp_extract("path", r"([0-9]+)(h?)$", 1)
    files = spark.read.format("binaryFile").load(path)
    return files.select(name.cast("long").alias("url_id"), F.regexp_extract("path", r"([0-9]+)(h?)$", 2).alias("kind"), F.col("content").alias("body"), F.col("length").alias("siz"))


#: Bytes of members that a batch holds before it is passed on.
BATCH = 4 << 20
#: Fixed by the ZIP format: signatures of a member's header, of its entry in the directory, and of the end; the method
#: for deflated data, the version that needs, and 1980-01-01 as a date.
LOCAL, ENTRY, END, DEFLATED, VERSION, DATE = 0x04034B50, 0x02014B50, 0x06054B50, 8, 20, 33


def _members(volumes: Iterator[tuple[int, pa.Scalar]]) -> Iterator[pa.RecordBatch]:
    """The members of archives, in batches of some bytes."""
    rows, size = [], 0

    def pack() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=_MEMBERS.names)

    for volume, content in volumes:
        with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive:
            for info in archive.infolist():
                body = archive.read(info)
                rows.append((volume, int(info.filename.removesuffix("h")), "h" if info.filename.endswith("h") else "", body, info.file_size))
                size += len(body)
                if size >= BATCH:
                    yield pack()
                    rows, size = [], 0
    if rows:
        yield pack()


def read_volumes(spark: SparkSession, root: str, schema: str | None = None) -> DataFrame:
    """(volume_id, url_id, kind, body, siz) of the members of data/[schema/]<volume>.zip; one file at a time in memory."""
    path = "/".join(x for x in (root.rstrip("/"), "data", schema, "*.zip") if x)

    def run(batches):
        for batch in batches:
            yield from _members((int(p.rsplit("/", 1)[-1].removesuffix(".zip")), c) for p, c in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True))

    ship(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _MEMBERS)


def deflate(members: DataFrame) -> DataFrame:
    """members (volume_id, url_id, kind, body) with name, crc, raw (bytes before) and data (deflated) in place of body: a
    pass over rows, which needs no other member of a volume.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                body = batch.column("body")[i].as_py() or b""
                packer = zlib.compressobj(6, zlib.DEFLATED, -15)
                rows.append((zlib.crc32(body), len(body), packer.compress(body) + packer.flush()))
            made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else ([], [], []), (pa.int64(), pa.int64(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("volume_id", "url_id", "kind", "name")] + made, names=["volume_id", "url_id", "kind", "name", "crc", "raw", "data"])

    rows = members.select(F.col("volume_id").cast("long"), F.col("url_id").cast("long"), "kind", F.concat(F.col("url_id").cast("string"), "kind").alias("name"), F.col("body").cast("binary").alias("body"))
    ship(members.sparkSession)
    return rows.mapInArrow(run, "volume_id long, url_id long, kind string, name string, crc long, raw long, data binary")


def zip_volumes(members: DataFrame) -> DataFrame:
    """(volume_id, archive) of members (volume_id, url_id, kind, body): one ZIP file each, of up to 2 GB.

    Members are deflated where they are; what a volume's task gets are deflated members in order, to which it puts their
    headers and the directory, one member after the other. A volume fits in memory by its threshold.
    """

    def run(batches):
        volume, held, entries, n = None, io.BytesIO(), io.BytesIO(), 0

        def closed() -> pa.RecordBatch:
            at, size = held.tell(), entries.tell()
            held.write(entries.getbuffer())
            held.write(struct.pack("<IHHHHIIH", END, 0, 0, min(n, 0xFFFF), min(n, 0xFFFF), size, at, 0))
            if n > 0xFFFF or at + size > 0x7FFFFFFF:
                raise ValueError(f"volume {volume} is too large for an archive")
            return pa.RecordBatch.from_arrays([pa.array([volume], pa.int64()), pa.array([held.getbuffer()], pa.binary())], names=["volume_id", "archive"])

        for batch in batches:
            for own, name, crc, raw, data in zip(batch.column("volume_id").to_pylist(), batch.column("name").to_pylist(), batch.column("crc").to_pylist(), batch.column("raw").to_pylist(), batch.column("data"), strict=True):
                if n and own != volume:
                    yield closed()
                    held, entries, n = io.BytesIO(), io.BytesIO(), 0
                volume, data, label = own, data.as_buffer(), name.encode()
                common = struct.pack("<HHHHHIIIHH", VERSION, 0, DEFLATED, 0, DATE, crc, data.size, raw, len(label), 0)
                entries.write(struct.pack("<IH", ENTRY, VERSION) + common + struct.pack("<HHHII", 0, 0, 0, 0, held.tell()) + label)
                held.write(struct.pack("<I", LOCAL) + common + label)
                held.write(data)
                n += 1
        if n:
            yield closed()

    rows = deflate(members).repartition("volume_id").sortWithinPartitions("volume_id", "url_id", "kind")
    return rows.select("volume_id", "name", "crc", "raw", "data").mapInArrow(run, "volume_id long, archive binary")


def members_of(archives: DataFrame) -> DataFrame:
    """(volume_id, url_id, kind, body, siz) of archives (volume_id, archive)."""

    def run(batches):
        for batch in batches:
            yield from _members(zip(batch.column("volume_id").to_pylist(), batch.column("archive"), strict=True))

    ship(archives.sparkSession)
    return archives.select("volume_id", "archive").mapInArrow(run, _MEMBERS)


def purge_volumes(archives: DataFrame, content: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """archives (volume_id, archive) without the members of the URLs ids (id), and (volume_id) of those left empty, that go.

    Only archives that content (url_id, volume_id) names for one of the ids are read and written again.
    """
    gone = ids.select(F.col("id").alias("url_id")).distinct()
    hit = materialize(content.join(gone, "url_id", "left_semi").select("volume_id").distinct(), "purged-volumes")
    kept = members_of(archives.join(sized(hit), "volume_id", "left_semi")).join(sized(gone), "url_id", "left_anti")
    made = materialize(zip_volumes(kept), "purged-archives")
    whole = archives.join(sized(hit), "volume_id", "left_anti").select("volume_id", "archive")
    return whole.unionByName(made.select("volume_id", "archive")), hit.join(made.select("volume_id"), "volume_id", "left_anti")
