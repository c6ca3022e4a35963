"""File sources: text tables, payload documents, encodings, archives, regions."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from velora.session import workers_find_package

ZIP = b"PK\x03\x04"
WORKBOOK = "xl/workbook.xml"


class EncodingMismatch(ValueError):
    """Too many bytes do not fit the encoding."""


def read_csv(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """All columns as text with a header row; empty fields are empty texts, quoted or not."""
    reader = spark.read.option("header", True)
    if columns:
        reader = reader.schema(StructType([StructField(c, StringType(), True) for c in columns]))
    return reader.csv(paths if isinstance(paths, str) else list(paths)).na.fill("")


def decode_lossy(raw: bytes, encoding: str = "euc-kr", most_lost: float = 0.01) -> str:
    """The text without the bytes that do not fit; too many of them are an error."""
    text = raw.decode(encoding, "ignore")
    lost = len(raw) - len(text.encode(encoding))
    if raw and lost / len(raw) > most_lost:
        raise EncodingMismatch(f"{lost} of {len(raw)} bytes are not {encoding}")
    return text


def read_encoded_lines(spark: SparkSession, path: str, encoding: str = "euc-kr", most_lost: float = 0.01) -> DataFrame:
    """``path, line`` of whole files in another encoding; each file is decoded where it is read."""

    def lines(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            for p, raw in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                text = decode_lossy(raw.as_py(), encoding, most_lost).splitlines()
                yield pa.RecordBatch.from_arrays([pa.array([p] * len(text), pa.string()), pa.array(text, pa.string())], names=["path", "line"])

    workers_find_package(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(lines, "path string, line string")


def archive_kind(head: bytes, names: Sequence[str] = ()) -> str:
    """By content, not by name: ``zip``, ``xlsx`` (a zip with a workbook) or ``plain``."""
    return ("xlsx" if WORKBOOK in names else "zip") if head.startswith(ZIP) else "plain"


def archive_members(raw: bytes) -> list[tuple[str, bytes]]:
    """The files of a zip in order of their names; a plain file or a workbook is no archive."""
    if archive_kind(raw[:4]) != "zip":
        return []
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        names = sorted(n for n in z.namelist() if not n.endswith("/"))
        return [] if archive_kind(raw[:4], names) == "xlsx" else [(n, z.read(n)) for n in names]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``path, member, content`` of all files in archives, unpacked where they are read."""

    def members(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            for p, raw in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                for name, content in archive_members(raw.as_py()):
                    yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([name]), pa.array([content], pa.binary())], names=["path", "member", "content"])

    workers_find_package(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(members, "path string, member string, content binary")


def input_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, member, bytes`` of all input files in order: plain files as they are, the members of archives one by one."""
    plain = spark.read.format("binaryFile").load(path).select("path", "length", F.substring("content", 1, 4).alias("head"))
    whole = plain.where(F.col("head") != F.lit(ZIP)).select("path", F.lit("").alias("member"), F.col("length").alias("bytes"))
    return whole.unionByName(read_archives(spark, path).select("path", "member", F.length("content").cast("long").alias("bytes"))).orderBy("path", "member")


def read_payload(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of a collected payload (``{"rows": [...]}``); keys that some rows lack are NULL there."""
    columns = schema if isinstance(schema, str) else schema.simpleString()[len("struct<") : -1]
    wrapped = f"rows array<struct<{columns}>>"
    return spark.read.schema(wrapped).option("multiLine", True).json(path).select(F.explode("rows").alias("r")).select("r.*")


def union_of_keys(rows: Sequence[dict]) -> list[str]:
    """All keys of ragged rows, in order of appearance."""
    return list(dict.fromkeys(k for r in rows for k in r))


def read_regions(spark: SparkSession, path: str, name: str = "name") -> DataFrame:
    """``name, seq, lon, lat`` of the outer ring of each region, the largest part of one in several parts."""
    features = spark.read.option("multiLine", True).schema("features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>").json(path)
    f = features.select(F.explode("features").alias("f")).select(F.col("f.properties")[name].alias("name"), "f.geometry.type", "f.geometry.coordinates")
    polygon = F.array(F.from_json("coordinates", "array<array<array<double>>>"))
    parts = F.when(F.col("type") == "MultiPolygon", F.from_json("coordinates", "array<array<array<array<double>>>>")).otherwise(polygon)
    rings = f.select("name", F.transform(parts, lambda p: p[0]).alias("rings"))
    largest = F.array_max(F.transform("rings", lambda r: F.struct(F.size(r).alias("n"), r.alias("ring"))))["ring"]
    return rings.select("name", F.posexplode(largest).alias("seq", "p")).select("name", "seq", F.col("p")[0].alias("lon"), F.col("p")[1].alias("lat"))


def read_mart_csv(spark: SparkSession, path: str, schema: StructType, list_columns: Sequence[str] = ()) -> DataFrame:
    """A mart from text: empty fields are NULL, list literals are arrays."""
    df = spark.read.option("header", True).option("nullValue", "").csv(path)
    typed = [(F.from_json(F.translate(F.col(f.name), "'", '"'), "array<string>") if f.name in list_columns else F.col(f.name).cast(f.dataType)).alias(f.name) for f in schema]
    return df.select(*typed)
