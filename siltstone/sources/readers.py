"""JSON-lines, CSV points, stop words and streams."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import present
from ..session import written
from . import schemas

_BAD = "_not_json"


def _fields(schema: str) -> list[str]:
    return T.StructType.fromDDL(schema).fieldNames()


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of JSON lines; blank lines and lines that are no JSON are dropped.

    :func:`count_bad_json` counts the latter. A value of another type than the schema's is null.
    """
    return parse_json_lines(spark.read.text(path), schema)


def count_bad_json(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are no JSON, per file."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))
    bad = lines.filter((F.trim("value") != "") & F.try_parse_json("value").isNull())
    return bad.groupBy("file").agg(F.count(F.lit(1)).alias("n_bad"))


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.REVIEW)


def read_businesses(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.BUSINESS)


def parse_points(lines: DataFrame, dimensions: int | None = None) -> DataFrame:
    """``value`` lines ``id,x1,x2,...`` to ``(id, vec)``; the other columns stay.

    Lines that are not an id and numbers, or not ``dimensions`` numbers, are dropped. The test is
    part of the generator, so that a line is parsed once.
    """
    kept = [c for c in lines.columns if c != "value"]
    return lines.select(F.inline(_readable(dimensions)), *kept)


def _readable(dimensions: int | None) -> Column:
    """An array with the parsed line, empty if the line is no point."""

    def point(parts: Column) -> Column:
        vec = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
        return F.struct(
            parts[0].try_cast("bigint").alias("id"), vec.try_cast("array<double>").alias("vec")
        )

    def is_point(found: Column) -> Column:
        numbers = F.size(F.array_compact(found["vec"]))
        return (
            found["id"].isNotNull()
            & (numbers > 0)
            & (numbers == F.size(found["vec"]))
            & (F.lit(True) if dimensions is None else numbers == dimensions)
            & ~F.array_contains(found["vec"], F.lit(float("nan")))
        )

    return F.filter(F.transform(F.array(F.split("value", ",")), point), is_point)


def read_points(spark: SparkSession, path: str, dimensions: int | None = None) -> DataFrame:
    """``(id, vec, chunk)`` from a directory of CSV files; the chunk is the file name.

    Unreadable lines, and with ``dimensions`` those of another length, are dropped;
    :func:`count_bad_points` counts them. :func:`point_files` lists the chunks without a scan.
    """
    return parse_points(_point_lines(spark, path), dimensions)


def point_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files of a directory, in order, from its listing."""
    names = (unquote(file.rsplit("/", 1)[-1]) for file in spark.read.text(path).inputFiles())
    return sorted(names)


def count_bad_points(spark: SparkSession, path: str, dimensions: int | None = None) -> DataFrame:
    """Dropped lines per file."""
    bad = _point_lines(spark, path).filter(F.size(_readable(dimensions)) == 0)
    return bad.groupBy("chunk").agg(F.count(F.lit(1)).alias("n_bad"))


def _point_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("chunk"))
    return lines.filter(F.trim("value") != "")


def unique_points(points: DataFrame) -> DataFrame:
    """One row per id ``(id, vec, chunk)``, for inputs whose ids repeat: that of the last chunk.

    Within a chunk a hash of the vector decides. The rows are written, so every later pass sees the
    same ones.
    """
    last = F.max_by(F.struct("vec", "chunk"), F.struct("chunk", F.xxhash64("vec"), F.to_json("vec")))
    return written(points.groupBy("id").agg(last.alias("last")).select("id", "last.*"), "unique-points")


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """One trimmed word per line."""
    word = F.btrim(F.col("value"), F.lit(" \t\r\n\f\x0b")).alias("word")
    return spark.read.text(path).select(word).filter(present(F.col("word")))


def stream_json(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    """Stream of JSON-lines files that arrive in ``path``."""
    return spark.readStream.schema(schema).options(**options).json(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Stream of text lines from a socket, with the arrival time as ``ts``."""
    source = spark.readStream.format("socket").option("host", host).option("port", port)
    return source.option("includeTimestamp", True).load().withColumnRenamed("timestamp", "ts")


def parse_json_lines(lines: DataFrame, schema: str) -> DataFrame:
    """Parse ``value``; the other columns stay. Works on batch and streaming frames.

    Lines that are no JSON are dropped. Only a line that doesn't fit the schema is parsed twice.
    """
    kept = [c for c in lines.columns if c != "value"]
    whole = f"{schema}, {_BAD} string"
    row = F.from_json("value", whole, {"columnNameOfCorruptRecord": _BAD}).alias("_row")
    names = [name for name in _fields(schema)]
    fits = F.col(f"_row.{_BAD}").isNull() | F.try_parse_json("value").isNotNull()
    return (
        lines.select(*kept, "value", row)
        .filter(F.col("_row").isNotNull() & fits)
        .select(*kept, *[F.col(f"_row.`{name}`").alias(name) for name in names])
    )
