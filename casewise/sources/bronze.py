"""Bronze documents: newline-delimited JSON under a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewise.schema import BRONZE_SCHEMA
from casewise.sources.commits import whole_batches

# The parser fills this reserved name; a stored column must not be called so, or it
# reads back as null.
_PARSER_CORRUPT = "_corrupt_record"
RAW_LINE = "raw_line"
# The text of a line of which a part could not be read, beside what could.
PARTLY_READ = "partly_read"


def _parse_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_PARSER_CORRUPT, T.StringType())])


def _verdict(parsed: DataFrame, schema: T.StructType, suspicious: Column, line: str) -> DataFrame:
    """The fields, and the line's text where no field of it could be read.

    A document with a field of the wrong type stays one, with that field null and the
    line's text beside it, so that nothing is lost unseen.
    """
    readable = F.coalesce(*(F.when(F.col(n).isNotNull(), True) for n in schema.fieldNames()))
    broken = suspicious & readable.isNull()
    return parsed.select(
        *schema.fieldNames(),
        F.when(broken, F.col(line)).alias(RAW_LINE),
        F.when(suspicious & ~broken, F.col(line)).alias(PARTLY_READ),
    )


def read_bronze(
    spark: SparkSession, paths: str | list[str], schema: T.StructType = BRONZE_SCHEMA
) -> DataFrame:
    """Scan documents, plain or compressed, with the line kept where it is broken.

    Files are taken at any depth, so folders of different layouts (landed batches and
    landed streams) can be read together, and an ``ingest_date=`` folder adds no column.
    Name such a folder as the path to read one date. Blank lines give no rows. Of a folder
    that streams land in, only whole batches are read; a part of such a folder is read as it is.
    """
    named = [paths] if isinstance(paths, str) else paths
    folders = [place for path in named for place in whole_batches(spark, path)]
    if not folders:
        scan = spark.createDataFrame([], _parse_schema(schema))
    else:
        reader = spark.read.schema(_parse_schema(schema)).option("recursiveFileLookup", True)
        scan = reader.json(folders)
    return _verdict(scan, schema, F.col(_PARSER_CORRUPT).isNotNull(), _PARSER_CORRUPT)


def decode_lines(lines: DataFrame, schema: T.StructType = BRONZE_SCHEMA) -> DataFrame:
    """What ``read_bronze`` does, for a stream of lines in a ``value`` column."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _PARSER_CORRUPT}
    parsed = F.from_json("value", _parse_schema(schema), options).alias("_parsed")
    fields = (F.col(f"_parsed.{name}").alias(name) for name in schema.fieldNames())
    suspicious = F.col("_parsed").isNull() | F.col(f"_parsed.{_PARSER_CORRUPT}").isNotNull()
    decoded = (
        lines.filter(F.trim("value") != "")
        .select("value", parsed)
        .select(*fields, F.col("value").alias("_line"), suspicious.alias("_suspicious"))
    )
    return _verdict(decoded, schema, F.col("_suspicious"), "_line")


def split_corrupt(scan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, broken lines) of a scan; every scanned line is in one of the two."""
    broken = F.col(RAW_LINE).isNotNull()
    return scan.filter(~broken).drop(RAW_LINE, PARTLY_READ), scan.filter(broken).select(RAW_LINE)


def lost_lines(scan: DataFrame) -> DataFrame:
    """The text of every line that could not be read, or not as a whole."""
    line = F.coalesce(RAW_LINE, PARTLY_READ)
    return scan.filter(line.isNotNull()).select(line.alias(RAW_LINE))


def union_bronze(*parts: DataFrame) -> DataFrame:
    """Batch and streamed documents together; a field only one side has is null."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    return first
