"""Counter files (nested XML) as DataFrames, in batch and as a file stream."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from countermill.functions.columns import ColumnLike, as_column
from countermill.functions.text import unescape_xml
from countermill.operators.ordering import carry_forward
from countermill.schemas import MDC_INFO, MDC_RECORD, MDC_RECORD_FULL, MEAS_DATA_RECORD

# Files per micro-batch of the stream: bounds the work of one trigger.
MAX_FILES_PER_TRIGGER = 3000

CORRUPT = "_corrupt_record"


def list_files(spark: SparkSession, folder: str, pattern: str = "*.xml") -> DataFrame:
    """Paths of all files with content below ``folder`` whose name matches; contents are not read.

    Spark's readers pass over files of zero bytes, so these are not listed here; :func:`found_files`
    lists them too.

    The path is written as in the ``source_file`` of a scan, so both join.
    """
    return _listed(spark, folder, pattern).select(F.col("_metadata.file_path").alias("path"))


def _listed(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.load(folder)


def scan_path(path: ColumnLike) -> Column:
    """A path of a file index or stream log, written as in the ``source_file`` of a scan."""
    return F.regexp_replace(as_column(path), "^file:///", "file:/")


def found_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, size, modified) of all files below ``folder`` whose name matches, empty ones too.

    Folders are listed by Spark, in tasks when there are many; no content is read. The scan
    gives size and time of files with content. Files of zero bytes stand only in the file
    index: they get size 0 and no time. Paths join with the ``source_file`` of a scan.
    """
    listed = _listed(spark, folder, pattern)
    index = spark.createDataFrame([(path,) for path in listed.inputFiles()], "path STRING")
    details = listed.select(
        F.col("_metadata.file_path").alias("path"), F.col("length").alias("_size"), F.col("modificationTime").alias("modified")
    )
    index = index.select(scan_path("path").alias("path"))
    return index.join(details, "path", "left").select("path", F.coalesce("_size", F.lit(0)).cast("bigint").alias("size"), "modified")


def _with_file(df: DataFrame) -> DataFrame:
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def _scan(spark: SparkSession, paths: str | Sequence[str], row_tag: str, schema: str, charset: str) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", row_tag).option("charset", charset).schema(schema)
    return _with_file(reader.load(paths if isinstance(paths, str) else list(paths)))


def _stream(spark: SparkSession, folder: str, row_tag: str, schema: str, charset: str, files: int) -> DataFrame:
    reader = (
        spark.readStream.format("xml")
        .option("rowTag", row_tag)
        .option("charset", charset)
        .option("maxFilesPerTrigger", files)
        .schema(schema)
    )
    return _with_file(reader.load(folder))


def scan_mdc(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    row_tag: str = "mdc",
    charset: str = "UTF-8",
    full: bool = False,
) -> DataFrame:
    """One row per ``mdc`` document, with its ``source_file``.

    ``full`` adds header, element and footer fields that no operator needs.
    """
    return _scan(spark, paths, row_tag, MDC_RECORD_FULL if full else MDC_RECORD, charset)


def scan_mdc_parts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per info block: source_file, nedn, part_pos and the block as ``info``.

    For very large documents. The XML source reads a document as one row in one
    task; here a file is split like any text file, at the end tags ``</mi>``, and
    every block is parsed by itself. A header holds for the blocks behind it in the
    file, up to the next one, as a file may have several documents. Needs ``<mi>`` tags without attributes.
    """
    text = spark.read.text(paths if isinstance(paths, str) else list(paths), lineSep="</mi>")
    parts = _with_file(text).select(
        "source_file",
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
    )
    sender = F.regexp_extract("value", r"<mfh>[\s\S]*?<sn>([^<]*)</sn>", 1)
    header = F.when(F.col("value").contains("<mfh>"), unescape_xml(sender))
    parts = carry_forward(parts, header, "nedn").withColumn("part_pos", F.struct("block", F.col("pos").alias("id")))
    block = F.concat(F.lit("<mi>"), F.substring_index("value", "<mi>", -1), F.lit("</mi>"))
    info = F.from_xml(block, MDC_INFO, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
    # Parsed once, as in _parse().
    blocks = parts.filter(F.col("value").contains("<mi>")).select("source_file", "nedn", "part_pos", F.inline(F.array(info)))
    return blocks.select("source_file", "part_pos", F.struct("mts", "gp", "mt", "mv").alias("info"), "nedn")


def scan_measdata(
    spark: SparkSession, paths: str | Sequence[str], *, row_tag: str = "measData", charset: str = "UTF-8"
) -> DataFrame:
    """One row per ``measData`` element, with its ``source_file``."""
    return _scan(spark, paths, row_tag, MEAS_DATA_RECORD, charset)


def stream_mdc(
    spark: SparkSession,
    folder: str,
    *,
    row_tag: str = "mdc",
    charset: str = "UTF-8",
    max_files: int = MAX_FILES_PER_TRIGGER,
) -> DataFrame:
    """The same rows as a stream that picks up only files it has not seen."""
    return _stream(spark, folder, row_tag, MDC_RECORD, charset, max_files)


def stream_measdata(
    spark: SparkSession,
    folder: str,
    *,
    row_tag: str = "measData",
    charset: str = "UTF-8",
    max_files: int = MAX_FILES_PER_TRIGGER,
) -> DataFrame:
    """Streaming form of :func:`scan_measdata`."""
    return _stream(spark, folder, row_tag, MEAS_DATA_RECORD, charset, max_files)


def _parse(df: DataFrame, text: str, schema: str, file: str) -> DataFrame:
    # The record goes through a generator so that it is parsed once: filters on
    # its fields cannot be pushed below, which would parse it again for each.
    options = {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}
    record = F.from_xml(F.col(text), schema, options)
    return df.select(F.col(file).alias("source_file"), F.inline(F.array(record)))


def parse_mdc_text(df: DataFrame, text: str, file: str) -> DataFrame:
    """``mdc`` documents held in a text column instead of files; ``file`` names them."""
    return _parse(df, text, MDC_RECORD, file)


def parse_measdata_text(df: DataFrame, text: str, file: str) -> DataFrame:
    """``measData`` documents held in a text column instead of files."""
    return _parse(df, text, MEAS_DATA_RECORD, file)


def _unreadable(records: DataFrame) -> Column:
    """True for a record of which nothing could be read."""
    data = [c for c in records.columns if c not in (CORRUPT, "source_file")]
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in data], F.col(CORRUPT).isNotNull())


def parsed_files(records: DataFrame) -> DataFrame:
    """Files with a record that was read, each once, as ``path``."""
    return records.filter(~_unreadable(records)).select(F.col("source_file").alias("path")).distinct()


def unreadable_files(records: DataFrame) -> DataFrame:
    """Files with a record that could not be read, each once, as ``path``."""
    return records.filter(_unreadable(records)).select(F.col("source_file").alias("path")).distinct()
