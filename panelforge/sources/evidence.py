"""Files as evidence: digests and sizes of what was delivered against its manifest, and exact line numbers of split files.

Digests read each file's bytes once (``binaryFile``; files beyond Spark's ``binaryFile.maxLength`` fail), listings read no
content. Files without a byte are not listed, so that one is as good as missing. Lines of a large file are read by many tasks; a line's number is its place in its block plus the lines of the
blocks before, which are counted first: one row for each block, whatever the file's length. An unsplit (gzip) file is
one block. Blank lines count as lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What a delivered file may be.
PASS, CHANGED, MISSING, UNLISTED = "PASS", "checksum_mismatch", "missing_file", "unlisted_file"


def tail(path, parts: int):
    """The last ``parts`` parts of a path, by which files of different roots are matched."""
    return F.concat_ws("/", F.slice(F.split(path, "/"), -parts, parts))


def listing(spark: SparkSession, path: str, glob: str = "*", parts: int = 2) -> DataFrame:
    """file (end of the path), path, size, modified of all files below ``path``; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select(tail("path", parts).alias("file"), "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def digests(spark: SparkSession, path: str, glob: str = "*", parts: int = 2) -> DataFrame:
    """file, path, size, sha256 of all files below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select(tail("path", parts).alias("file"), "path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def against_manifest(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files of either side (by ``file``) with their sizes, digests and status."""
    stated = manifest.select("file", F.col("size").alias("stated_size"), F.col("sha256").alias("stated_sha256"))
    both = found.select("file", "size", "sha256").join(stated, "file", "full")
    changed = (F.col("sha256") != F.col("stated_sha256")) | (F.col("size") != F.col("stated_size"))
    status = F.when(F.col("sha256").isNull(), MISSING).when(F.col("stated_sha256").isNull(), UNLISTED).when(changed, CHANGED).otherwise(PASS)
    return both.withColumn("status", status)


def expected_files(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Expected ``file`` names with presence and size, zero where a file is missing."""
    return expected.select("file").distinct().join(found.select("file", "size"), "file", "left").select("file", F.col("size").isNotNull().alias("present"), F.coalesce("size", F.lit(0)).alias("size"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """source_file, line_number (from 1), value of all lines below ``path``."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).select("value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"))
    # rows of a block follow each other in one task, so that these ids differ by the lines between
    lines = lines.withColumn("_id", F.monotonically_increasing_id())
    blocks = lines.groupBy("source_file", "block").agg(F.count("*").alias("n"), F.min("_id").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("source_file", "block", (before - F.col("first") + 1).alias("shift"))
    return lines.join(blocks, ["source_file", "block"]).select("source_file", (F.col("_id") + F.col("shift")).alias("line_number"), "value")


def split_json_objects(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines with a JSON object, as ``record`` (variant), and the others with their error; blank lines are in neither."""
    told = lines.where("trim(value) <> ''").withColumn("record", F.expr("try_parse_json(value)"))
    error = F.when(F.col("record").isNull(), "malformed JSON").when(~F.expr("schema_of_variant(record)").startswith("OBJECT"), "not a JSON object")
    told = told.withColumn("error", error)
    return told.where("error IS NULL").drop("error", "value"), told.where("error IS NOT NULL").drop("record")
