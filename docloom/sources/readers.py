"""Sources: documents, logs, caches and manifests as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import schema
from docloom.functions import text
from docloom.operators import review


def pdf_files(spark: SparkSession, root: str, limit: int | None = None, with_content: bool = True) -> DataFrame:
    """Records of all ``*.pdf`` below ``root``, in no order: path, sha256, size_bytes, mime, discovered_at, content.

    The limit counts after the sort by path. Without content the listing reads no file and has no sha256.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(root)
    listed = files.select("path", F.col("length").alias("size_bytes"), F.lit("application/pdf").alias("mime"), F.col("modificationTime").cast("double").alias("discovered_at"), *(["content"] if with_content else []))
    if limit is not None:
        first = files.select("path").orderBy("path").limit(limit)
        listed = listed.join(first, "path", "left_semi")
    return listed.withColumn("sha256", F.sha2("content", 256) if with_content else F.lit(None).cast("string"))  # unordered: a sort of whole files would move all bytes


def bucket_listing(spark: SparkSession, root: str, suffix: str = ".pdf", most: int | None = None) -> DataFrame:
    """(path, size) of files with a suffix, by path, from any store that the cluster's file systems reach."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).where(F.col("path").endswith(suffix)).select("path", F.col("length").alias("size"))
    return files.orderBy("path") if most is None else files.orderBy("path").limit(most)


def result_table(spark: SparkSession, path: str) -> DataFrame:
    """A published table; columns of older or newer writers are NULL or ignored."""
    found = spark.read.parquet(path)
    return found.select(*((F.col(n) if n in found.columns else F.lit(None)).cast(t).alias(n) for n, t in schema.RESULT_TABLE))


def bad_case_log(spark: SparkSession, path: str) -> DataFrame:
    """Records of a JSON-lines log; blank and malformed lines and those without sha256 are skipped, a missing log is empty."""
    try:
        lines = spark.read.text(path)
        lines.schema  # noqa: B018
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema.BAD_CASES)
    return review.parsed_log(lines, schema.BAD_CASES)


def json_document(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """One JSON document of a known schema; an unreadable one gives a row of NULLs."""
    return spark.read.schema(ddl).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the array ``pdfs`` of an annotation snapshot."""
    return json_document(spark, path, f"pdfs array<struct<{_fields(schema.ANNOTATIONS)}>>").select(F.inline("pdfs"))


def _fields(ddl: str) -> str:
    return ddl.replace(" ", ":", 1) if "," not in ddl else ",".join(part.strip().replace(" ", ":", 1) for part in _split(ddl))


def _split(ddl: str) -> list[str]:
    parts, depth, at = [], 0, 0
    for i, c in enumerate(ddl):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            parts.append(ddl[at:i])
            at = i + 1
    return [*parts, ddl[at:]]


def cached_layouts(spark: SparkSession, path: str) -> DataFrame:
    """Layouts of a cache folder (partitioned by model and shard), typed; fields that are missing are NULL."""
    return spark.read.schema(schema.LAYOUT + ", shard string").parquet(path)


def manifest(records: DataFrame) -> DataFrame:
    """Ingest records with their shard, each content key once, and whether they are complete."""
    good = F.col("sha256").rlike("^[0-9a-f]{64}$") & (F.col("size_bytes") > 0)
    return records.dropDuplicates(["sha256"]).withColumn("shard", text.shard(F.col("sha256"))).withColumn("healthy", F.coalesce(good, F.lit(False)))
