"""Sinks: published tables, logs, caches and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import text
from docloom.operators import reports
from docloom.schema import LAYOUT
from docloom.session import cut_lineage, is_folder


def publish(table: DataFrame, path: str, compression: str = "zstd") -> None:
    """The result table as Parquet, files of many documents each."""
    table.write.mode("overwrite").option("compression", compression).parquet(path)


def json_lines(rows: DataFrame, path: str) -> None:
    """One JSON object a line, NULLs written, text unescaped."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def markdown_files(documents: DataFrame, path: str) -> None:
    """Texts of non-empty documents in partitioned text files by shard; a content key's last writer doesn't matter, as its texts are equal."""
    rows = documents.where("markdown IS NOT NULL AND markdown <> '' AND sha256 IS NOT NULL").dropDuplicates(["sha256"])
    rows.select("sha256", text.shard(F.col("sha256")).alias("shard"), "markdown").write.mode("overwrite").partitionBy("shard").parquet(path)


def summary(results: DataFrame, path: str) -> None:
    reports.run_summary(results).coalesce(1).write.mode("overwrite").json(path)


def save_layouts(layouts: DataFrame, path: str) -> None:
    """Layouts into the cache, one per key and model, in the place of older ones; keys of fewer than four characters raise.

    Only the partitions (model, shard) that new layouts fall into are read and written.
    """
    spark = layouts.sparkSession
    safe = F.when(F.length("sha256") >= 4, F.col("sha256")).otherwise(F.raise_error(F.concat(F.lit("content key too short: "), F.coalesce("sha256", F.lit("NULL")))))
    rows = layouts.withColumn("sha256", safe).dropDuplicates(["sha256", "layout_model"]).withColumn("shard", text.shard(F.col("sha256"))).select("sha256", "pages", "layout_model", "shard")
    if is_folder(spark, path):
        old = spark.read.schema(LAYOUT + ", shard string").parquet(path).join(rows.select("layout_model", "shard").distinct(), ["layout_model", "shard"], "left_semi")
        rows = cut_lineage(rows.unionByName(old.join(rows.select("sha256", "layout_model"), ["sha256", "layout_model"], "left_anti").select(*rows.columns)))
    rows.repartition("layout_model", "shard").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("layout_model", "shard").parquet(path)


def append_log(records: DataFrame, path: str) -> None:
    records.write.mode("append").option("ignoreNullFields", False).json(path)


def snapshot(rows: DataFrame, folder: str, version: str) -> str:
    """A new version beside the old ones, never in their place; gives its path."""
    path = f"{folder}/version={version}"
    rows.write.mode("error").json(path)
    return path


def bucket_outputs(documents: DataFrame, records: DataFrame, path: str) -> None:
    """Extracted texts under the first 16 characters of their key, and manifest records appended; a rerun's records stay beside the old."""
    documents.where("markdown <> ''").withColumn("sha16", F.substring("sha256", 1, 16)).dropDuplicates(["sha16"]).write.mode("append").parquet(f"{path}/extracted")
    records.write.mode("append").json(f"{path}/manifest")


def package(rows: DataFrame, path: str, rows_a_file: int = 1_000_000) -> None:
    """Parquet by lang, source and quality bucket and its JSON mirror; hot buckets are dealt out so no task writes one alone.

    ``rows`` need lang, source, quality_bucket and id; NULLs of the first two become 'none'.
    """
    keys = ["lang", "source", "quality_bucket"]
    filled = rows.withColumn("lang", F.coalesce("lang", F.lit("none"))).withColumn("source", F.coalesce("source", F.lit("none")))
    dealt = filled.repartition(*keys, F.pmod(F.xxhash64("id"), F.lit(16)))
    dealt.write.mode("overwrite").option("maxRecordsPerFile", rows_a_file).partitionBy(*keys).parquet(f"{path}/parquet")
    dealt.write.mode("overwrite").option("maxRecordsPerFile", rows_a_file).partitionBy(*keys).json(f"{path}/jsonl")


def quarantine(results: DataFrame, path: str) -> None:
    """Failed results apart, by error class."""
    results.where("error_class IS NOT NULL").write.mode("append").partitionBy("error_class").parquet(path)
