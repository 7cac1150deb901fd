"""Readers of the formats that crawls leave behind. All give DataFrames with a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MINISTRY_SCHEMA = "ministry string, url string, title string, text string"
ERROR_SCHEMA = "when_utc string, stage string, sitemap_index int, document_index int, url string, sitemap_url string, error string, source_errors_file string"
RECORD_SCHEMA = "id string, text string, metadata map<string,string>, attachments array<struct<filename: string, url: string, type: string>>, created_timestamp string, downloaded_timestamp string, url string"
ATTRIBUTES = ("so_hieu", "loai_van_ban", "noi_ban_hanh", "nguoi_ky", "ngay_ban_hanh", "ngay_hieu_luc", "ngay_cong_bao", "so_cong_bao", "tinh_trang", "title")
DOCUMENT_SCHEMA = f"url string, fetched_at_utc string, title string, attributes struct<{', '.join(a + ': string' for a in ATTRIBUTES)}>, content_text string, content_length int, html string"


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank and malformed lines are passed over, not read as rows of nulls."""
    raw = spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    return raw.where("_corrupt_record is null").drop("_corrupt_record")


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that holds one JSON array."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def table_or_none(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """A table that an earlier run may have left."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    return spark.read.format(fmt).load(path) if there else None


def known_keys(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """The distinct non-empty values of a key in an output written earlier."""
    return jsonl(spark, path, schema).where(F.trim(F.coalesce(key, F.lit(""))) != "").select(key).distinct()


def lines(spark: SparkSession, path: str) -> DataFrame:
    """The non-blank lines of a text file, stripped."""
    return spark.read.text(path).select(F.trim("value").alias("value")).where("value != ''")


def whole_texts(spark: SparkSession, glob: str) -> DataFrame:
    """(path, text) of each file."""
    return spark.read.text(glob, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def json_list(text: Column) -> Column:
    """The non-blank strings of a JSON list; an empty list for anything else."""
    return F.filter(F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>")), lambda x: x.isNotNull() & (F.trim(x) != ""))


def checkpoint(text: Column, start: int = 1) -> Column:
    """The counters of a checkpoint file, with defaults; broken text is a fresh start."""
    c = F.from_json(text, "current_sitemap_index int, next_url_index int, documents_saved int, errors int")
    return F.struct(
        F.greatest(F.lit(start), F.coalesce(c["current_sitemap_index"], F.lit(start))).alias("current_sitemap_index"),
        F.coalesce(c["next_url_index"], F.lit(0)).alias("next_url_index"),
        F.coalesce(c["documents_saved"], F.lit(0)).alias("documents_saved"),
        F.coalesce(c["errors"], F.lit(0)).alias("errors"),
    )


def job_state(text: Column) -> Column:
    """Completed jobs and each job's last page; broken text is a fresh start."""
    c = F.from_json(text, "completed_jobs array<string>, job_last_page map<string,int>")
    return F.struct(F.coalesce(c["completed_jobs"], F.array().cast("array<string>")).alias("completed_jobs"), c["job_last_page"].alias("job_last_page"))


def converter_blocks(text: DataFrame) -> DataFrame:
    """(doc_id, self_ref, text) of a document converter's output (doc_id, json)."""
    parsed = F.from_json("json", "texts array<struct<self_ref: string, text: string>>")
    return text.select("doc_id", F.explode(parsed["texts"]).alias("t")).select("doc_id", "t.self_ref", "t.text")


def files(spark: SparkSession, glob: str) -> DataFrame:
    """Attachments on disk, with their length."""
    return spark.read.format("binaryFile").load(glob).select("path", "length", "content")
