"""The queries of the training-data problems, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawmill.llm import boilerplate, canonical, lookalike, mojibake, neardup, packing, residue, tokens, truncation
from lawmill.session import read_table, stage


def _tables(spark: SparkSession, d: str, *names: str) -> list[DataFrame]:
    return [read_table(spark, d, n) for n in names]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.unliteral_values(*_tables(spark, d, "vbpl_records", "tvpl_documents", "canon_values"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    vbpl, tvpl, documents = _tables(spark, d, "vbpl_records", "tvpl_documents", "documents")
    return residue.residue_records(residue.corpus_texts(vbpl, tvpl, documents))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    tvpl, pages = _tables(spark, d, "tvpl_documents", "ministry_pages")
    texts = residue.corpus_texts(tvpl=tvpl, pages=pages)
    sound = texts.join(residue.residue_records(texts), ["src", "row_key"], "left_anti")
    model = mojibake.train(mojibake.tvpl_values(tvpl).select(F.col("value").alias("text")))
    return boilerplate.furniture_lines(sound, model)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.repair_tvpl(read_table(spark, d, "tvpl_documents")).select("row_key", "field")


def p4_restored(spark: SparkSession, d: str) -> DataFrame:
    found = mojibake.repair_tvpl(read_table(spark, d, "tvpl_documents"))
    return found.select("row_key", "field", "restored", F.concat_ws("+", "chains").alias("chains"), "text")


SOURCES = ["vbpl_records", "tvpl_documents", "documents"]


def _near(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    texts = residue.corpus_texts(*_tables(spark, d, *SOURCES))
    sound = texts.join(residue.residue_records(texts), ["src", "row_key"], "left_anti")
    return neardup.near_duplicates(sound, SOURCES)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.expand(*_near(spark, d))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    vbpl, documents, tvpl = _tables(spark, d, "vbpl_records", "documents", "tvpl_documents")
    garbled = mojibake.repair_tvpl(tvpl, ("title",)).select("src", "row_key", "field")
    values = lookalike.written_fields(vbpl, documents, tvpl)
    return lookalike.plain_forms(values).select("src", "row_key", "field").join(garbled, ["src", "row_key", "field"], "left_anti")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_documents(read_table(spark, d, "documents"))


def p9_bins(spark: SparkSession, d: str) -> DataFrame:
    documents, targets = _tables(spark, d, "documents", "pack_targets")
    return packing.pack(stage(tokens.token_counts(documents), "token-counts"), targets)


def p9_usage(spark: SparkSession, d: str) -> DataFrame:
    return packing.usage(p9_bins(spark, d))


def _ends(spark: SparkSession, d: str) -> DataFrame:
    documents = read_table(spark, d, "documents")
    leftover = residue.residue_records(residue.corpus_texts(documents=documents)).select(F.col("row_key").alias("doc_id"))
    return truncation.judge(stage(truncation.measure(documents).join(leftover, "doc_id", "left_anti"), "text-ends"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return _ends(spark, d).where("cut").select("doc_id")


def p10_sources(spark: SparkSession, d: str) -> DataFrame:
    by = _ends(spark, d).groupBy("source").agg(F.count("*").alias("texts"), F.sum(F.col("cut").cast("bigint")).alias("cut"))
    return by.withColumn("share", F.round(F.col("cut").cast("double") / F.col("texts"), 6))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p2_found, p3_found, p4_found, p4_restored, p6_found, p7_found, p8_ids, p9_bins, p9_usage, p10_found, p10_sources)}


_BLANK = r"[\t\n\v\f\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: What leftover records of this project's tables hold, written down on its own, without the operator's grammar.
_LEFTOVER = "|".join((
    r"\{\{|\{%|<%|[$#]!?\{|%%[A-Z]|\[\[[A-Z]|__[A-Z]{4,}__|@Model\.|«[^ »]*_|\{\d\}/|undefined/NaN|NaN/undefined|#REF!|<TÊN |\[SỐ |\[Nhập |System\.Data|\[object O|Lorem ipsum",
    r"HTTP Error|Bad Gateway|Temporarily Unavailable|Access Denied|You don.t have permission|The page you are looking|Object reference not|\.java:|Exception: |mysqli|Fatal error|\{.code.:\d+,|Page_Load",
    r"Không tìm thấy trang|Đường dẫn bạn|Trang bạn tìm|Lỗi: không nạp|Lỗi! Tệp|Quá nhiều yêu cầu từ|Just a moment|Checking if the|bạn không phải là người máy|Đang tải dữ liệu|đang được cập nhật\.\.\.",
    r"chưa có nội dung tiếng|đang bảo trì từ|Phiên làm việc đã hết hạn|Mật khẩu\n|Mật khẩu$|Bạn chưa đăng ký gói|bật JavaScript|enable scripts|Trình duyệt không chạy|Trình duyệt của bạn không",
    r"(?m:^(?:[a-z]+ )*(?:congue|mollis|vitae|risus) (?:[a-z]+ )*(?:elit|dolor|quis|nulla|amet|magnis)[ .])",
))


def _residue_sql(texts: str) -> str:
    """SQL of the records to exclude, over a subquery of (src, row_key, host, text); no line recurs so often that it is boilerplate."""
    return rf"""
    t AS ({texts}),
    l AS (SELECT src, row_key, unnest(string_split(text, chr(10))) AS raw FROM t WHERE text IS NOT NULL),
    w AS (SELECT src, row_key, list_filter(string_split_regex(lower(raw), '[^\p{{L}}\p{{N}}\p{{M}}_]+'), lambda x: x <> '') AS words FROM l),
    residue AS (SELECT src, row_key FROM t WHERE row_key IS NOT NULL AND regexp_matches(text, '{_LEFTOVER}') UNION SELECT src, row_key FROM w WHERE len(words) >= 8 AND len(list_distinct(words)) * 3 <= len(words))"""


_TEXTS = """SELECT 'vbpl_records' AS src, record_id AS row_key, coalesce(lower(regexp_extract(url, '://([^/?#]+)', 1)), '') AS host, text FROM vbpl_records
    UNION ALL SELECT 'tvpl_documents', row_id, coalesce(lower(regexp_extract(url, '://([^/?#]+)', 1)), ''), content_text FROM tvpl_documents
    UNION ALL SELECT 'documents', doc_id, coalesce(source, ''), text FROM documents"""


def oracle_sql() -> dict[str, str]:
    """SQL for the problems that it can express over whole tables."""
    p2 = f"WITH {_residue_sql(_TEXTS)} SELECT src, row_key FROM residue"
    p6 = f"""WITH {_residue_sql(_TEXTS)},
    words AS (SELECT src, row_key, list_filter(string_split_regex(lower(text), '{_BLANK}+'), lambda x: x <> '') AS w FROM t WHERE text IS NOT NULL AND NOT EXISTS (SELECT 1 FROM residue r WHERE r.src = t.src AND r.row_key = t.row_key)),
    runs AS (SELECT src, row_key, list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM words WHERE len(w) >= 20),
    flat AS (SELECT src, row_key, len(s) AS n, unnest(s) AS g FROM runs),
    both_ AS (SELECT a.src, a.row_key AS key_a, b.row_key AS key_b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
              FROM flat a JOIN flat b ON a.src = b.src AND a.g = b.g AND a.row_key < b.row_key AND least(a.n, b.n) >= 0.6 * greatest(a.n, b.n) GROUP BY ALL)
    SELECT src, key_a, key_b FROM both_ WHERE c::DOUBLE / (na + nb - c) >= 0.6"""
    return {"p2_found": p2, "p6_found": p6}
