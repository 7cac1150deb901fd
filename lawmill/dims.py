"""Fixed dimensions as small tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Document types by id, in the order of the source's list.
DOC_TYPES = {15: "Hiến pháp", 16: "Bộ luật", 17: "Luật", 19: "Pháp lệnh", 2: "Lệnh", 18: "Nghị quyết", 3: "Nghị quyết liên tịch", 20: "Nghị định", 21: "Quyết định", 22: "Thông tư", 23: "Thông tư liên tịch"}
#: Departments whose catalogues are read.
DEPARTMENTS = (
    "bocongan", "bocongthuong", "bogiaoducdaotao", "bogiaothong", "bokehoachvadautu", "bokhoahoccongnghe", "bolaodong", "bonoivu", "bonongnghiep",
    "bongoaigiao", "boquocphong", "botaichinh", "botainguyen", "botuphap", "bothongtin", "bovanhoathethao", "boxaydung", "boyte", "kiemtoannhanuoc",
    "nganhangnhanuoc", "toaannhandantoicao", "thanhtrachinhphu", "uybandantoc", "vanphongchinhphu", "vienkiemsatnhandantoicao",
)
#: Fixed value: the unit whose listings are read by department and type.
UNIT = 213
#: Fixed value: the scope that stands in for the central one.
CENTRAL_SCOPE, FALLBACK_SCOPE = "tw", "botaichinh"
COLLECTIONS = {"vbpq": "van_ban_phap_quy", "vbhn": "van_ban_hop_nhat"}


def doc_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DOC_TYPES.items()), "doc_type_id int, doc_type_name string")


def departments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d,) for d in DEPARTMENTS], "department string")
