"""Registry data model: XML paths and Spark schemas of the three datasets.

Fixed values -- they must equal the published dump format and the column
names downstream stages rely on. Paths are relative to the document
element; ``@x`` is an attribute.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: XML element paths -> output columns, per dataset ----
DOCUMENT_TAG = "Документ"
ROOT_ATTRIBUTES = {"ИдФайл": "file_id", "КолДок": "doc_cnt"}

ELEMENTS = {
    "smb": {
        "@ВидСубМСП": "kind",
        "@КатСубМСП": "category",
        "@ДатаВклМСП": "reestr_date",
        "@ДатаСост": "data_date",
        "ИПВклМСП/@ИННФЛ": "ind_tin",
        "ИПВклМСП/@ОГРНИП": "ind_number",
        "ИПВклМСП/ФИОИП/@Имя": "first_name",
        "ИПВклМСП/ФИОИП/@Фамилия": "last_name",
        "ИПВклМСП/ФИОИП/@Отчество": "patronymic",
        "ОргВклМСП/@НаимОрг": "org_name",
        "ОргВклМСП/@НаимОргСокр": "org_short_name",
        "ОргВклМСП/@ИННЮЛ": "org_tin",
        "ОргВклМСП/@ОГРН": "org_number",
        "СведМН/@КодРегион": "region_code",
        "СведМН/Регион/@Наим": "region_name",
        "СведМН/Регион/@Тип": "region_type",
        "СведМН/Район/@Наим": "district_name",
        "СведМН/Район/@Тип": "district_type",
        "СведМН/Город/@Наим": "city_name",
        "СведМН/Город/@Тип": "city_type",
        "СведМН/НаселПункт/@Наим": "settlement_name",
        "СведМН/НаселПункт/@Тип": "settlement_type",
        "СвОКВЭД/СвОКВЭДОсн/@КодОКВЭД": "activity_code_main",
    },
    "revexp": {
        "СведНП/@ИННЮЛ": "org_tin",
        "СведДохРасх/@СумДоход": "revenue",
        "СведДохРасх/@СумРасход": "expenditure",
        "@ДатаСост": "data_date",
        "@ДатаДок": "doc_date",
    },
    "empl": {
        "СведНП/@ИННЮЛ": "org_tin",
        "СведССЧР/@КолРаб": "employees_count",
        "@ДатаСост": "data_date",
        "@ДатаДок": "doc_date",
    },
}

# Reduced projection used for validation extracts.
VALIDATION_ELEMENTS = {
    "@ДатаСост": "data_date",
    "ИПВклМСП/@ИННФЛ": "ind_tin",
    "ОргВклМСП/@ИННЮЛ": "org_tin",
    "СведМН/Регион/@Наим": "region_name",
    "СвОКВЭД/СвОКВЭДОсн/@КодОКВЭД": "activity_code_main",
}

INPUT_DATE_FORMAT = "dd.MM.yyyy"


def _s(name, t=T.StringType()):
    return T.StructField(name, t, True)


SMB_SCHEMA = T.StructType([
    _s("kind", T.ByteType()), _s("category", T.ByteType()),
    _s("reestr_date", T.DateType()), _s("data_date", T.DateType()),
    _s("ind_tin"), _s("ind_number"), _s("first_name"), _s("last_name"), _s("patronymic"),
    _s("org_name"), _s("org_short_name"), _s("org_tin"), _s("org_number"),
    _s("region_code", T.ByteType()), _s("region_name"), _s("region_type"),
    _s("district_name"), _s("district_type"), _s("city_name"), _s("city_type"),
    _s("settlement_name"), _s("settlement_type"), _s("activity_code_main"),
    _s("file_id"), _s("doc_cnt", T.ShortType()),
])

# Money as double, not the reference's float32 (which loses kopecks above
# ~1.6e7); years as int.
REVEXP_SCHEMA = T.StructType([
    _s("org_tin"), _s("revenue", T.DoubleType()), _s("expenditure", T.DoubleType()),
    _s("data_date", T.DateType()), _s("doc_date", T.DateType()),
])
EMPL_SCHEMA = T.StructType([
    _s("org_tin"), _s("employees_count", T.IntegerType()),
    _s("data_date", T.DateType()), _s("doc_date", T.DateType()),
])
REVEXP_AGG_SCHEMA = T.StructType([
    _s("tin"), _s("year", T.IntegerType()),
    _s("revenue", T.DoubleType()), _s("expenditure", T.DoubleType()),
])
EMPL_AGG_SCHEMA = T.StructType([
    _s("tin"), _s("year", T.IntegerType()), _s("employees_count", T.IntegerType()),
])
GEOCODED_SCHEMA = T.StructType([
    _s("tin"), _s("reg_number"), _s("kind", T.ByteType()), _s("category", T.ByteType()),
    _s("first_name"), _s("last_name"), _s("patronymic"), _s("org_name"),
    _s("org_short_name"), _s("activity_code_main"), _s("region_iso_code"),
    _s("region_code"), _s("region"), _s("area"), _s("settlement"), _s("settlement_type"),
    _s("oktmo"), _s("lat", T.DoubleType()), _s("lon", T.DoubleType()),
    _s("start_date", T.DateType()), _s("end_date", T.DateType()),
])

SCHEMAS = {"smb": SMB_SCHEMA, "revexp": REVEXP_SCHEMA, "empl": EMPL_SCHEMA}
