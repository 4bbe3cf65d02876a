"""Fixed values of the registry data model and the pipeline's rules.

These must equal the published dump format and the source pipeline's
behaviour for right results; they are stated here once, in their natural
order (order matters where noted).
"""

# ---- fixed values: registry aggregation (C2) ---------------------------
STATE_COLUMNS = [
    "kind", "category", "tin", "reg_number",
    "first_name", "last_name", "patronymic",
    "org_name", "org_short_name",
    "region_name",
    "district_name", "city_name", "settlement_name",
    "activity_code_main",
]
UPPER_COLUMNS = [
    "first_name", "last_name", "patronymic",
    "org_name", "org_short_name",
    "region_name", "region_type",
    "district_name", "district_type",
    "city_name", "city_type",
    "settlement_name", "settlement_type",
]
EXCLUDED_REGIONS = ["Крым", "Севастополь", "Донецкая", "Луганская", "Запорожская", "Херсонская"]
OUTPUT_COLUMNS = [
    "kind", "category", "tin", "reg_number",
    "first_name", "last_name", "patronymic",
    "org_name", "org_short_name",
    "region_code", "region_name", "region_type",
    "district_name", "district_type",
    "city_name", "city_type",
    "settlement_name", "settlement_type",
    "activity_code_main", "start_date", "end_date",
]


# ---- fixed values: geocoding (C5) --------------------------------------
ADDRESS_COLUMNS = [
    "region_name", "region_type", "district_name", "district_type",
    "city_name", "city_type", "settlement_name", "settlement_type",
]
ADDRESS_PARTS = ["region", "district", "city", "settlement"]
# Type words stripped from a region name before fuzzy matching (list order).
REGION_TYPE_WORDS = ["область", "республика", "город", "край", "автономный округ",
                     "автономная область", " обл", "г ", "респ ", " АО"]
FUZZY_THRESHOLD = 80.0
# Area rendering by area type: (type, prefix, suffix).
AREA_RULES = [("г", "Город ", ""), ("р-н", "", " район"), ("у", "", " улус")]
CITY_MARKER = "г"
FEDERAL_CITIES = ["Москва", "Санкт-Петербург"]
# Passes in order: (name, address columns, standard columns, standard).
WATERFALL = [
    ("settlement, all parts, district with type",
     ["region", "district", "settlement_name", "settlement_type"],
     ["region", "municipality", "settlement", "type"], "s"),
    ("settlement, all parts, district name",
     ["region", "district_name", "settlement_name", "settlement_type"],
     ["region", "municipality", "settlement", "type"], "s"),
    ("settlement, all parts, city with type",
     ["region", "city", "settlement_name", "settlement_type"],
     ["region", "municipality", "settlement", "type"], "s"),
    ("settlement, all parts, city name",
     ["region", "city_name", "settlement_name", "settlement_type"],
     ["region", "municipality", "settlement", "type"], "s"),
    ("settlement without type, district with type",
     ["region", "district", "settlement_name"], ["region", "municipality", "settlement"], "s"),
    ("settlement without type, district name",
     ["region", "district_name", "settlement_name"], ["region", "municipality", "settlement"], "s"),
    ("settlement without type, city with type",
     ["region", "city", "settlement_name"], ["region", "municipality", "settlement"], "s"),
    ("settlement without type, city name",
     ["region", "city_name", "settlement_name"], ["region", "municipality", "settlement"], "s"),
    ("settlement and type in region",
     ["region", "settlement_name", "settlement_type"], ["region", "settlement", "type"], "s"),
    ("settlement in region", ["region", "settlement_name"], ["region", "settlement"], "s"),
    ("city, all parts", ["region", "district_name", "city_name", "settlement_name"],
     ["region", "area", "city", "settlement"], "c"),
    ("city without settlement", ["region", "district_name", "city_name"],
     ["region", "area", "city"], "c"),
    ("city in region", ["region", "city_name"], ["region", "city"], "c"),
    ("district as city in region", ["region", "city_name"], ["region", "area"], "c"),
]
DEDUPE_COLUMNS = [
    "kind", "category", "tin", "reg_number", "first_name", "last_name", "patronymic",
    "org_name", "org_short_name", "activity_code_main", "region", "region_code",
    "region_iso_code", "area", "settlement", "settlement_type", "oktmo", "lat", "lon",
]
PRODUCT_COLUMNS = [
    "tin", "reg_number", "kind", "category", "first_name", "last_name", "patronymic",
    "org_name", "org_short_name", "activity_code_main", "region_iso_code", "region_code",
    "region", "area", "settlement", "settlement_type", "oktmo", "lat", "lon",
    "start_date", "end_date",
]


# Type words written before the name when composing "name type" (P10).
# The shipped geocoder never matches them (it composes with upper-cased
# expansions), so ``geocode(prepend_types=())`` is its behaviour; pass this
# list for the exploratory variant that does prepend them.
PREPEND_TYPES = ["Город", "Республика", "Поселок", "Поселок городского типа",
                 "Рабочий поселок"]

# ---- fixed values: validation against published statistics (C8) -------
# Statistics region names that the resolver cannot map, overridden by hand.
STATISTICS_REGION_FIXES = {
    "Город Москва столица Российской Федерации город федерального значения": "Москва",
    "Ненецкий автономный округ (Архангельская область)": "Ненецкий автономный округ",
    "Архангельская область (кроме Ненецкого автономного округа)": "Архангельская область",
    "Ханты-Мансийский автономный округ - Югра (Тюменская область)": "Ханты-Мансийский автономный округ - Югра",
    "Ямало-Ненецкий автономный округ (Тюменская область)": "Ямало-Ненецкий автономный округ",
    "Тюменская область (кроме Ханты-Мансийского автономного округа-Югры и Ямало-Ненецкого автономного округа)": "Тюменская область",
}
# Statistics rows dropped after the overrides (compared trimmed).
STATISTICS_EXCLUDED = [" Архангельская область", "Тюменская область"]
# Activity groups left out of the per-(year, region) and per-(year, group) correlations.
CORRELATION_EXCLUDED_GROUPS = ["O", "P", "R", "U"]
