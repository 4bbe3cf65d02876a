"""The full geocoder (C5) over driver-derived registry intervals and
gazetteers: P10-P14, J3, J4-J8, R4, R5, W4 in one composite."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...assets.fixed import FEDERAL_CITIES, REGION_TYPE_WORDS, WATERFALL
from .common import EXCLUDED_NATIONS, iso_date, register, table
from .registry import _HULL_SQL, _SNAPSHOT_SQL, _registry_snapshots

# A small abbreviation list for the generated address types (the real
# dictionary is an input table of the pipeline).
GEO_ABBREVIATIONS = [("обл", "Область"), ("г", "Город"), ("р-н", "Район"),
                     ("пгт", "Поселок городского типа"), ("д", "Деревня"), ("с", "Село")]


def _geo_records(spark, sf_dir):
    from ..registry import aggregate_registry
    hull = aggregate_registry(_registry_snapshots(spark, sf_dir),
                              excluded_regions=EXCLUDED_NATIONS)
    t = F.col("tin").cast("long")
    return hull.withColumns({
        "settlement_name": F.when(t % 3 == 0, F.concat(F.lit("s"), (t % 40).cast("string"))),
        "settlement_type": F.when(t % 3 == 0, F.lit("д"))})


def _geo_dims(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    regions = n.select(k.alias("_row"), k.cast("string").alias("code"),
                       F.col("n_name").alias("name"), F.lower("n_name").alias("short_name"),
                       F.concat(F.lit("R"), F.col("n_regionkey").cast("string"), F.lit("-"),
                                k.cast("string")).alias("iso_code"))
    none = F.lit(None).cast("string")

    def city(i, area, area_type, name, name_type, oktmo_tag):
        return F.struct((k * 10 + i).alias("id"), F.col("n_name").alias("region"),
                        area.alias("area"), area_type.alias("area_type"), name.alias("city"),
                        name_type.alias("city_type"), none.alias("settlement"),
                        none.alias("settlement_type"),
                        F.concat(F.lit("OK"), k.cast("string"), F.lit(oktmo_tag)).alias("oktmo"),
                        (k * 1.0).alias("geo_lat"), (F.col("n_regionkey") * 1.0).alias("geo_lon"))

    cities = n.select(F.explode(F.array(
        city(0, none, none, F.lit("city a"), F.lit("г"), "A"),
        city(1, F.concat(F.lit("d"), k.cast("string")), F.lit("р-н"), F.lit("city b"),
             F.lit("г"), "B"),
        city(2, F.concat(F.lit("capital"), k.cast("string")), F.lit("г"), none, none, "C"),
    )).alias("c")).select("c.*")
    s = table(spark, sf_dir, "supplier")
    sk = F.col("s_suppkey")
    settlements = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(
        (sk + 1000000).alias("id"), F.col("n_name").alias("region"),
        F.when(sk % 3 == 0, "1-URGENT").when(sk % 3 == 1, "2-HIGH").otherwise("3-MEDIUM")
         .alias("municipality"),
        F.concat(F.lit("s"), (sk % 40).cast("string")).alias("settlement"),
        F.when(sk % 2 == 0, "д").otherwise("с").alias("type"),
        F.concat(F.lit("OS"), sk.cast("string")).alias("oktmo"),
        (F.col("s_acctbal") / 1000).alias("longitude_dd"),
        (F.col("s_nationkey") * 1.0).alias("latitude_dd"))
    abbr = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(GEO_ABBREVIATIONS)],
                                 "name string, name_full string, _row int")
    return regions, cities, settlements, abbr


# ---------------------------------------------------------------- oracle SQL
def _canon_sql(x):
    return f"translate(upper({x}), 'Ё', 'Е')"


def _compose_sql(name, typ):
    return f"CASE WHEN {name} IS NULL OR {typ} IS NULL THEN NULL ELSE {name} || ' ' || {typ} END"


def _strip_sql(x):
    out = f"lower({x})"
    for w in REGION_TYPE_WORDS:
        out = f"replace({out}, '{w}', '')"
    return f"trim({out})"


_ABBR_VALUES = ", ".join(f"('{a}', '{b}', {i})" for i, (a, b) in enumerate(GEO_ABBREVIATIONS))
_ADDR = ["region_name", "region_type", "district_name", "district_type",
         "city_name", "city_type", "settlement_name", "settlement_type"]
_DEDUPE = ["kind", "category", "tin", "reg_number", "first_name", "last_name", "patronymic",
           "org_name", "org_short_name", "activity_code_main", "region", "region_code",
           "region_iso_code", "area", "settlement", "settlement_type", "oktmo", "lat", "lon"]


def _passes_sql():
    ctes, joins, gids = [], [], []
    for i, (_, left, right, std) in enumerate(WATERFALL):
        src = "sstd" if std == "s" else "cstd"
        cols = ", ".join(right)
        having = "count(*) = 1"
        if len(right) == 2:
            having += " AND " + " AND ".join(f"{c} IS NOT NULL" for c in right)
        ctes.append(f"p{i} AS (SELECT {cols}, min(id) AS gid FROM {src} GROUP BY {cols} "
                    f"HAVING {having})")
        cond = " AND ".join(f"a.{lc} IS NOT DISTINCT FROM p{i}.{rc}" for lc, rc in zip(left, right))
        joins.append(f"LEFT JOIN p{i} ON {cond}")
        gids.append((f"p{i}.gid", std))
    geo_id = "coalesce(" + ", ".join(g for g, _ in gids) + ")"
    typ = "CASE " + " ".join(f"WHEN {g} IS NOT NULL THEN '{t}'" for g, t in gids) + " END"
    return ctes, joins, geo_id, typ


def _geocode_ctes(hull=_HULL_SQL):
    pctes, pjoins, geo_id, typ = _passes_sql()
    raw = ", ".join(f"a.raw_{c}" for c in _ADDR)
    addr_raw_cols = ", ".join(f"{c} AS raw_{c}" for c in _ADDR)
    match = " AND ".join(f"r.{c} IS NOT DISTINCT FROM m.raw_{c}" for c in _ADDR)
    dedupe = ", ".join(_DEDUPE)
    fed = ", ".join(f"'{c}'" for c in FEDERAL_CITIES)
    return f"""
WITH {_SNAPSHOT_SQL},
{hull},
recs AS (
  SELECT kind, category, tin, reg_number, first_name, last_name, patronymic, org_name,
         org_short_name, activity_code_main, region_name, region_type, district_name,
         district_type, city_name, city_type,
         CASE WHEN CAST(tin AS BIGINT) % 3 = 0
              THEN 's' || CAST(CAST(tin AS BIGINT) % 40 AS VARCHAR) END AS settlement_name,
         CASE WHEN CAST(tin AS BIGINT) % 3 = 0 THEN 'д' END AS settlement_type,
         start_date, end_date
  FROM hull WHERE rn = 1),
abbr_raw AS (SELECT * FROM (VALUES {_ABBR_VALUES}) t(name, name_full, r)),
abbr AS (
  SELECT name, name_full FROM (
    SELECT upper(name) AS name, upper(name_full) AS name_full,
           row_number() OVER (PARTITION BY upper(name) ORDER BY pr, r) AS rn
    FROM (SELECT name, name_full, 0 AS pr, r FROM abbr_raw
          UNION ALL SELECT name_full, name_full, 1, r FROM abbr_raw
          UNION ALL SELECT name || '.', name_full, 2, r FROM abbr_raw
                    WHERE NOT ends_with(name, '.')))
  WHERE rn = 1),
reg AS (SELECT n_nationkey AS rid, CAST(n_nationkey AS VARCHAR) AS code, n_name AS name,
               lower(n_name) AS short_name,
               'R' || CAST(n_regionkey AS VARCHAR) || '-' || CAST(n_nationkey AS VARCHAR) AS iso_code
        FROM nation),
c0 AS (
  SELECT n_nationkey * 10 AS id, n_name AS region, CAST(NULL AS VARCHAR) AS area,
         CAST(NULL AS VARCHAR) AS area_type, 'city a' AS city, 'г' AS city_type,
         CAST(NULL AS VARCHAR) AS settlement, 'OK' || CAST(n_nationkey AS VARCHAR) || 'A' AS oktmo,
         CAST(n_nationkey AS DOUBLE) AS geo_lat, CAST(n_regionkey AS DOUBLE) AS geo_lon FROM nation
  UNION ALL
  SELECT n_nationkey * 10 + 1, n_name, 'd' || CAST(n_nationkey AS VARCHAR), 'р-н', 'city b', 'г',
         NULL, 'OK' || CAST(n_nationkey AS VARCHAR) || 'B', CAST(n_nationkey AS DOUBLE), CAST(n_regionkey AS DOUBLE)
  FROM nation
  UNION ALL
  SELECT n_nationkey * 10 + 2, n_name, 'capital' || CAST(n_nationkey AS VARCHAR), 'г', NULL, NULL,
         NULL, 'OK' || CAST(n_nationkey AS VARCHAR) || 'C', CAST(n_nationkey AS DOUBLE), CAST(n_regionkey AS DOUBLE)
  FROM nation),
s0 AS (
  SELECT s.s_suppkey + 1000000 AS id, n.n_name AS region,
         CASE s.s_suppkey % 3 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH' ELSE '3-MEDIUM' END
           AS municipality,
         's' || CAST(s.s_suppkey % 40 AS VARCHAR) AS settlement,
         CASE WHEN s.s_suppkey % 2 = 0 THEN 'д' ELSE 'с' END AS type,
         'OS' || CAST(s.s_suppkey AS VARCHAR) AS oktmo,
         s.s_acctbal / 1000 AS longitude_dd, CAST(s.s_nationkey AS DOUBLE) AS latitude_dd
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
addr0 AS (SELECT DISTINCT {", ".join(_ADDR)} FROM recs),
addr1 AS (
  SELECT a.*, ar.name_full AS rt, ad.name_full AS dt, ac.name_full AS ct, ast.name_full AS st
  FROM addr0 a
  LEFT JOIN abbr ar ON upper(a.region_type) = ar.name
  LEFT JOIN abbr ad ON upper(a.district_type) = ad.name
  LEFT JOIN abbr ac ON upper(a.city_type) = ac.name
  LEFT JOIN abbr ast ON upper(a.settlement_type) = ast.name),
addr2 AS (
  SELECT {addr_raw_cols}, rt, dt, ct, st,
         {_compose_sql("region_name", "rt")} AS region_c,
         {_compose_sql("district_name", "dt")} AS district_c,
         {_compose_sql("city_name", "ct")} AS city_c,
         {_compose_sql("settlement_name", "st")} AS settlement_c
  FROM addr1),
sstd0 AS (SELECT s0.id, s0.region, s0.municipality, s0.settlement, ab.name_full AS type
          FROM s0 LEFT JOIN abbr ab ON upper(s0.type) = ab.name),
cstd0 AS (SELECT id, region, area, city, settlement FROM c0
          UNION ALL
          SELECT id, region, NULL, area, settlement FROM c0 WHERE area_type = 'г' AND city IS NULL),
geo AS (
  SELECT id AS geo_id, 'c' AS type, region AS geo_region,
         CASE WHEN a IS NULL OR area_type IS NULL THEN NULL
              WHEN area_type = 'г' THEN 'Город ' || a
              WHEN area_type = 'р-н' THEN a || ' район'
              WHEN area_type = 'у' THEN a || ' улус' ELSE a END AS area,
         coalesce(settlement, city, area) AS settlement, 'г' AS settlement_type, oktmo,
         geo_lat AS lat, geo_lon AS lon
  FROM (SELECT *, CASE WHEN area_type = 'г' THEN NULL ELSE area END AS a FROM c0)
  UNION ALL
  SELECT id, 's', region, municipality, settlement, type, oktmo, latitude_dd, longitude_dd FROM s0),
rv AS (SELECT region_c AS v FROM addr2 UNION SELECT region FROM s0 UNION SELECT region FROM c0
       UNION SELECT name FROM reg),
ex AS (
  SELECT v, regexp_full_match(v, '[0-9]+') AS digits,
         CASE WHEN regexp_full_match(v, '[0-9]+')
              THEN (SELECT max(rid) FROM reg WHERE TRY_CAST(code AS BIGINT) = TRY_CAST(rv.v AS BIGINT))
              ELSE coalesce((SELECT max(rid) FROM reg WHERE lower(name) = lower(rv.v)),
                            (SELECT max(rid) FROM reg WHERE lower(short_name) = lower(rv.v)))
         END AS r_exact
  FROM rv WHERE v IS NOT NULL AND v <> ''),
fz AS (SELECT v, {_strip_sql("v")} AS q FROM ex WHERE r_exact IS NULL AND NOT digits),
sh AS (SELECT lower(short_name) AS ls, min(rid) AS first_rid, max(rid) AS last_rid
       FROM reg GROUP BY lower(short_name)),
sc AS (SELECT fz.v, sh.first_rid, sh.last_rid,
              100.0 * (1.0 - CAST(levenshtein(fz.q, sh.ls) AS DOUBLE)
                       / CAST(greatest(length(fz.q), length(sh.ls)) AS DOUBLE)) AS score
       FROM fz, sh WHERE greatest(length(fz.q), length(sh.ls)) > 0),
best AS (SELECT v, last_rid FROM (
           SELECT *, row_number() OVER (PARTITION BY v ORDER BY score DESC, first_rid) AS rn
           FROM sc WHERE score > 80) WHERE rn = 1),
rinfo AS (SELECT ex.v, reg.name AS rname, reg.code AS rcode, reg.iso_code AS riso
          FROM ex LEFT JOIN best ON ex.v = best.v
                  LEFT JOIN reg ON coalesce(ex.r_exact, best.last_rid) = reg.rid),
addr AS (
  SELECT {", ".join(f"raw_{c}" for c in _ADDR)},
         {_canon_sql("ri.rname")} AS region,
         {_canon_sql("district_c")} AS district, {_canon_sql("city_c")} AS city,
         {_canon_sql("raw_district_name")} AS district_name,
         {_canon_sql("raw_city_name")} AS city_name,
         {_canon_sql("raw_settlement_name")} AS settlement_name,
         {_canon_sql("st")} AS settlement_type
  FROM addr2 LEFT JOIN rinfo ri ON addr2.region_c = ri.v),
sstd AS (SELECT sstd0.id, {_canon_sql("ri.rname")} AS region,
                {_canon_sql("municipality")} AS municipality,
                {_canon_sql("settlement")} AS settlement, {_canon_sql("type")} AS type
         FROM sstd0 LEFT JOIN rinfo ri ON sstd0.region = ri.v),
cstd AS (SELECT cstd0.id, {_canon_sql("ri.rname")} AS region, {_canon_sql("area")} AS area,
                {_canon_sql("city")} AS city, {_canon_sql("settlement")} AS settlement
         FROM cstd0 LEFT JOIN rinfo ri ON cstd0.region = ri.v),
{", ".join(pctes)},
mapping AS (
  SELECT {raw}, {geo_id} AS geo_id, {typ} AS type, a.region AS addr_region
  FROM addr a {" ".join(pjoins)}),
rec AS (
  SELECT r.kind, r.category, r.tin, r.reg_number, r.first_name, r.last_name, r.patronymic,
         r.org_name, r.org_short_name, r.activity_code_main, r.start_date, r.end_date,
         g.area, g.settlement, g.settlement_type, g.oktmo, g.lat, g.lon,
         coalesce(g.geo_region, m.addr_region) AS region0
  FROM recs r LEFT JOIN mapping m ON {match}
  LEFT JOIN geo g ON m.geo_id = g.geo_id AND m.type = g.type),
rec2 AS (
  SELECT rec.* EXCLUDE (region0, settlement), ri.rname AS region, ri.rcode AS region_code,
         ri.riso AS region_iso_code,
         CASE WHEN ri.rname IN ({fed}) AND rec.settlement IS NULL THEN ri.rname
              ELSE rec.settlement END AS settlement
  FROM rec LEFT JOIN rinfo ri ON rec.region0 = ri.v),
w4 AS (
  SELECT *, min(start_date) OVER (PARTITION BY {dedupe}) AS s_min,
         row_number() OVER (PARTITION BY {dedupe}
                            ORDER BY start_date DESC, end_date DESC NULLS LAST) AS rn
  FROM rec2)"""


_GEOCODED = """
SELECT tin, reg_number, CAST(kind AS BIGINT) AS kind, CAST(category AS BIGINT) AS category,
       first_name, last_name, patronymic, org_name, org_short_name, activity_code_main,
       region_iso_code, region_code, region, area, settlement, settlement_type, oktmo, lat, lon,
       strftime(s_min, '%Y-%m-%d') AS start_date, strftime(end_date, '%Y-%m-%d') AS end_date
FROM w4 WHERE rn = 1
"""


@register("geocode_pipeline", _geocode_ctes() + _GEOCODED)
def geocode_pipeline_q(spark, sf_dir):
    """Registry intervals (C2) with generated settlements, geocoded
    against nation-derived regions and cities and supplier-derived
    settlements through the 14-pass waterfall, then deduplicated (W4)."""
    from ...operators.matching import abbreviation_dictionary
    from ..geocode import geocode
    from ...session import cut_lineage
    regions, cities, settlements, abbr = _geo_dims(spark, sf_dir)
    # The geocoder reads its input twice (distinct addresses, then the
    # records): hand it a written table, as the pipeline does.
    records = cut_lineage(_geo_records(spark, sf_dir))
    out = geocode(records, cities, settlements, regions, abbreviation_dictionary(abbr))
    return out.withColumns({
        "kind": F.col("kind").cast("long"), "category": F.col("category").cast("long"),
        "start_date": iso_date("start_date"), "end_date": iso_date("end_date")})
