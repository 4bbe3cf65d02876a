"""Dictionary, dedupe, waterfall and region queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import _customers_with_nation, register, table


# ------------------------------------------------------------ A2 + U1 + J3
@register("first_wins_dictionary", """
WITH v AS (
  SELECT upper(p_brand) AS name, upper(p_name) AS name_full, 0 AS pr, p_partkey AS o FROM part
  UNION ALL SELECT upper(p_name), upper(p_name), 1, p_partkey FROM part
  UNION ALL SELECT upper(p_brand || '.'), upper(p_name), 2, p_partkey FROM part
            WHERE NOT ends_with(p_brand, '.')),
d AS (SELECT name, name_full FROM (
        SELECT *, row_number() OVER (PARTITION BY name ORDER BY pr, o) AS rn FROM v)
      WHERE rn = 1),
data AS (SELECT p_partkey,
                CASE p_partkey % 4 WHEN 0 THEN p_brand WHEN 1 THEN p_brand || '.'
                                   WHEN 2 THEN p_name ELSE 'unknown ' || CAST(p_size AS VARCHAR) END AS raw
         FROM part)
SELECT p_partkey, raw, d.name_full AS expanded
FROM data LEFT JOIN d ON upper(data.raw) = d.name
""")
def first_wins_dictionary_q(spark, sf_dir):
    """A2 + U1 + J3: abbreviation dictionary from three variants (short,
    full, dotted short), first variant / earliest row wins; lookup replaces
    the value or gives null."""
    from ...operators.matching import abbreviation_dictionary, dictionary_lookup
    p = table(spark, sf_dir, "part")
    abbr = p.select(F.col("p_brand").alias("name"), F.col("p_name").alias("name_full"),
                    F.col("p_partkey").alias("_row"))
    d = abbreviation_dictionary(abbr)
    k = F.col("p_partkey") % 4
    data = p.select("p_partkey", F.when(k == 0, F.col("p_brand"))
                    .when(k == 1, F.concat("p_brand", F.lit(".")))
                    .when(k == 2, F.col("p_name"))
                    .otherwise(F.concat(F.lit("unknown "), F.col("p_size").cast("string")))
                    .alias("raw"))
    data = data.withColumn("expanded", F.col("raw"))
    return dictionary_lookup(data, "expanded", d).select("p_partkey", "raw", "expanded")


# ------------------------------------------------------------ A3
@register("drop_ambiguous", """
SELECT p_partkey, p_name, p_brand FROM (
  SELECT p_partkey, p_name,
         CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_brand END AS p_brand
  FROM part)
QUALIFY count(*) OVER (PARTITION BY p_name, p_brand) = 1
""")
def drop_ambiguous_q(spark, sf_dir):
    """A3: drop every row whose (name, brand) key occurs more than once;
    null brands compare equal."""
    from ...operators.dedupe import drop_ambiguous
    p = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name",
        F.when(F.col("p_partkey") % 13 == 0, F.lit(None)).otherwise(F.col("p_brand"))
         .alias("p_brand"))
    return drop_ambiguous(p, ["p_name", "p_brand"]).select("p_partkey", "p_name", "p_brand")


# ------------------------------------------------------------ J4 / J5 / J6 / A9
_WATERFALL_SQL = """
addr AS (
  SELECT l.l_orderkey, l.l_linenumber, p.p_brand AS region,
         CASE WHEN l.l_linenumber % 3 = 0 THEN NULL ELSE p.p_type END AS district,
         CASE WHEN l.l_orderkey % 5 = 0 THEN p.p_name || ' X' ELSE p.p_name END AS settlement_name,
         CASE WHEN l.l_suppkey % 4 = 0 THEN NULL ELSE CAST(p.p_size % 5 AS VARCHAR) END AS settlement_type,
         CASE WHEN l.l_orderkey % 5 = 0 THEN p.p_name ELSE NULL END AS city_name
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
s AS (SELECT p_partkey AS id, p_brand AS region,
             CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_type END AS municipality,
             p_name AS settlement, CAST(p_size % 5 AS VARCHAR) AS type FROM part),
c AS (SELECT p_partkey + 1000000000 AS id, p_brand AS region, p_name AS city FROM part),
s1 AS (SELECT region, municipality, settlement, type, min(id) AS gid FROM s
       GROUP BY region, municipality, settlement, type HAVING count(*) = 1),
s2 AS (SELECT region, municipality, settlement, min(id) AS gid FROM s
       GROUP BY region, municipality, settlement HAVING count(*) = 1),
s3 AS (SELECT region, settlement, type, min(id) AS gid FROM s
       GROUP BY region, settlement, type HAVING count(*) = 1),
s4 AS (SELECT region, settlement, min(id) AS gid FROM s GROUP BY region, settlement
       HAVING count(*) = 1 AND region IS NOT NULL AND settlement IS NOT NULL),
c5 AS (SELECT region, city, min(id) AS gid FROM c GROUP BY region, city
       HAVING count(*) = 1 AND region IS NOT NULL AND city IS NOT NULL),
matched AS (
  SELECT a.l_orderkey, a.l_linenumber,
         coalesce(s1.gid, s2.gid, s3.gid, s4.gid, c5.gid) AS geo_id,
         CASE WHEN coalesce(s1.gid, s2.gid, s3.gid, s4.gid) IS NOT NULL THEN 's'
              WHEN c5.gid IS NOT NULL THEN 'c' END AS geo_type,
         CAST(CASE WHEN s1.gid IS NOT NULL THEN 1 WHEN s2.gid IS NOT NULL THEN 2
                   WHEN s3.gid IS NOT NULL THEN 3 WHEN s4.gid IS NOT NULL THEN 4
                   WHEN c5.gid IS NOT NULL THEN 5 END AS BIGINT) AS match_pass
  FROM addr a
  LEFT JOIN s1 ON a.region IS NOT DISTINCT FROM s1.region
              AND a.district IS NOT DISTINCT FROM s1.municipality
              AND a.settlement_name IS NOT DISTINCT FROM s1.settlement
              AND a.settlement_type IS NOT DISTINCT FROM s1.type
  LEFT JOIN s2 ON a.region IS NOT DISTINCT FROM s2.region
              AND a.district IS NOT DISTINCT FROM s2.municipality
              AND a.settlement_name IS NOT DISTINCT FROM s2.settlement
  LEFT JOIN s3 ON a.region IS NOT DISTINCT FROM s3.region
              AND a.settlement_name IS NOT DISTINCT FROM s3.settlement
              AND a.settlement_type IS NOT DISTINCT FROM s3.type
  LEFT JOIN s4 ON a.region IS NOT DISTINCT FROM s4.region
              AND a.settlement_name IS NOT DISTINCT FROM s4.settlement
  LEFT JOIN c5 ON a.region IS NOT DISTINCT FROM c5.region
              AND a.city_name IS NOT DISTINCT FROM c5.city)"""


def _waterfall(spark, sf_dir):
    from ...operators.matching import MatchPass, waterfall_match
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    perturbed = F.col("l_orderkey") % 5 == 0
    addr = li.join(p, li["l_partkey"] == p["p_partkey"]).select(
        "l_orderkey", "l_linenumber", F.col("p_brand").alias("region"),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit(None)).otherwise(F.col("p_type"))
         .alias("district"),
        F.when(perturbed, F.concat("p_name", F.lit(" X"))).otherwise(F.col("p_name"))
         .alias("settlement_name"),
        F.when(F.col("l_suppkey") % 4 == 0, F.lit(None))
         .otherwise((F.col("p_size") % 5).cast("string")).alias("settlement_type"),
        F.when(perturbed, F.col("p_name")).alias("city_name"))
    settlements = p.select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("region"),
        F.when(F.col("p_partkey") % 17 == 0, F.lit(None)).otherwise(F.col("p_type"))
         .alias("municipality"),
        F.col("p_name").alias("settlement"), (F.col("p_size") % 5).cast("string").alias("type"))
    cities = p.select((F.col("p_partkey") + 1000000000).alias("id"),
                      F.col("p_brand").alias("region"), F.col("p_name").alias("city"))
    passes = [
        MatchPass("all parts", ["region", "district", "settlement_name", "settlement_type"],
                  ["region", "municipality", "settlement", "type"], "s"),
        MatchPass("all but type", ["region", "district", "settlement_name"],
                  ["region", "municipality", "settlement"], "s"),
        MatchPass("settlement with type", ["region", "settlement_name", "settlement_type"],
                  ["region", "settlement", "type"], "s"),
        MatchPass("settlement", ["region", "settlement_name"], ["region", "settlement"], "s"),
        MatchPass("city", ["region", "city_name"], ["region", "city"], "c"),
    ]
    return waterfall_match(addr, {"s": settlements, "c": cities}, passes)


@register("waterfall_match", f"""
WITH {_WATERFALL_SQL}
SELECT * FROM matched
""")
def waterfall_match_q(spark, sf_dir):
    """J4 + J5 + J6: ordered null-safe key cascade against de-ambiguated
    standards; first hit wins."""
    m = _waterfall(spark, sf_dir)
    return m.select("l_orderkey", "l_linenumber", "geo_id", "geo_type",
                    F.col("match_pass").cast("long").alias("match_pass"))


@register("match_stats", f"""
WITH {_WATERFALL_SQL}
SELECT match_pass, count(*) AS n FROM matched GROUP BY match_pass
""")
def match_stats_q(spark, sf_dir):
    """Matches per pass (null = unmatched)."""
    from ...operators.matching import match_stats
    m = match_stats(_waterfall(spark, sf_dir))
    return m.select(F.col("match_pass").cast("long").alias("match_pass"),
                    F.col("n").cast("long").alias("n"))


# ------------------------------------------------------------ R4 / R5 / P11 / P14 / P19
# How an area is rendered with its type (type, prefix, suffix).
AREA_RULES = [("г", "Город ", ""), ("р-н", "", " район"), ("у", "", " улус")]

_GEO_SQL = """
cities AS (
  SELECT c.c_custkey AS id, n.n_name AS region,
         CASE WHEN c.c_custkey % 7 = 0 THEN NULL ELSE c.c_mktsegment END AS area,
         CASE c.c_custkey % 4 WHEN 0 THEN 'г' WHEN 1 THEN 'р-н' WHEN 2 THEN 'у' ELSE 'п' END AS area_type,
         CASE WHEN c.c_custkey % 5 = 0 THEN NULL ELSE c.c_name END AS city,
         CASE WHEN c.c_custkey % 3 = 0 THEN 'S' || CAST(c.c_custkey AS VARCHAR) END AS settlement,
         CAST(c.c_custkey * 97 AS VARCHAR) AS oktmo,
         c.c_acctbal / 100 AS geo_lat, CAST(c.c_nationkey AS DOUBLE) AS geo_lon
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
settlements AS (
  SELECT s.s_suppkey AS id, n.n_name AS region,
         'MUNI_' || CAST(s.s_suppkey % 7 AS VARCHAR) AS municipality, s.s_name AS settlement,
         CASE s.s_suppkey % 3 WHEN 0 THEN 'п' WHEN 1 THEN 'с' END AS type,
         CAST(s.s_suppkey AS VARCHAR) AS oktmo,
         s.s_acctbal / 1000 AS latitude_dd, CAST(s.s_nationkey AS DOUBLE) AS longitude_dd
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey)"""


def _geo_dims(spark, sf_dir):
    cn = _customers_with_nation(spark, sf_dir)
    k = F.col("c_custkey")
    cities = cn.select(
        k.alias("id"), F.col("n_name").alias("region"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("area"),
        F.when(k % 4 == 0, "г").when(k % 4 == 1, "р-н").when(k % 4 == 2, "у")
         .otherwise("п").alias("area_type"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("city"),
        F.when(k % 3 == 0, F.concat(F.lit("S"), k.cast("string"))).alias("settlement"),
        (k * 97).cast("string").alias("oktmo"),
        (F.col("c_acctbal") / 100).alias("geo_lat"),
        F.col("c_nationkey").cast("double").alias("geo_lon"))
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    sk = F.col("s_suppkey")
    settlements = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(
        sk.alias("id"), F.col("n_name").alias("region"),
        F.concat(F.lit("MUNI_"), (sk % 7).cast("string")).alias("municipality"),
        F.col("s_name").alias("settlement"),
        F.when(sk % 3 == 0, "п").when(sk % 3 == 1, "с").alias("type"),
        sk.cast("string").alias("oktmo"),
        (F.col("s_acctbal") / 1000).alias("latitude_dd"),
        F.col("s_nationkey").cast("double").alias("longitude_dd"))
    return cities, settlements


@register("conform_union", f"""
WITH {_GEO_SQL}
SELECT id AS geo_id, 'c' AS type, region,
       CASE WHEN a IS NULL OR area_type IS NULL THEN NULL
            WHEN area_type = 'г' THEN 'Город ' || a
            WHEN area_type = 'р-н' THEN a || ' район'
            WHEN area_type = 'у' THEN a || ' улус' ELSE a END AS area,
       coalesce(settlement, city, area) AS settlement, 'г' AS settlement_type,
       oktmo, geo_lat AS lat, geo_lon AS lon
FROM (SELECT *, CASE WHEN area_type = 'г' THEN NULL ELSE area END AS a FROM cities)
UNION ALL
SELECT id, 's', region, municipality, settlement, type, oktmo, latitude_dd, longitude_dd
FROM settlements
""")
def conform_union_q(spark, sf_dir):
    """R4 + P11 + P14 + P19: city and settlement dimensions conformed to one
    column set and tagged by source."""
    from ...operators.reshape import joint_geodata
    cities, settlements = _geo_dims(spark, sf_dir)
    return joint_geodata(cities, settlements, AREA_RULES)


@register("cities_standard", f"""
WITH {_GEO_SQL}
SELECT id, region, area, city, settlement FROM cities
UNION ALL
SELECT id, region, NULL AS area, area AS city, settlement FROM cities
WHERE area_type = 'г' AND city IS NULL
""")
def cities_standard_q(spark, sf_dir):
    """City standard plus areas that are cities moved to the city column."""
    from ...operators.reshape import cities_standard
    cities, _ = _geo_dims(spark, sf_dir)
    return cities_standard(cities)


# ------------------------------------------------------------ J7 / J8 / A8 / F14
REGION_TYPE_WORDS = ["republic ", " oblast"]

_REGIONS_SQL = """
reg AS (SELECT n_nationkey AS rid, CAST(n_nationkey AS VARCHAR) AS code, n_name AS name,
               lower(n_name) || 'ia' AS short_name,
               'R' || CAST(n_regionkey AS VARCHAR) || '-' || CAST(n_nationkey AS VARCHAR) AS iso_code
        FROM nation)"""


def _regions_dim(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").alias("_row"), F.col("n_nationkey").cast("string").alias("code"),
        F.col("n_name").alias("name"),
        F.concat(F.lower("n_name"), F.lit("ia")).alias("short_name"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string"), F.lit("-"),
                 F.col("n_nationkey").cast("string")).alias("iso_code"))


@register("region_exact_then_fuzzy", f"""
WITH {_REGIONS_SQL},
keys AS (
  SELECT c.c_custkey,
         CASE c.c_custkey % 6
           WHEN 0 THEN n.n_name
           WHEN 1 THEN lower(n.n_name)
           WHEN 2 THEN lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0')
           WHEN 3 THEN 'Republic ' || replace(lower(n.n_name) || 'ia', 'tio', 'to')
           WHEN 4 THEN 'Zz' || CAST(c.c_custkey AS VARCHAR)
           ELSE NULL END AS raw
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
dk AS (SELECT DISTINCT raw FROM keys WHERE raw IS NOT NULL AND raw <> ''),
ex AS (
  SELECT raw, regexp_full_match(raw, '[0-9]+') AS digits,
         CASE WHEN regexp_full_match(raw, '[0-9]+')
              THEN (SELECT max(rid) FROM reg WHERE TRY_CAST(code AS BIGINT) = TRY_CAST(dk.raw AS BIGINT))
              ELSE coalesce((SELECT max(rid) FROM reg WHERE lower(name) = lower(dk.raw)),
                            (SELECT max(rid) FROM reg WHERE lower(short_name) = lower(dk.raw)))
         END AS r_exact
  FROM dk),
fz AS (SELECT raw, trim(replace(replace(lower(raw), 'republic ', ''), ' oblast', '')) AS q
       FROM ex WHERE r_exact IS NULL AND NOT digits),
sh AS (SELECT lower(short_name) AS ls, min(rid) AS first_rid, max(rid) AS last_rid
       FROM reg GROUP BY lower(short_name)),
sc AS (SELECT fz.raw, sh.first_rid, sh.last_rid,
              100.0 * (1.0 - CAST(levenshtein(fz.q, sh.ls) AS DOUBLE)
                       / CAST(greatest(length(fz.q), length(sh.ls)) AS DOUBLE)) AS score
       FROM fz, sh),
best AS (SELECT raw, last_rid FROM (
           SELECT *, row_number() OVER (PARTITION BY raw ORDER BY score DESC, first_rid) AS rn
           FROM sc WHERE score > 80) WHERE rn = 1),
map AS (SELECT ex.raw, coalesce(ex.r_exact, best.last_rid) AS rid
        FROM ex LEFT JOIN best ON ex.raw = best.raw)
SELECT k.c_custkey, k.raw, reg.name AS region_name, reg.code AS region_code,
       reg.iso_code AS region_iso_code
FROM keys k LEFT JOIN map m ON k.raw = m.raw LEFT JOIN reg ON m.rid = reg.rid
""")
def region_exact_then_fuzzy_q(spark, sf_dir):
    """J7 + J8: region by code / exact name / short name / fuzzy short name
    after removing type words; unknown -> null record."""
    from ...operators.regions import normalize_regions
    cn = _customers_with_nation(spark, sf_dir)
    k = F.col("c_custkey") % 6
    short = F.concat(F.lower("n_name"), F.lit("ia"))
    raw = (F.when(k == 0, F.col("n_name"))
            .when(k == 1, F.lower("n_name"))
            .when(k == 2, F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
            .when(k == 3, F.concat(F.lit("Republic "), F.replace(short, F.lit("tio"), F.lit("to"))))
            .when(k == 4, F.concat(F.lit("Zz"), F.col("c_custkey").cast("string"))))
    keys = cn.select("c_custkey", raw.alias("raw"), raw.alias("region_name"))
    out = normalize_regions(keys, "region_name", _regions_dim(spark, sf_dir),
                            REGION_TYPE_WORDS, threshold=80.0)
    return out.select("c_custkey", "raw", "region_name", "region_code", "region_iso_code")


# ------------------------------------------------------------ J6 / A13 / A7
@register("checked_attach", """
SELECT l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, p.p_brand, p.p_type
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
""")
def checked_attach_q(spark, sf_dir):
    """J6 + A13: attach a dimension by key with the build side checked
    unique inside the same job (a duplicate key fails the job)."""
    from ...operators.matching import attach_checked
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber",
                                                 F.col("l_partkey").alias("k"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), "p_brand", "p_type")
    return attach_checked(li, p, ["k"]).select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "p_brand", "p_type")
