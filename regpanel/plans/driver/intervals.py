"""Interval, hull and panel queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import intervals as iv
from ..panel import panelize, yearly_panel
from .common import _order_snapshots, iso_date, iso_ts, register, table


# ------------------------------------------------------------ flagship
@register("panel_with_facts", """
WITH hull AS (
  SELECT o_custkey AS tin, o_orderpriority AS state,
         min(CAST(o_orderdate AS DATE)) AS start_date,
         max(CAST(o_orderdate AS DATE)) AS end_date
  FROM orders GROUP BY o_custkey, o_orderpriority),
panel AS (
  SELECT tin, state, start_date, end_date,
         unnest(generate_series(year(start_date), year(end_date))) AS year
  FROM hull),
facts AS (
  SELECT o_custkey AS tin, year(o_orderdate) AS year,
         round(sum(o_totalprice), 2) AS revenue, count(*) AS n_orders
  FROM orders GROUP BY o_custkey, year(o_orderdate))
SELECT p.tin, p.state, strftime(p.start_date, '%Y-%m-%d') AS start_date,
       strftime(p.end_date, '%Y-%m-%d') AS end_date, CAST(p.year AS BIGINT) AS year,
       f.revenue, CAST(f.n_orders AS BIGINT) AS n_orders
FROM panel p LEFT JOIN facts f ON p.tin = f.tin AND p.year = f.year
""")
def panel_with_facts(spark, sf_dir):
    """W2 + R1 + J2: state hull per (customer, priority) -> years -> yearly facts."""
    snaps = _order_snapshots(spark, sf_dir)
    hull = iv.state_hull(snaps, ["tin", "state"], "data_date", carry=[])
    facts = (snaps.groupBy("tin", F.year("data_date").alias("year"))
             .agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"),
                  F.count(F.lit(1)).alias("n_orders")))
    panel = panelize(hull, [facts], key="tin")
    return panel.select("tin", "state", iso_date("start_date").alias("start_date"),
                        iso_date("end_date").alias("end_date"),
                        F.col("year").cast("long").alias("year"), "revenue",
                        F.col("n_orders").cast("long").alias("n_orders"))


# ------------------------------------------------------------ W2 + P7
@register("state_hull", """
SELECT user_id, event_type,
       strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS start_ts,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS end_ts,
       arg_min(value, ts) AS first_value, arg_min(event_id, ts) AS first_event_id
FROM events GROUP BY user_id, event_type
""")
def state_hull_q(spark, sf_dir):
    """Hull per (user, event type) with the earliest row's columns."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "ts",
                                               "value", "event_id")
    h = iv.state_hull(ev, ["user_id", "event_type"], "ts", "start_ts", "end_ts",
                      carry=["value", "event_id"], tiebreak=["event_id"])
    return h.select("user_id", "event_type", iso_ts("start_ts").alias("start_ts"),
                    iso_ts("end_ts").alias("end_ts"),
                    F.col("value").alias("first_value"),
                    F.col("event_id").alias("first_event_id"))


# ------------------------------------------------------------ W1
@register("next_known_fill", """
SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, raw_value,
       first_value(raw_value IGNORE NULLS) OVER (
         PARTITION BY user_id ORDER BY ts, event_id
         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS filled_value
FROM (SELECT event_id, user_id, ts,
             CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS raw_value
      FROM events)
""")
def next_known_fill_q(spark, sf_dir):
    """W1 on events: a third of the values are nulled, then filled from the
    next known value of the same user."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts",
        F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.col("value"))
         .alias("raw_value"))
    out = iv.next_known_fill(ev, "user_id", ["ts", "event_id"], "raw_value",
                             out_col="filled_value")
    return out.select("event_id", "user_id", iso_ts("ts").alias("ts"),
                      "raw_value", "filled_value")


# ------------------------------------------------------------ W3
@register("latest_revision", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       strftime(CAST(doc_date AS DATE), '%Y-%m-%d') AS doc_date
FROM (
  SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY doc_date DESC NULLS LAST, l_partkey DESC, l_suppkey DESC,
               l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
               l_returnflag DESC, l_linestatus DESC) AS rn
  FROM (SELECT *, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_shipdate END AS doc_date
        FROM lineitem))
WHERE rn = 1
""")
def latest_revision_q(spark, sf_dir):
    """Lineitem (orderkey, linenumber) restated by several rows; keep the
    latest doc date (nulls last), ties broken by every other column."""
    li = table(spark, sf_dir, "lineitem").withColumn(
        "doc_date", F.when(F.col("l_partkey") % 7 == 0, F.lit(None))
                     .otherwise(F.col("l_shipdate")))
    tb = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
          "l_tax", "l_returnflag", "l_linestatus"]
    out = iv.latest_revision(li.drop("l_shipdate"), ["l_orderkey", "l_linenumber"],
                             "doc_date", tiebreak=tb)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                      "l_quantity", "l_extendedprice",
                      iso_date(F.to_date("doc_date")).alias("doc_date"))


# ------------------------------------------------------------ W4 / A6
@register("hull_last_end", """
SELECT o_custkey, o_orderstatus, first_priority,
       strftime(start_date, '%Y-%m-%d') AS start_date,
       strftime(end_date, '%Y-%m-%d') AS end_date
FROM (
  SELECT o_custkey, o_orderstatus,
         min(s) OVER w AS start_date,
         first_value(e) OVER (PARTITION BY o_custkey, o_orderstatus
                              ORDER BY s DESC, o_orderkey DESC) AS end_date,
         first_value(o_orderpriority) OVER (PARTITION BY o_custkey, o_orderstatus
                              ORDER BY s, o_orderkey) AS first_priority,
         row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY s, o_orderkey) AS rn
  FROM (SELECT o_custkey, o_orderstatus, o_orderkey, o_orderpriority,
               CAST(o_orderdate AS DATE) AS s,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL
                    ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) END AS e
        FROM orders)
  WINDOW w AS (PARTITION BY o_custkey, o_orderstatus))
WHERE rn = 1
""")
def hull_last_end_q(spark, sf_dir):
    """Merge interval duplicates; end comes from the last-starting row
    (even when that end is null), not from the max end."""
    o = table(spark, sf_dir, "orders")
    s = F.to_date("o_orderdate")
    df = o.select("o_custkey", "o_orderstatus", "o_orderkey", "o_orderpriority",
                  s.alias("start_date"),
                  F.when(F.col("o_orderkey") % 9 == 0, F.lit(None))
                   .otherwise(F.date_add(s, (F.col("o_orderkey") % 400).cast("int")))
                   .alias("end_date"))
    h = iv.hull_last_end(df, ["o_custkey", "o_orderstatus"], carry=["o_orderpriority"],
                         tiebreak=["o_orderkey"])
    return h.select("o_custkey", "o_orderstatus",
                    F.col("o_orderpriority").alias("first_priority"),
                    iso_date("start_date").alias("start_date"),
                    iso_date("end_date").alias("end_date"))


# ------------------------------------------------------------ J9 + W5 + P18
@register("yearly_latest_confidence", """
WITH iv AS (
  SELECT o_custkey AS tin, o_orderkey, CAST(o_orderdate AS DATE) AS start_date,
         CASE WHEN o_orderkey % 10 = 0 THEN NULL
              ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 1000 AS INTEGER) END AS end_date
  FROM orders),
bounds AS (SELECT max(year(end_date)) AS last_year FROM iv),
exp AS (
  SELECT tin, o_orderkey, start_date,
         unnest(generate_series(year(start_date),
                least(coalesce(year(end_date), last_year), last_year))) AS year
  FROM iv, bounds
  WHERE least(coalesce(year(end_date), last_year), last_year) >= year(start_date)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tin, year ORDER BY start_date DESC, o_orderkey DESC) AS rn,
         count(*) OVER (PARTITION BY tin, year) AS n
  FROM exp)
SELECT tin, CAST(year AS BIGINT) AS year, o_orderkey, 1.0 / n AS confidence
FROM ranked WHERE rn = 1
""")
def yearly_latest_confidence(spark, sf_dir):
    """J9 + W5: intervals overlapping each year (open ends run to the last
    year); keep the latest-starting one, confidence = 1 / overlapping."""
    o = table(spark, sf_dir, "orders")
    s = F.to_date("o_orderdate")
    intervals = o.select(F.col("o_custkey").alias("tin"), "o_orderkey",
                         s.alias("start_date"),
                         F.when(F.col("o_orderkey") % 10 == 0, F.lit(None))
                          .otherwise(F.date_add(s, (F.col("o_orderkey") % 1000).cast("int")))
                          .alias("end_date"))
    out = yearly_panel(intervals, key="tin", tiebreak=["o_orderkey"])
    return out.select("tin", F.col("year").cast("long").alias("year"), "o_orderkey",
                      "confidence")


# ------------------------------------------------------------ W2 (streaming)
@register("streaming_hull", """
SELECT tin, state, first_order, strftime(start_date, '%Y-%m-%d') AS start_date,
       strftime(end_date, '%Y-%m-%d') AS end_date
FROM (
  SELECT o_custkey AS tin, o_orderpriority AS state,
         min(CAST(o_orderdate AS DATE)) OVER w AS start_date,
         max(CAST(o_orderdate AS DATE)) OVER w AS end_date,
         first_value(o_orderkey) OVER (PARTITION BY o_custkey, o_orderpriority
                                       ORDER BY o_orderdate, o_orderkey) AS first_order,
         row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                            ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders
  WINDOW w AS (PARTITION BY o_custkey, o_orderpriority))
WHERE rn = 1
""")
def streaming_hull_q(spark, sf_dir):
    """W2 streaming form: snapshots arrive in two waves (before / from 1998);
    an update-mode streaming aggregate upserts the changed intervals; the
    final table equals the batch hull over all snapshots."""
    import uuid
    from ...session import checkpoint_path
    from ...streaming.hull import latest_intervals, stream_state_hull
    base = checkpoint_path(spark, f"stream-hull-{uuid.uuid4().hex[:12]}")
    arrivals, out = base + "-in", base + "-out"
    snaps = _order_snapshots(spark, sf_dir).select(
        "tin", "state", "data_date", F.col("o_orderkey").alias("first_order"))
    cut = F.col("data_date") < F.lit("1998-01-01").cast("date")
    for wave in (cut, ~cut):
        snaps.filter(wave).write.mode("append").parquet(arrivals)
        q = stream_state_hull(spark, arrivals, snaps.schema, ["tin", "state"], "data_date",
                              out, carry=["first_order"], order=["first_order"],
                              checkpoint_location=base + "-ckpt")
        q.awaitTermination()
    h = latest_intervals(spark, out, ["tin", "state"])
    return h.select("tin", "state", "first_order", iso_date("start_date").alias("start_date"),
                    iso_date("end_date").alias("end_date"))
