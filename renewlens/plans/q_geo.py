"""Location queries: flatten, clusters, home, distance statistics, metrics, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from renewlens import config
from renewlens.config import DRIVER_CONFIG as CFG
from renewlens.functions.geo import haversine_km, is_night
from renewlens.operators import location as L
from renewlens.plans.catalog import register
from renewlens.plans.oracle import with_adapters
from renewlens.plans.profile import eligible_members, location_metrics


def hav(lat1, lon1, lat2, lon2):
    a = (f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * "
         f"pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)")
    return f"(6371.0 * 2 * atan2(sqrt({a}), sqrt(1 - ({a}))))"


def xmean(c):
    """Exact mean: decimal sum, half-up integer division, one double division."""
    x = f"CAST(sum(CAST({c} AS DECIMAL(20,10))) * 1000000000000 AS HUGEINT)"
    n = f"count({c})"
    return f"(sign({x}) * CAST((2 * abs({x}) + {n}) // (2 * {n}) AS DOUBLE) / CAST(1000000000000 AS DOUBLE))"


NIGHT = ("COALESCE(hour(created_at + INTERVAL 5 HOUR) >= 22 OR hour(created_at + INTERVAL 5 HOUR) <= 8, false)")

GEO_CTES = f"""
owners AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id FROM member_locations),
mf AS (
  SELECT DISTINCT CAST(m.user_id AS VARCHAR) AS user_id, COALESCE(f.name, 'Unknown') AS facility_name
  FROM members m LEFT JOIN facilities f ON f.facility_id = m.facility_id
  WHERE m.role = 'user' AND m.partnership IS NULL
    AND CAST(m.user_id AS VARCHAR) IN (SELECT user_id FROM owners)),
mf2 AS (
  SELECT mf.user_id, mf.facility_name, c.lat AS fac_lat, c.lon AS fac_lon
  FROM mf LEFT JOIN (SELECT name, lat, lon FROM facilities WHERE lat IS NOT NULL AND lon IS NOT NULL) c
    ON c.name = mf.facility_name
  WHERE mf.facility_name <> 'Unknown'),
flat AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, latitude, longitude, created_at
  FROM member_locations WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
pts AS (
  SELECT p.*, round(p.latitude, 4) AS lat_r, round(p.longitude, 4) AS lon_r, {NIGHT} AS is_night,
         mf2.fac_lat, mf2.fac_lon, {hav('p.latitude', 'p.longitude', 'mf2.fac_lat', 'mf2.fac_lon')} AS d
  FROM flat p JOIN mf2 ON p.user_id = mf2.user_id WHERE mf2.fac_lat IS NOT NULL),
clusters AS (
  SELECT user_id, lat_r, lon_r, {xmean('latitude')} AS c_lat, {xmean('longitude')} AS c_lon, count(*) AS n_points,
         sum(CAST(is_night AS BIGINT)) AS night_count, count(*) + 2 * sum(CAST(is_night AS BIGINT)) AS score,
         any_value(fac_lat) AS fac_lat, any_value(fac_lon) AS fac_lon
  FROM pts GROUP BY user_id, lat_r, lon_r),
home AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, lat_r, lon_r) AS rn
                 FROM clusters) WHERE rn = 1),
top2 AS (
  SELECT user_id, min({hav('c_lat', 'c_lon', 'fac_lat', 'fac_lon')}) AS top2_min_km
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n_points DESC, lat_r, lon_r) AS rn FROM clusters)
  WHERE rn <= 2 GROUP BY user_id),
stats AS (SELECT user_id, count(*) AS total, avg(d) AS mean_km, stddev_pop(d) AS std_km FROM pts GROUP BY user_id),
gj AS (
  SELECT mf2.user_id, mf2.fac_lat, h.c_lat, h.c_lon, h.n_points, s.total, s.mean_km, s.std_km, t.top2_min_km,
         {hav('h.c_lat', 'h.c_lon', 'mf2.fac_lat', 'mf2.fac_lon')} AS d_home,
         CAST(h.n_points AS DOUBLE) / s.total * 100.0 AS confidence,
         mf2.fac_lat IS NOT NULL AND COALESCE(s.total, 0) > 0 AS scored,
         mf2.fac_lat IS NOT NULL AND COALESCE(s.total, 0) >= 3 AS enough,
         round(CASE WHEN s.total > 1 THEN s.std_km ELSE 0.0 END, 2) AS variability
  FROM mf2 LEFT JOIN home h ON h.user_id = mf2.user_id LEFT JOIN stats s ON s.user_id = mf2.user_id
  LEFT JOIN top2 t ON t.user_id = mf2.user_id),
geo AS (
  SELECT user_id,
         CASE WHEN scored THEN c_lat END AS home_latitude,
         CASE WHEN scored THEN c_lon END AS home_longitude,
         CASE WHEN scored THEN round(confidence, 2) END AS home_location_confidence,
         CASE WHEN scored THEN total ELSE 0 END AS location_sample_size,
         CASE WHEN scored THEN round(d_home, 2) END AS distance_home_to_club_km,
         CASE WHEN enough THEN round(mean_km, 2) END AS avg_booking_distance_km,
         CASE WHEN enough THEN round(top2_min_km, 2) END AS min_booking_distance_km,
         CASE WHEN enough THEN variability END AS distance_variability,
         CASE WHEN scored THEN d_home < 2.0 ELSE false END AS is_home_nearby,
         CASE WHEN enough THEN round(greatest(0.0, least(1.0,
              1.0 - (0.7 * least(1.0, d_home / 10.0) + 0.3 * least(1.0, variability / 5.0)))), 4) END
           AS commute_convenience_score,
         CASE WHEN fac_lat IS NULL THEN 'no_club_coords'
              WHEN COALESCE(total, 0) = 0 THEN 'no_user_data'
              WHEN total < 3 THEN 'insufficient'
              WHEN total >= 20 AND confidence >= 30 THEN 'good'
              WHEN total >= 10 AND confidence >= 20 THEN 'medium'
              ELSE 'poor' END AS location_data_quality
  FROM gj)"""
GEO_WITH = with_adapters("members", "facilities", "member_locations", extra=GEO_CTES)


def points(t):
    return L.flatten_location(t.adapters.member_locations)


def metrics(t):
    return location_metrics(t.adapters, CFG)


def points_with_facility(t):
    a = t.adapters
    coords = a.facilities.filter(F.col("lat").isNotNull()).select(
        "facility_id", F.col("lat").alias("fac_lat"), F.col("lon").alias("fac_lon"))
    mf = (eligible_members(a.members).join(coords, "facility_id")
          .select(F.col("user_id").cast("string").alias("user_id"), "fac_lat", "fac_lon"))
    return points(t).join(mf, "user_id")


@register("flatten_location", with_adapters("member_locations") + """
SELECT CAST(user_id AS VARCHAR) AS user_id, latitude, longitude, created_at
FROM member_locations WHERE latitude IS NOT NULL AND longitude IS NOT NULL""")
def flatten_location(t):
    """Nested location -> latitude/longitude; id as string; rows with both coordinates."""
    return points(t)


@register("is_night", with_adapters("member_locations") + f"""
SELECT point_id, {NIGHT} AS is_night FROM member_locations""")
def is_night_q(t):
    """Local hour (UTC + 5) >= 22 or <= 8; missing time -> false."""
    ml = t.adapters.member_locations
    return ml.select("point_id", is_night("created_at").alias("is_night"))


@register("haversine_km", with_adapters("members", "facilities", "member_locations") + f"""
SELECT l.point_id, round({hav('l.latitude', 'l.longitude', 'f.lat', 'f.lon')}, 6) AS km
FROM member_locations l JOIN members m ON l.user_id = m.user_id JOIN facilities f ON f.facility_id = m.facility_id
WHERE l.latitude IS NOT NULL AND f.lat IS NOT NULL""")
def haversine_q(t):
    """Point -> member's facility great-circle distance."""
    a = t.adapters
    ml = a.member_locations.select("point_id", "user_id", F.col("location.latitude").alias("la"),
                                   F.col("location.longitude").alias("lo")).filter(F.col("la").isNotNull())
    fac = a.facilities.filter(F.col("lat").isNotNull())
    j = ml.join(a.members.select("user_id", "facility_id"), "user_id").join(fac, "facility_id")
    return j.select("point_id", F.round(haversine_km("la", "lo", "lat", "lon"), 6).alias("km"))


@register("home_clusters", GEO_WITH + """
SELECT user_id, lat_r, lon_r, c_lat, c_lon, n_points, night_count, score
FROM clusters""")
def home_clusters(t):
    """Per (member, 4-decimal cell): centroid, count, night count, score = count + 2 * night."""
    c = L.home_clusters(points_with_facility(t))
    return c.select("user_id", "lat_r", "lon_r", "c_lat", "c_lon", "n_points", "night_count", "score")


@register("home_top1", GEO_WITH + """
SELECT user_id, lat_r, lon_r, n_points, night_count, score FROM home""")
def home_top1(t):
    """Best cluster per member: score desc, ties to the smallest (lat, lon) cell."""
    return L.home_top1(L.home_clusters(points_with_facility(t))).select(
        "user_id", "lat_r", "lon_r", "n_points", "night_count", "score")


@register("home_location", GEO_WITH + """
SELECT h.user_id, h.c_lat AS home_latitude, h.c_lon AS home_longitude,
       round(CAST(h.n_points AS DOUBLE) / s.total * 100.0, 6) AS confidence, s.total AS sample_size,
       h.night_count AS night_occurrences
FROM home h JOIN stats s ON h.user_id = s.user_id""")
def home_location(t):
    """Home = centroid of the best cluster; confidence = 100 * cluster count / member total."""
    h = L.home_location(points_with_facility(t))
    return h.select("user_id", "home_latitude", "home_longitude",
                    F.round("confidence", 6).alias("confidence"), "sample_size", "night_occurrences")


@register("top2_clusters", GEO_WITH + "SELECT user_id, round(top2_min_km, 6) AS top2_min_km FROM top2")
def top2_clusters(t):
    """Smaller facility distance of the two most frequent clusters' centroids."""
    d = L.top2_cluster_distance(points_with_facility(t))
    return d.select("user_id", F.round("top2_min_km", 6).alias("top2_min_km"))


@register("distance_stats", GEO_WITH + """
SELECT user_id, total AS n_points, round(mean_km, 6) AS mean_km, round(std_km, 6) AS std_km
FROM stats WHERE total >= 3""")
def distance_stats(t):
    """Mean and population std of point distances, members with >= 3 points."""
    s = L.distance_stats(points_with_facility(t)).filter(F.col("n_points") >= config.MIN_POINTS_FOR_STATS)
    return s.select("user_id", "n_points", F.round("mean_km", 6).alias("mean_km"),
                    F.round("std_km", 6).alias("std_km"))


@register("member_location_join", GEO_WITH + """
SELECT user_id, count(*) AS n_points FROM pts GROUP BY user_id""")
def member_location_join(t):
    """Points joined to their member (one equi join, then group by member)."""
    return points_with_facility(t).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_points"))


@register("facility_coords_lookup", with_adapters("members", "facilities") + """
SELECT m.user_id, f.lat AS fac_lat, f.lon AS fac_lon,
       CASE WHEN f.lat IS NULL THEN 'no_club_coords' ELSE 'ok' END AS coords_status
FROM members m LEFT JOIN facilities f ON m.facility_id = f.facility_id""")
def facility_coords_lookup(t):
    """Facility -> coordinates as a broadcast dimension join; missing -> no_club_coords."""
    a = t.adapters
    fac = a.facilities.select("facility_id", F.col("lat").alias("fac_lat"),
                                                F.col("lon").alias("fac_lon"))
    j = a.members.select("user_id", "facility_id").join(fac, "facility_id", "left")
    return j.select("user_id", "fac_lat", "fac_lon",
                    F.when(F.col("fac_lat").isNull(), "no_club_coords").otherwise("ok").alias("coords_status"))


@register("cross_store_semi", GEO_WITH + "SELECT user_id, facility_name FROM mf")
def cross_store_semi(t):
    """Eligible members with a known facility that have any location document (left semi join)."""
    a = t.adapters
    owners = a.member_locations.select(F.col("user_id").cast("string").alias("user_id")).distinct()
    fac = a.facilities.select("facility_id", F.col("name").alias("facility_name"))
    m = (eligible_members(a.members).join(fac, "facility_id", "left")
         .select(F.col("user_id").cast("string").alias("user_id"),
                 F.coalesce("facility_name", F.lit("Unknown")).alias("facility_name")))
    return m.join(owners, "user_id", "left_semi").distinct()


@register("known_facility_filter", GEO_WITH + "SELECT user_id, facility_name FROM mf2")
def known_facility_filter(t):
    """Drop members whose facility is missing or 'Unknown'."""
    return cross_store_semi(t).filter(F.col("facility_name") != "Unknown")


@register("geo_metrics", GEO_WITH + "SELECT * FROM geo")
def geo_metrics(t):
    """The 12-column per-member location metric table."""
    return metrics(t)


@register("commute_score", GEO_WITH + """
SELECT user_id, commute_convenience_score FROM geo WHERE commute_convenience_score IS NOT NULL""")
def commute_score(t):
    """1 - (0.7 min(1, d/10) + 0.3 min(1, sd/5)), clamped, 4 decimals."""
    return metrics(t).filter(F.col("commute_convenience_score").isNotNull()).select(
        "user_id", "commute_convenience_score")


@register("geo_quality", GEO_WITH + "SELECT user_id, location_data_quality FROM geo")
def geo_quality(t):
    """Quality ladder: no_club_coords, no_user_data, insufficient, good, medium, poor."""
    return metrics(t).select("user_id", "location_data_quality")


@register("is_home_nearby", GEO_WITH + "SELECT user_id, is_home_nearby FROM geo")
def is_home_nearby(t):
    """Unrounded home -> facility distance below 2 km (false when unknown)."""
    return metrics(t).select("user_id", "is_home_nearby")


@register("geo_quality_summary", GEO_WITH + """
SELECT location_data_quality, count(*) AS members,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct
FROM geo GROUP BY location_data_quality""")
def geo_quality_summary(t):
    """Members per quality class with share (one aggregate, then a global share over <= 6 rows)."""
    g = metrics(t).groupBy("location_data_quality").agg(F.count(F.lit(1)).alias("members"))
    total = g.agg(F.sum("members").alias("s")).select("s").scalar()
    return g.withColumn("share_pct", F.round(F.col("members") * 100.0 / total, 6))


@register("geo_totals", GEO_WITH + """
SELECT count(*) AS members, count(*) FILTER (location_sample_size > 0) AS with_data,
       count(*) FILTER (location_data_quality = 'good') AS good FROM geo""")
def geo_totals(t):
    """Members in all, with location data, with good data."""
    return metrics(t).agg(F.count("*").alias("members"), F.count_if(F.col("location_sample_size") > 0).alias("with_data"),
                          F.count_if(F.col("location_data_quality") == "good").alias("good"))


@register("distance_distribution", GEO_WITH + """
SELECT round(avg(distance_home_to_club_km), 6) AS mean_km,
       round(quantile_cont(distance_home_to_club_km, 0.5), 6) AS median_km,
       round(avg(CASE WHEN distance_home_to_club_km < 2 THEN 1.0 ELSE 0.0 END) * 100, 6) AS within_2km_pct,
       round(avg(commute_convenience_score), 6) AS mean_score,
       round(quantile_cont(commute_convenience_score, 0.5), 6) AS median_score
FROM geo WHERE distance_home_to_club_km IS NOT NULL""")
def distance_distribution(t):
    """Mean/median distance, share within 2 km, mean/median score.

    Medians are exact (linear interpolation) but computed distributedly
    (``exact_quantiles``), not by buffering every member's value in one aggregate.
    """
    from renewlens.operators.quality import exact_quantiles

    m = metrics(t).filter(F.col("distance_home_to_club_km").isNotNull())
    d, s = F.col("distance_home_to_club_km"), F.col("commute_convenience_score")
    means = m.agg(F.round(F.avg(d), 6).alias("mean_km"),
                  F.round(F.avg(F.when(d < 2, 1.0).otherwise(0.0)) * 100, 6).alias("within_2km_pct"),
                  F.round(F.avg(s), 6).alias("mean_score"))
    long = m.select(F.explode(F.array(F.struct(F.lit("km").alias("k"), d.cast("double").alias("x")),
                                      F.struct(F.lit("score").alias("k"), s.cast("double").alias("x")))).alias("_s"))
    med = exact_quantiles(long.select("_s.*"), "k", "x", [0.5], method="linear")
    medians = med.groupBy().agg(F.round(F.max(F.when(F.col("k") == "km", F.col("value"))), 6).alias("median_km"),
                                F.round(F.max(F.when(F.col("k") == "score", F.col("value"))), 6).alias("median_score"))
    # two one-row results side by side: union, then one aggregate (no join)
    cols = ["mean_km", "median_km", "within_2km_pct", "mean_score", "median_score"]
    both = means.unionByName(medians, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in cols])


FEATURES_SQL = GEO_WITH + """
SELECT user_id, location_data_quality,
       avg_booking_distance_km - distance_home_to_club_km AS booking_vs_home_diff,
       CASE WHEN avg_booking_distance_km - distance_home_to_club_km > 3 THEN 'not_from_home'
            WHEN avg_booking_distance_km - distance_home_to_club_km < 0 THEN 'check_data'
            WHEN avg_booking_distance_km - distance_home_to_club_km IS NOT NULL THEN 'from_home' END AS booking_origin,
       commute_convenience_score * (home_location_confidence / 100.0) AS weighted_convenience,
       CASE WHEN distance_home_to_club_km > 0 AND distance_home_to_club_km <= 1 THEN '<1km'
            WHEN distance_home_to_club_km > 1 AND distance_home_to_club_km <= 2 THEN '1-2km'
            WHEN distance_home_to_club_km > 2 AND distance_home_to_club_km <= 3 THEN '2-3km'
            WHEN distance_home_to_club_km > 3 AND distance_home_to_club_km <= 5 THEN '3-5km'
            WHEN distance_home_to_club_km > 5 AND distance_home_to_club_km <= 10 THEN '5-10km'
            WHEN distance_home_to_club_km > 10 AND distance_home_to_club_km <= 100 THEN '>10km' END AS distance_bucket,
       distance_home_to_club_km * distance_variability AS distance_x_variability,
       CASE WHEN commute_convenience_score IS NULL THEN 'No Data'
            WHEN commute_convenience_score >= 0.8 THEN 'VIP Local'
            WHEN commute_convenience_score >= 0.6 THEN 'Regular Commuter'
            WHEN commute_convenience_score >= 0.4 THEN 'Casual Visitor' ELSE 'At Risk' END AS convenience_segment,
       CASE WHEN distance_variability < 3 THEN
              CASE WHEN distance_home_to_club_km < 2 THEN 'Local Stable'
                   WHEN distance_home_to_club_km < 5 THEN 'Commuter Stable' ELSE 'Distant Stable' END
            ELSE CASE WHEN distance_home_to_club_km < 3 THEN 'Local Chaotic' ELSE 'High Risk' END
       END AS distance_variability_segment,
       CASE WHEN distance_home_to_club_km IS NULL THEN NULL
            WHEN distance_home_to_club_km < 1 THEN '0-1km' WHEN distance_home_to_club_km < 3 THEN '1-3km'
            WHEN distance_home_to_club_km < 5 THEN '3-5km' WHEN distance_home_to_club_km < 10 THEN '5-10km'
            ELSE '>10km' END AS distance_band,
       CASE WHEN distance_variability IS NULL THEN NULL
            WHEN distance_variability < 2 THEN '0-2km' WHEN distance_variability < 5 THEN '2-5km'
            ELSE '>5km' END AS variability_band,
       location_data_quality IN ('good', 'medium') AS has_quality_location
FROM geo"""


def features(t):
    return L.geo_features(metrics(t))


def _feature_query(name, cols, doc):
    def q(t):
        return features(t).select("user_id", *cols)

    q.__doc__ = doc
    return register(name, f"SELECT user_id, {', '.join(cols)} FROM ({FEATURES_SQL}) f")(q)


_feature_query("booking_vs_home_diff", ["booking_vs_home_diff", "booking_origin"],
               "Average point distance minus home distance; >3 km = not from home, <0 = check data.")
_feature_query("weighted_convenience", ["weighted_convenience"], "Score x confidence / 100.")
_feature_query("distance_bucket", ["distance_bucket"], "Right-closed distance bins; 0 and >100 km -> null.")
_feature_query("distance_x_variability", ["distance_x_variability"], "Distance x variability interaction.")
_feature_query("segment_by_convenience", ["convenience_segment"], "Segments by commute score.")
_feature_query("segment_distance_variability", ["distance_variability_segment"],
               "Two-dimensional distance/variability segment.")
_feature_query("distance_band", ["distance_band"], "Expected-retention distance band.")
_feature_query("variability_band", ["variability_band"], "Variability band.")
_feature_query("geo_quality_flag", ["has_quality_location"], "Has usable location (good or medium).")


@register("geo_ml_filter", GEO_WITH + """
SELECT user_id, location_data_quality FROM geo
WHERE location_data_quality IN ('good', 'medium') AND location_sample_size >= 10 AND home_location_confidence >= 20""")
def geo_ml_filter(t):
    """Strict ML filter: good/medium, size >= 10, confidence >= 20."""
    return L.geo_ml_filter(metrics(t), "strict").select("user_id", "location_data_quality")


def _filter_query(mode, cond):
    def q(t):
        return L.geo_ml_filter(metrics(t), mode).select("user_id", "location_data_quality", "location_sample_size")

    q.__doc__ = f"Members whose location data serve the {mode} use."
    return register(f"geo_ml_filter_{mode}", GEO_WITH + f"""
SELECT user_id, location_data_quality, location_sample_size FROM geo WHERE {cond}""")(q)


_filter_query("analytic", "location_data_quality <> 'insufficient'")
_filter_query("segment", "location_sample_size > 0")
_filter_query("exploratory", "location_sample_size > 0 AND location_data_quality <> 'no_user_data'")


@register("segment_campaign", f"""
SELECT f.user_id, f.convenience_segment, c.criteria, c.action
FROM ({FEATURES_SQL}) f LEFT JOIN (VALUES {", ".join(f"('{s}', '{c}', '{a}')" for s, c, a in CFG.campaigns)})
  c(segment, criteria, action) ON f.convenience_segment = c.segment""")
def segment_campaign(t):
    """Segment -> criteria and action of the campaigns table (an input; its size decides how it is joined)."""
    campaigns = t.spark.createDataFrame(list(CFG.campaigns), "convenience_segment string, criteria string, action string")
    return features(t).select("user_id", "convenience_segment").join(campaigns, "convenience_segment", "left")


CUT = "2024-01-16 00:00:00"


def _geo_subquery(cut: str | None, run_ts: str) -> str:
    ctes = GEO_CTES
    if cut is not None:
        ctes = ("ml_cut AS (SELECT * FROM member_locations WHERE created_at < TIMESTAMP '" + cut + "'),\n"
                + ctes.strip().replace("FROM member_locations", "FROM ml_cut"))
    return (f"(WITH {ctes.strip()}\n SELECT user_id, '{run_ts}' AS run_ts, commute_convenience_score FROM geo)")


@register("convenience_trend", with_adapters("members", "facilities", "member_locations") + f"""
, snaps AS (SELECT * FROM {_geo_subquery(CUT, "20240115_000000")} a
            UNION ALL SELECT * FROM {_geo_subquery(None, "20240131_000000")} b)
SELECT user_id, run_ts, commute_convenience_score,
       round(commute_convenience_score - lag(commute_convenience_score) OVER (PARTITION BY user_id ORDER BY run_ts), 6)
         AS convenience_trend
FROM snaps""")
def convenience_trend(t):
    """Commute score change per member between metric snapshots (mid-month cut-off vs month end)."""
    a = t.adapters
    early = location_metrics(a, CFG, a.member_locations.filter(
        F.col("created_at") < F.lit(CUT).cast("timestamp_ntz"))).withColumn("run_ts", F.lit("20240115_000000"))
    full = metrics(t).withColumn("run_ts", F.lit("20240131_000000"))
    snaps = early.unionByName(full)
    tr = L.convenience_trend(snaps)
    return tr.withColumn("convenience_trend", F.round("convenience_trend", 6))
