"""Home location and commute metrics from raw coordinates.

Points are aggregated per member and cell once (partial, map-side combined) and the
cells rolled up to the member; the member -> facility coordinates side is joined once.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens import config
from renewlens.functions.bands import band_below, right_closed_bins
from renewlens.functions.geo import haversine_km, is_night
from renewlens.functions.scores import commute_score, geo_quality
from renewlens.functions.stats import exact_mean
from renewlens.operators.ranking import top1_by, top_k_by


def flatten_location(docs: DataFrame, id_col: str = "user_id", loc_col: str = "location",
                     ts_col: str = "created_at") -> DataFrame:
    """Pull latitude/longitude out of the nested location, id as string, keep rows with both."""
    return (docs.select(F.col(id_col).cast("string").alias("user_id"),
                        F.col(f"{loc_col}.latitude").alias("latitude"),
                        F.col(f"{loc_col}.longitude").alias("longitude"),
                        F.col(ts_col).alias("created_at"))
            .filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
                    & ~F.isnan("latitude") & ~F.isnan("longitude")))


def with_cluster_keys(points: DataFrame, precision: int = config.COORD_PRECISION,
                      utc_offset_hours: int = config.LOCAL_UTC_OFFSET_HOURS) -> DataFrame:
    return points.withColumns({
        "lat_r": F.round("latitude", precision),
        "lon_r": F.round("longitude", precision),
        "is_night": is_night("created_at", utc_offset_hours),
    })


def home_clusters(points: DataFrame, precision: int = config.COORD_PRECISION,
                  night_weight: int = config.NIGHT_WEIGHT,
                  utc_offset_hours: int = config.LOCAL_UTC_OFFSET_HOURS) -> DataFrame:
    """Per (member, rounded cell): centroid of raw coords (order-independent exact mean),
    count, night count, score."""
    return (with_cluster_keys(points, precision, utc_offset_hours)
            .groupBy("user_id", "lat_r", "lon_r")
            .agg(exact_mean("latitude").alias("c_lat"), exact_mean("longitude").alias("c_lon"),
                 F.count(F.lit(1)).alias("n_points"),
                 F.sum(F.col("is_night").cast("long")).alias("night_count"))
            .withColumn("score", F.col("n_points") + night_weight * F.col("night_count")))


def home_top1(clusters: DataFrame, extra_aggs=()) -> DataFrame:
    """Best cluster per member: score desc, then ascending (lat_r, lon_r)."""
    return top1_by(clusters, ["user_id"], [F.col("score"), -F.col("lat_r"), -F.col("lon_r")],
                   descending=True, payload=["lat_r", "lon_r", "c_lat", "c_lon", "n_points", "night_count", "score"],
                   extra_aggs=extra_aggs)


def home_location(points: DataFrame, precision: int = config.COORD_PRECISION,
                  night_weight: int = config.NIGHT_WEIGHT,
                  utc_offset_hours: int = config.LOCAL_UTC_OFFSET_HOURS) -> DataFrame:
    """Home = centroid of the best cluster; confidence = 100 * cluster count / member total."""
    clusters = home_clusters(points, precision, night_weight, utc_offset_hours)
    # the member total is the sum of its cluster counts: same aggregation, points read once
    best = home_top1(clusters, extra_aggs=[F.sum("n_points").alias("sample_size")])
    return (best
            .select("user_id", F.col("c_lat").alias("home_latitude"), F.col("c_lon").alias("home_longitude"),
                    (F.col("n_points") / F.col("sample_size") * 100.0).alias("confidence"),
                    "sample_size", F.col("night_count").alias("night_occurrences")))


def top2_cluster_distance(points_with_facility: DataFrame, precision: int = config.COORD_PRECISION) -> DataFrame:
    """Smaller facility distance of the centroids of the two most frequent clusters."""
    clusters = (points_with_facility
                .withColumns({"lat_r": F.round("latitude", precision), "lon_r": F.round("longitude", precision)})
                .groupBy("user_id", "lat_r", "lon_r")
                .agg(exact_mean("latitude").alias("c_lat"), exact_mean("longitude").alias("c_lon"),
                     F.count(F.lit(1)).alias("n_points"),
                     F.first("fac_lat").alias("fac_lat"), F.first("fac_lon").alias("fac_lon")))
    top2 = top_k_by(clusters, ["user_id"], [F.col("n_points").desc(), F.col("lat_r"), F.col("lon_r")], 2)
    return (top2.groupBy("user_id")
            .agg(F.min(haversine_km("c_lat", "c_lon", "fac_lat", "fac_lon")).alias("top2_min_km")))


def distance_stats(points_with_facility: DataFrame) -> DataFrame:
    """Per member: count, mean and population std of point -> facility distances."""
    d = haversine_km("latitude", "longitude", "fac_lat", "fac_lon")
    return (points_with_facility.groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("n_points"), F.avg(d).alias("mean_km"), F.stddev_pop(d).alias("std_km")))


def cell_aggregates(points_with_facility: DataFrame, precision: int = config.COORD_PRECISION,
                    night_weight: int = config.NIGHT_WEIGHT,
                    utc_offset_hours: int = config.LOCAL_UTC_OFFSET_HOURS) -> DataFrame:
    """One pass over the points: per (member, cell) centroid, count, night count, score, facility
    coordinates, and count-weighted mean and squared deviations of the distances to the facility."""
    d = haversine_km("latitude", "longitude", "fac_lat", "fac_lon")
    p = with_cluster_keys(points_with_facility, precision, utc_offset_hours).withColumn("_d", d)
    return (p.groupBy("user_id", "lat_r", "lon_r")
            .agg(F.count(F.lit(1)).alias("n_points"), exact_mean("latitude").alias("c_lat"),
                 exact_mean("longitude").alias("c_lon"), F.sum(F.col("is_night").cast("long")).alias("night_count"),
                 F.avg("_d").alias("cell_km"), F.var_pop("_d").alias("cell_var"),
                 F.max("fac_lat").alias("fac_lat"), F.max("fac_lon").alias("fac_lon"))
            .withColumn("score", F.col("n_points") + night_weight * F.col("night_count")))


def member_aggregates(cells: DataFrame) -> DataFrame:
    """Cells rolled up to the member: home cell, sample size, mean and population std of the
    distances (pooled from the cells' means and variances), least distance of the two fullest cells.

    Home, totals and spread are partial aggregates, combined below the shuffle; the two fullest cells are
    limited to two per member and task below theirs.  No task gets all cells of a member.

    The spread between cells is summed about zero, so means are split into whole metres, whose sums of products are exact,
    and the rest, whose products are small.
    """
    n, metres = F.col("n_points"), F.col("cell_km") * 1000
    whole = F.round(metres).cast("decimal(20,0)")
    rest = metres - whole.cast("double")
    count, exact = n.cast("decimal(20,0)"), lambda c: F.sum(c).cast("decimal(38,0)")
    first = F.min(F.struct((-F.col("score")).alias("rank"), "lat_r", "lon_r", "c_lat", "c_lon", "n_points"))
    sums = cells.groupBy("user_id").agg(
        first.alias("home"), F.sum("n_points").alias("sample_size"), F.sum(n * F.col("cell_var")).alias("_inner"),
        exact(count * whole).alias("_w"), exact(count * whole * whole).alias("_ww"), F.sum(n * rest).alias("_r"),
        F.sum(n * rest * rest).alias("_rr"), F.sum(n * rest * whole.cast("double")).alias("_wr"))
    total, w, r = F.col("sample_size").cast("double"), F.col("_w").cast("double"), F.col("_r")
    squares = (F.col("sample_size").cast("decimal(20,0)") * F.col("_ww") - F.col("_w") * F.col("_w")).cast("double") / total / total
    mixed = (F.col("_wr") - w * r / total) / total
    between = (squares + 2 * mixed + F.col("_rr") / total - F.pow(r / total, 2)) / 1e6
    top2 = top_k_by(cells, ["user_id"], [F.col("n_points").desc(), F.col("lat_r"), F.col("lon_r")], 2)
    near = top2.groupBy("user_id").agg(F.min(haversine_km("c_lat", "c_lon", "fac_lat", "fac_lon")).alias("top2_min_km"))
    return (sums.join(near, "user_id", "left")
            .select("user_id", F.col("home.c_lat").alias("home_latitude"), F.col("home.c_lon").alias("home_longitude"),
                    F.col("home.n_points").alias("top_n"), "sample_size", ((w + r) / total / 1000).alias("mean_km"),
                    F.sqrt(F.greatest(F.col("_inner") / total + between, F.lit(0.0))).alias("std_km"), "top2_min_km",
                    (F.col("home.n_points") / F.col("sample_size") * 100.0).alias("confidence")))


POINTS_PER_TASK = 100_000


def geo_metrics(points: DataFrame, member_facility: DataFrame, facility_coords: DataFrame,
                precision: int = config.COORD_PRECISION, night_weight: int = config.NIGHT_WEIGHT,
                utc_offset_hours: int = config.LOCAL_UTC_OFFSET_HOURS) -> DataFrame:
    """The 12-column location metric table, one row per member of ``member_facility``.

    Home coordinates are the unrounded centroid; the mart schema (``conform``)
    applies the column precision at the sink.  Only the count of the points runs before the result is used.

    points:          user_id (string), latitude, longitude, created_at (non-null coords)
    member_facility: user_id (string), facility_name — the members to score
    facility_coords: facility_name, fac_lat, fac_lon (only facilities with coordinates)
    """
    mf = member_facility.join(facility_coords, "facility_name", "left")
    # points are the big side; a task's share of them is bounded by rows, as cells need far more memory than AQE sees in
    # their shuffled bytes
    parts = math.ceil(points.count() / POINTS_PER_TASK)
    if parts > 8:
        points = points.repartition(parts, "user_id")
    pts = points.join(mf.filter(F.col("fac_lat").isNotNull()).select("user_id", "fac_lat", "fac_lon"), "user_id")
    home = member_aggregates(cell_aggregates(pts, precision, night_weight, utc_offset_hours))

    m = mf.join(home, "user_id", "left")
    has_coords = F.col("fac_lat").isNotNull()
    n = F.coalesce(F.col("sample_size"), F.lit(0))
    scored = has_coords & (n > 0)
    enough = scored & (n >= config.MIN_POINTS_FOR_STATS)
    d_home = haversine_km("home_latitude", "home_longitude", "fac_lat", "fac_lon")
    variability = F.round(F.when(n > 1, F.col("std_km")).otherwise(F.lit(0.0)), 2)
    return m.select(
        "user_id",
        F.when(scored, F.col("home_latitude")).alias("home_latitude"),
        F.when(scored, F.col("home_longitude")).alias("home_longitude"),
        F.when(scored, F.round("confidence", 2)).alias("home_location_confidence"),
        F.when(scored, n).otherwise(F.lit(0)).cast("long").alias("location_sample_size"),
        F.when(scored, F.round(d_home, 2)).alias("distance_home_to_club_km"),
        F.when(enough, F.round("mean_km", 2)).alias("avg_booking_distance_km"),
        F.when(enough, F.round("top2_min_km", 2)).alias("min_booking_distance_km"),
        F.when(enough, variability).alias("distance_variability"),
        F.when(scored, d_home < config.NEARBY_KM).otherwise(F.lit(False)).alias("is_home_nearby"),
        F.when(enough, commute_score(d_home, variability)).alias("commute_convenience_score"),
        geo_quality(has_coords, F.when(has_coords, n), F.col("confidence")).alias("location_data_quality"),
    )


# ---- documented location features --------------------------------------------------

def geo_features(metrics: DataFrame) -> DataFrame:
    """Derived features of the metric table (differences, products, buckets, segments, bands)."""
    d, v = F.col("distance_home_to_club_km"), F.col("distance_variability")
    s, conf = F.col("commute_convenience_score"), F.col("home_location_confidence")
    diff = F.col("avg_booking_distance_km") - d
    stable = v < config.STABLE_VARIABILITY_KM
    adv = F.when(stable, band_below(d, config.STABLE_SEGMENTS, config.STABLE_SEGMENT_ELSE, config.STABLE_SEGMENT_ELSE))
    adv = adv.otherwise(band_below(d, config.CHAOTIC_SEGMENTS, config.CHAOTIC_SEGMENT_ELSE, config.CHAOTIC_SEGMENT_ELSE))
    return metrics.select(
        "user_id", "location_data_quality",
        diff.alias("booking_vs_home_diff"),
        F.when(diff > 3, "not_from_home").when(diff < 0, "check_data").when(diff.isNotNull(), "from_home")
        .alias("booking_origin"),
        (s * (conf / 100.0)).alias("weighted_convenience"),
        right_closed_bins(d, config.DISTANCE_BUCKET_EDGES, config.DISTANCE_BUCKET_LABELS).alias("distance_bucket"),
        (d * v).alias("distance_x_variability"),
        segment_by_convenience(s).alias("convenience_segment"),
        adv.alias("distance_variability_segment"),
        F.when(d.isNotNull(), band_below(d, config.DISTANCE_BANDS, config.DISTANCE_BAND_ELSE)).alias("distance_band"),
        F.when(v.isNotNull(), band_below(v, config.VARIABILITY_BANDS, config.VARIABILITY_BAND_ELSE))
        .alias("variability_band"),
        F.col("location_data_quality").isin("good", "medium").alias("has_quality_location"),
    )


def convenience_trend(snapshots: DataFrame, score: str = "commute_convenience_score",
                      run_col: str = "run_ts") -> DataFrame:
    """Score minus the member's score in the previous snapshot (rows per member = snapshots)."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy(run_col)
    return snapshots.select("user_id", run_col, score,
                            (F.col(score) - F.lag(score).over(w)).alias("convenience_trend"))


def segment_by_convenience(score):
    s = F.col(score) if isinstance(score, str) else score
    expr = F.when(s.isNull(), config.CONVENIENCE_SEGMENT_NULL)
    for edge, label in config.CONVENIENCE_SEGMENTS:
        expr = expr.when(s >= edge, label)
    return expr.otherwise(config.CONVENIENCE_SEGMENT_ELSE)


def geo_ml_filter(metrics: DataFrame, mode: str = "strict") -> DataFrame:
    """strict: good/medium & size >= 10 & confidence >= 20; analytic: not insufficient;
    segment: size > 0; exploratory: size > 0 and not no_user_data."""
    q, n, c = F.col("location_data_quality"), F.col("location_sample_size"), F.col("home_location_confidence")
    cond = {
        "strict": q.isin("good", "medium") & (n >= 10) & (c >= 20),
        "analytic": q != "insufficient",
        "segment": n > 0,
        "exploratory": (n > 0) & (q != "no_user_data"),
    }[mode]
    return metrics.filter(cond)
