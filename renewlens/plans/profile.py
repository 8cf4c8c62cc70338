"""Member profile: one row per eligible member.

Every per-member input is reduced to one row per member *before* it is joined
(top-1 aggregates, counts, pivots, distinct flags), so the eleven left joins
never fan out and all sides arrive hash-partitioned on the member id.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens import config
from renewlens.config import DomainConfig
from renewlens.functions.bands import band_below
from renewlens.functions.dates import age_years, parse_day_month_year
from renewlens.operators.location import flatten_location, geo_metrics
from renewlens.operators.ranking import earliest_by, first_k_pivot, latest_by
from renewlens.operators.semijoin import exclude, exists_flag, membership_flag
from renewlens.operators.survey import answer_classify
from renewlens.plans.periods import correct_facility, paid_plans, rules_table
from renewlens.sources.schemas import GEO_DEFAULTS

ORDINALS = ("first", "second", "third", "fourth", "fifth")


def eligible_members(members: DataFrame) -> DataFrame:
    return members.filter((F.col("role") == "user") & F.col("partnership").isNull())


def age_band(age) -> F.Column:
    return band_below(age, config.AGE_BANDS, config.AGE_BAND_ELSE, config.AGE_BAND_NULL)


def base_members(members: DataFrame, as_of: date) -> DataFrame:
    birth = parse_day_month_year("birthday")
    return (eligible_members(members)
            .withColumn("birth_dt", birth)
            .withColumn("age", F.when(F.col("birth_dt").isNotNull(), age_years("birth_dt", F.lit(as_of)))))


def facility_fallback(df: DataFrame, primary: DataFrame, secondary: DataFrame, id_col: str, out: str) -> DataFrame:
    """Name from the primary facility table, else from the secondary one."""
    p = primary.groupBy(F.col("facility_id").alias(id_col)).agg(F.min("name").alias("_p"))
    s = secondary.groupBy(F.col("facility_id").alias(id_col)).agg(F.min("name").alias("_s"))
    return (df.join(p, id_col, "left").join(s, id_col, "left")
            .withColumn(out, F.coalesce("_p", "_s")).drop("_p", "_s"))


def asked_answers(answers: DataFrame, questions: DataFrame) -> DataFrame:
    """Answers with the text of their question; answers to unknown questions go."""
    return answers.join(questions.groupBy("question_id").agg(F.min("question").alias("question")), "question_id")


def attended_trials(attendance: DataFrame, events: DataFrame) -> DataFrame:
    """Trial events with who attended them; attendance of unknown events goes."""
    return attendance.join(events, "event_id")


def paid_member_periods(periods: DataFrame, plans: DataFrame, paid: Sequence[str]) -> DataFrame:
    """Inner join with the paid-plan dimension (the plan-name filter makes the left join inner)."""
    return periods.join(paid_plans(plans, paid), "plan_id")


def latest_membership(periods: DataFrame, plans: DataFrame, facilities: DataFrame, paid: Sequence[str]) -> DataFrame:
    p = paid_member_periods(periods, plans, paid)
    fac = facilities.groupBy("facility_id").agg(F.min("name").alias("period_facility"))
    p = p.join(fac, "facility_id", "left")
    return latest_by(p, ["user_id"], [F.col("created_at")], [F.col("period_id")],
                     payload=["period_id", "period_facility", "created_at"])


def latest_body_test(body_tests: DataFrame) -> DataFrame:
    return latest_by(body_tests, ["user_id"], [F.col("tested_at")], [F.col("test_id")],
                     payload=["test_id", "weight", "height", "fat_pct", "bmi"])


def latest_friend_count(friend_counts: DataFrame) -> DataFrame:
    return latest_by(friend_counts, ["user_id"], [F.col("as_of")], [F.col("row_id")], payload=["row_id", "friends"])


def post_counts(posts: DataFrame, status: str = "posted") -> DataFrame:
    return (posts.filter(F.col("status") == status).groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("feed_posts_total")))


def first_five_periods(periods: DataFrame, plans: DataFrame, paid: Sequence[str]) -> DataFrame:
    p = paid_member_periods(periods, plans, paid)
    order = [F.col("start_date").asc_nulls_last(), F.col("period_id").asc()]
    return first_k_pivot(p, "user_id", order, {"_start": "start_date", "_end": "end_date", "_plan": "plan_name"},
                         k=5, names=ORDINALS)


def earliest_trial(trials: DataFrame) -> DataFrame:
    t = trials.withColumn("trial_kind", F.coalesce("trial_kind", F.lit("")))
    return earliest_by(t, ["user_id"], [F.col("trial_start")], [F.col("event_id")],
                       payload=["event_id", "trial_start", "trial_kind"])


def trial_payment(earliest: DataFrame, payments: DataFrame, cfg: DomainConfig) -> DataFrame:
    """'gift' when a matching payment satisfies the rule of the trial kind, else 'paid'.

    Payments are reduced to one row per (member, event) with two flags before the
    join (the EXISTS subqueries become one left equi join).
    """
    g = cfg.trial_gifts
    flags = (payments.groupBy("user_id", "event_id")
             .agg(F.max(F.col("name").startswith(g.gift_prefix)).alias("named_gift"),
                  F.max(((F.col("amount") == 0) | F.col("amount").isNull()) & F.col("type").isin(*g.free_types))
                  .alias("free_gift")))
    j = earliest.join(flags, ["user_id", "event_id"], "left")
    kind = F.col("trial_kind")
    gift = ((kind.isin(*g.named_kinds) & F.coalesce("named_gift", F.lit(False)))
            | (kind.isin(*g.free_kinds) & F.coalesce("free_gift", F.lit(False))))
    return j.select("user_id", "event_id", "trial_start", "trial_kind",
                    F.when(gift, "gift").otherwise("paid").alias("trial_payment"))


def test_exclusions(test_accounts: DataFrame, pass_type: str) -> DataFrame:
    return test_accounts.filter(F.col("free_pass_type") == pass_type).select("user_id").distinct()


def location_metrics(a, cfg: DomainConfig, locations: DataFrame | None = None) -> DataFrame:
    """Geo metrics for eligible members with a known facility and any location document
    (``locations`` overrides the location documents, e.g. those seen by a cut-off)."""
    points_all = locations if locations is not None else a.member_locations
    # one row per owner before the shuffle, however many points a member has
    owners = points_all.select(F.col("user_id").cast("string").alias("user_id")).distinct()
    fac = a.facilities
    mf = (eligible_members(a.members)
          .join(fac.groupBy("facility_id").agg(F.min("name").alias("facility_name")),
                "facility_id", "left")
          .withColumn("facility_name", F.coalesce("facility_name", F.lit("Unknown")))
          .filter(F.col("facility_name") != "Unknown")
          .select(F.col("user_id").cast("string").alias("user_id"), "facility_name")
          .join(owners, "user_id", "left_semi").distinct())
    at = F.min(F.struct("lat", "lon"))
    coords = (fac.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
              .groupBy(F.col("name").alias("facility_name"))
              .agg(at["lat"].alias("fac_lat"), at["lon"].alias("fac_lon")))
    return geo_metrics(flatten_location(points_all), mf, coords)


def merge_geo(profile: DataFrame, geo: DataFrame) -> DataFrame:
    """Left join geo metrics; members without a row get sample 0, nearby false, quality 'none'."""
    # the narrow side's key is cast, so that the wide profile keeps its partitioning
    g = geo.withColumn("user_id", F.col("user_id").try_cast(profile.schema["user_id"].dataType))
    return profile.join(g, "user_id", "left").fillna(GEO_DEFAULTS)


def member_profile(a, cfg: DomainConfig, as_of: date, spark, geo: DataFrame | None = None) -> DataFrame:
    """The wide profile.  ``geo`` is a precomputed location-metric table (e.g. the newest
    snapshot written by the location job); computed here when not given."""
    return merge_geo(profile_without_location(a, cfg, as_of, spark), geo if geo is not None else location_metrics(a, cfg))


def profile_without_location(a, cfg: DomainConfig, as_of: date, spark) -> DataFrame:
    """All columns of the profile that need no location point."""
    paid = cfg.paid_plans
    base = base_members(a.members, as_of)
    base = exclude(base, test_exclusions(a.test_accounts, cfg.excluded_pass_type), ["user_id"])
    base = facility_fallback(base, a.facility_names, a.facilities, "facility_id", "profile_facility")

    hp = latest_membership(a.periods, a.plans, a.facilities, paid).select(
        "user_id", "period_facility", F.col("created_at").alias("latest_created_at"))
    body = latest_body_test(a.body_tests).drop("test_id")
    friends = latest_friend_count(a.friend_counts).drop("row_id")
    posts = post_counts(a.posts)
    answers = answer_classify(asked_answers(a.answers, a.questions), cfg.answer_rules)
    five = first_five_periods(a.periods, a.plans, paid)
    trial = trial_payment(earliest_trial(attended_trials(a.trial_attendance, a.trial_events)), a.payments, cfg).drop("event_id")

    p = base
    for side in (body.withColumnsRenamed({"weight": "test_weight", "height": "test_height"}), hp, friends, posts,
                 answers, five, trial):
        p = p.join(side, "user_id", "left")
    p = membership_flag(p, a.groups, "user_id", ["admin"], ["users", "mentors"], "in_group")

    fac_name = F.coalesce("period_facility", "profile_facility")
    ref_date = F.coalesce(F.to_date("latest_created_at"), F.col("created_date"), F.lit(as_of))
    p = p.withColumn("_fac", fac_name).withColumn("_ref", ref_date)
    p = correct_facility(p, "_fac", "_ref", rules_table(spark, cfg.facility_rules), "facility_corr")
    city = F.coalesce(F.create_map(*[x for k, v in cfg.city_by_facility.items() for x in (F.lit(k), F.lit(v))])
                      [F.col("facility_corr")], F.lit(cfg.default_city))
    trial_before = F.coalesce(F.col("first_start").isNotNull() & (F.col("trial_start") < F.col("first_start")),
                              F.lit(False))
    lifestyle = cfg.answer_rules[0].name
    others = [r.name for r in cfg.answer_rules[1:]]
    cols = [
        "user_id", "nickname", "firstname", "lastname", "phone", "gender", "birthday", "age", "created_date",
        F.coalesce("test_weight", "weight").alias("weight_kg"),
        F.coalesce("test_height", "height").alias("height_cm"),
        age_band(F.col("age")).alias("age_band"),
        F.col("fat_pct").alias("fat_pct_latest"), F.col("bmi").alias("bmi_latest"),
        "facility_corr", city.alias("city"), "in_group",
        F.coalesce("friends", F.lit(0)).alias("friends_cnt"),
        F.coalesce("feed_posts_total", F.lit(0)).cast("long").alias("feed_posts_total"),
        F.col(lifestyle).cast("boolean").alias(f"{lifestyle}_flag"), *others,
    ]
    for o in ORDINALS:
        cols += [f"{o}_start", f"{o}_end", f"{o}_plan"]
    cols += [F.col("first_start").isNotNull().alias("ever_member"),
             trial_before.alias("trial_before_first"),
             F.when(trial_before, F.col("trial_kind")).alias("trial_type"),
             F.when(trial_before, F.col("trial_payment")).alias("trial_payment")]
    return p.select(*cols)
