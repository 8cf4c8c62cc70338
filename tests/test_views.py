from renewlens.plans.views import register_views
from tests.conftest import SF001


def test_sql_over_registered_marts(spark):
    names = register_views(spark, SF001, prefix="t_")
    assert "t_period_mart" in names and "t_member_profile" in names
    renewed = {r.renewed: r.n for r in spark.sql(
        "SELECT renewed, count(*) AS n FROM t_period_mart GROUP BY renewed").collect()}
    assert sum(renewed.values()) == 909
    holidays = spark.sql("SELECT count(*) AS n FROM t_calendar WHERE is_holiday").first().n
    assert holidays > 0
    one_row = spark.sql("SELECT count(*) = count(DISTINCT user_id) AS ok FROM t_member_profile").first().ok
    assert one_row
    q = spark.sql("""SELECT location_data_quality, count(*) AS n FROM t_location_metrics
                     GROUP BY location_data_quality""").collect()
    assert sum(r.n for r in q) > 0
