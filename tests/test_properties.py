"""Properties of the full tables on the small driver data."""

from pyspark.sql import functions as F
from pyspark.sql import Window


def test_hhi_bounds(inputs):
    h = inputs.hour_features
    n_hours = h.groupBy("station_complex", "year", "month").agg(F.count("*").alias("n"))
    from crowding.operators import stress

    joined = stress.concentration(h).join(n_hours, ["station_complex", "year", "month"])
    bad = joined.filter(
        (F.col("hhi_monthly_concentration") < 1 / F.col("n") - 1e-12)
        | (F.col("hhi_monthly_concentration") > 1 + 1e-12)
    )
    assert bad.count() == 0


def test_dense_ranks_contiguous(inputs):
    ranks = inputs.hours.select("year", "month", "monthly_rank").distinct()
    per = ranks.groupBy("year", "month").agg(
        F.max("monthly_rank").alias("mx"), F.count("*").alias("n"), F.min("monthly_rank").alias("mn")
    )
    assert per.filter((F.col("mx") != F.col("n")) | (F.col("mn") != 1)).count() == 0


def test_flag_implies_percentiles(inputs):
    bad = inputs.csi.filter(
        (F.col("danger_zone") == 1) & ((F.col("csi_pctl") < 0.9) | (F.col("apt_minutes_pctl") < 0.9))
    )
    assert bad.count() == 0


def test_rolling_matches_definition(inputs):
    w = Window.partitionBy("station_complex_id").orderBy("year", "month").rowsBetween(-5, 0)
    ref = inputs.flagged.withColumn("r", F.avg("csi").over(w))
    joined = ref.join(inputs.csi.select("station_complex_id", "year", "month", "csi_6mo_rolling"),
                      ["station_complex_id", "year", "month"])
    assert joined.filter(F.abs(F.col("r") - F.col("csi_6mo_rolling")) > 1e-12).count() == 0


def test_rows_survive_hour_join(inputs):
    from crowding.operators import features

    assert inputs.hours.count() == features.hourly_fact(inputs.raw).count()


def test_stress_from_stored_moments_equals_stress_index(inputs):
    from crowding.operators import stress

    direct = stress.stress_index(inputs.hour_features, 123.0)
    stored = stress.stress_from_moments(inputs.moments_stored, 123.0)
    cols = ["station_complex", "station_complex_id", "borough", "year", "month"]
    a = direct.select(*cols, F.round("csi", 12).alias("csi"))
    b = stored.select(*cols, F.round("csi", 12).alias("csi"))
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
