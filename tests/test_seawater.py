"""Seawater expressions against published check values."""

import pytest
from pyspark.sql import functions as F

from thermocline.functions import seawater as sw


def test_check_values(spark):
    # published check profile: absolute salinity, temperature, pressure -> conservative temperature, density
    profile = [
        (34.7118, 28.7856, 10.0, 28.809919826700281, 1021.839935738108),
        (34.8915, 28.4329, 50.0, 28.439227816091140, 1022.262457966867),
        (35.0256, 22.8103, 125.0, 22.786176893078498, 1024.427195413316),
        (34.8472, 10.2600, 250.0, 10.226189266620782, 1027.790152759127),
        (34.7366, 6.8863, 600.0, 6.827213633479988, 1029.837779000189),
        (34.7324, 4.4036, 1000.0, 4.323575748610455, 1032.002453224572),
    ]
    df = spark.createDataFrame(profile, "sa double, temperature double, pressure double, ct double, density double")
    for r in sw.with_seawater(df.withColumn("salinity", F.col("sa") * 35.0 / 35.16504)).collect():
        assert r.potential_temperature == pytest.approx(r.ct, abs=1e-8)
        assert r.rho == pytest.approx(r.density, abs=1e-3)


def test_density_check(spark):
    # specific volume of standard seawater at 0 degC and 0 dbar
    df = spark.createDataFrame([(0.0, 0.0, 35.0)], "temperature double, pressure double, salinity double")
    row = sw.with_seawater(df).first()
    assert row.potential_temperature == pytest.approx(0.0, abs=1e-6)
    assert row.rho == pytest.approx(1028.107, abs=0.01)


def test_practical_salinity(spark):
    # conductivity ratio 1 at 15 degC (1968 scale) is 35 by definition
    text = sw.practical_salinity("42.914e0", "(15e0/1.00024e0)", "0e0")
    assert spark.range(1).select(F.expr(text)).first()[0] == pytest.approx(35.0, abs=1e-6)


def test_depth(spark):
    deep = spark.range(1).select(F.expr(sw.depth_from_pressure("1000e0", "30e0"))).first()[0]
    assert deep == pytest.approx(991.0, abs=1.0)


def test_oxygen_solubility_check_value(spark):
    """Published check: 274.610 micromoles a kilogram at 10 degrees and 35 (density 1026.952); the terms in use differ by 0.01 % there."""
    from pyspark.sql import functions as F

    from thermocline.operators import derived as dv

    df = spark.createDataFrame([(10.0, 35.0), (0.0, 35.0)], "temperature double, salinity double").withColumn("ts", F.expr(dv._scaled_temperature("temperature")))
    out = df.select(F.expr(dv.oxygen_solubility("ts", dv.MOLAR_B)).alias("published"), F.expr(dv.oxygen_solubility("ts", dv.SOLUBILITY_B)).alias("used")).collect()
    assert abs(out[0].published * dv.MICROMOLES_PER_ML / 1.026952 - 274.610) < 0.01
    assert 0 < out[0].used / out[0].published - 1 < 2e-4 and 0.002 < out[1].used / out[1].published - 1 < 0.003
