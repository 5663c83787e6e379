"""The second exchange format and delimited text: names, flags, clocks, odd values."""

import pytest
from pyspark.sql import functions as F

from thermocline.operators import publish as pb
from thermocline.operators import second_format as sx
from thermocline.operators.align import one_axis

MAP = "role string, source string, target string, vocabulary string"


def mapping(spark, *rows):
    return spark.createDataFrame([("parameter", s, t, "") for s, t in rows], MAP)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_blocks_fold_on_one_axis(spark):
    a = spark.createDataFrame([("A", 1, 5.0), ("A", 1, 7.0), ("A", 2, None), ("B", 1, 1.0)], "glider_id string, t_s long, x double")
    b = spark.createDataFrame([("A", 1, "u"), ("A", 9, "v")], "glider_id string, t_s long, y string")
    assert rows(one_axis([a, b])) == rows(one_axis([b, a]).select("glider_id", "t_s", "x", "y")) == [
        ("A", 1, 7.0, "u"), ("A", 2, None, None), ("A", 9, None, "v"), ("B", 1, 1.0, None)
    ]
    assert one_axis([a.limit(0), b.limit(0)]).count() == 0
    with pytest.raises(ValueError):
        one_axis([a, a])


def test_flags_follow_their_parameter(spark):
    """A parameter that finds its target taken goes with its flag, also where the first has no flag."""
    m = spark.createDataFrame(
        [("A", 10.0, 1.0, 2.0, 1, 3.0, 4), ("A", 99999.0, 1.0, 2.0, 1, 3.0, 4), ("A", 11.0, 99999.0, 99999.0, -128, 3.0, 4), ("A", None, 1.0, 1.0, 1, 1.0, 1)],
        "glider_id string, TIME double, TEMP double, DOXY double, DOXY_QC int, CDOM double, CDOM_QC int",
    )
    out = sx.second_table({"measurement": m}, mapping(spark, ("TEMP", "T"), ("DOXY", "T"), ("CDOM", "TBD"), ("TIME", "X"), ("glider_id", "X")))
    assert out.columns == ["glider_id", "TIME", "T"]
    assert rows(out) == [("A", 10.0, 1.0)]  # no stamp, no value: no row
    assert sx.second_table({"measurement": m}, mapping(spark)).count() == 0
    assert rows(sx.second_table({"measurement": m}, mapping(spark, ("DOXY", "O"), ("DOXY", "TBD"), ("DOXY", "P")))) == [("A", 10.0, 2.0, 1.0)]


def test_sensors_without_names(spark):
    m = spark.createDataFrame([("parameter", "TEMP", "T", ""), ("sensor_maker", "x", "TBD", ""), ("sensor_type", "CTD", "probe", "v")], MAP)
    par = spark.createDataFrame([("A", "TEMP", "CTD"), ("A", "TEMP", "CTD"), ("A", "NONE", "CTD"), ("B", "PRES", "other")], "glider_id string, parameter string, sensor string")
    sen = spark.createDataFrame([("A", "b", "CTD", "x", None, "2"), ("A", "a", "CTD", "x", "", "1")], "glider_id string, slot string, sensor string, maker string, model string, serial string")
    dates = spark.createDataFrame([("A", "NONE", "20240102030405"), ("A", "TEMP", "20240202030405"), ("A", "TEMP", ""), ("B", "PRES", None)], "glider_id string, parameter string, date string")
    cols = ["glider_id", "parameter", "sensor_type", "sensor_type_vocabulary", "sensor_maker", "sensor_model", "serial", "calibration_date"]
    assert rows(sx.second_sensors(par, sen, m, dates, prefix="X_").select(*cols)) == [
        ("A", "T", "probe", "v", "X_x", "", "1", "2024-01-02"), ("B", "DEPTH", "X_other", "", "", "", "", "")
    ]
    assert {r.calibration_date for r in sx.second_sensors(par, sen, m).collect()} == {""}


def test_delimited_text_comes_back(spark, tmp_path):
    odd = ['a;b', 'say "x"', "  blanks ", "back\\slash", "", None, "a\tb", "two\nlines"]
    df = spark.createDataFrame([("G", f"2024/0{1 + k % 2}/03 00:00:0{k}", k * 0.1 if k else None, t) for k, t in enumerate(odd)] + [("H", None, 1.0, "x")], "glider_id string, DATE string, v double, note string")
    pb.write_delimited(df, str(tmp_path / "out"))
    assert rows(pb.read_delimited(spark, str(tmp_path / "out"), df)) == rows(
        df.withColumn("note", F.nullif(F.translate("note", "\n", " "), F.lit("")))
    )
    pb.write_delimited(df.limit(0), str(tmp_path / "none"))


def test_adjusted_columns_have_flags(spark):
    df = spark.createDataFrame([("A", 0, 1.0, 2.0, 3, 1.5, 4.0, 5.0, 2)], "glider_id string, t_s long, latitude double, longitude double, temperature_QC int, temperature double, temperature_processed double, salinity double, salinity_adjusted_QC int")
    out = pb.export_adjusted(df.withColumn("salinity_adjusted", df.salinity), {"temperature": "TEMP", "salinity": "PSAL"})
    assert out.columns[4:] == ["TEMP", "TEMP_QC", "TEMP_ADJUSTED", "TEMP_ADJUSTED_QC", "PSAL", "PSAL_QC", "PSAL_ADJUSTED", "PSAL_ADJUSTED_QC"]
    assert tuple(out.first())[4:] == (1.5, 3, 4.0, 3, 5.0, 0, 5.0, 2)
