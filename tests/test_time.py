"""Time helpers give the same answers whatever the session zone (DST gaps included)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlight.functions import timefn


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_zone_free_time_helpers(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("2024-03-10 02:30:00.5",), ("1969-12-31 23:59:59.999",), ("2024-07-01 12:00:00",)],
                                   "s string").select(F.to_timestamp_ntz("s").alias("ts"))
        got = [(r.us, r.iso, r.ym, str(r.back)) for r in df.select(
            timefn.epoch_micros("ts").alias("us"), timefn.iso_millis_utc("ts").alias("iso"),
            timefn.year_month_text("ts").alias("ym"),
            timefn.instant_to_ntz(timefn.as_instant("ts")).alias("back")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [
        (1710037800500000, "2024-03-10T02:30:00.500+00:00", "2024-03", "2024-03-10 02:30:00.500000"),
        (-1000, "1969-12-31T23:59:59.999+00:00", "1969-12", "1969-12-31 23:59:59.999000"),
        (1719835200000000, "2024-07-01T12:00:00.000+00:00", "2024-07", "2024-07-01 12:00:00"),
    ]


def test_durations():
    assert timefn.seconds("3m") == 180 and timefn.seconds("1h30m") == 5400 and timefn.seconds(7) == 7
    with pytest.raises(ValueError):
        timefn.seconds("3 parsecs")
    with pytest.raises(ValueError):
        timefn.seconds("1500ms")
