"""Times given by a caller mean UTC, whatever the zone of the driver."""

import datetime as dt

from starloom.functions.columns import utc_text
from starloom.operators.control import purge_logs


def test_a_zone_is_converted_and_none_is_utc():
    east = dt.timezone(dt.timedelta(hours=5))
    assert utc_text(dt.datetime(2024, 1, 1, 12, tzinfo=east)) == "2024-01-01 07:00:00"
    assert utc_text(dt.datetime(2024, 1, 1, 12)) == "2024-01-01 12:00:00"


def test_retention_is_counted_in_utc(spark):
    log = spark.sql("select timestamp'2024-01-01 11:00:00' as at union all select timestamp'2024-01-01 13:00:00'")
    kept = purge_logs(log, "at", dt.datetime(2024, 1, 11, 12), days=10).selectExpr("cast(at as string) as at").collect()
    assert [r.at for r in kept] == ["2024-01-01 13:00:00"]
