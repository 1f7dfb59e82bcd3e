import pytest

from tierlake.operators import quality
from tierlake.schemas import SILVER_EVENT


def silver_rows(spark, rows):
    return spark.createDataFrame(rows, SILVER_EVENT)


def r(lid="1", et="NEW_LISTING", price=10, beds=2, ts=None):
    from datetime import datetime
    return (lid, et, "ASIA", "N", price, beds, 500, "a", ts or datetime(2024, 1, 28),
            datetime(2024, 1, 31))


def test_report_counts_each_gate(spark):
    from datetime import datetime
    rows = [r(), r(lid=None), r(et="BOGUS"), r(et=None), r(price=-1), r(beds=0), r(beds=20),
            r(beds=21), r(beds=None), r(ts=datetime(2023, 12, 1))]
    df = silver_rows(spark, rows)
    gates = quality.listing_gates(as_of="2024-01-31 00:00:00", max_age_days=7)
    rep = {x.check: (x.violations, x.total, x.passed)
           for x in quality.report(df, gates, unique_keys=["listing_id"]).collect()}
    assert rep["completeness_listing_id"] == (1, 10, False)
    assert rep["validity_event_type"] == (1, 10, False)      # NULL passes validity
    assert rep["range_price"] == (1, 10, False)
    assert rep["range_bedrooms"] == (2, 10, False)           # 0 and 21; 20 and NULL pass
    assert rep["volume"] == (0, 10, True)
    assert rep["timeliness"] == (1, 10, False)
    assert rep["completeness_event_timestamp"] == (0, 10, True)
    assert rep["uniqueness"][0] == 8                          # nine rows share listing_id '1'
    with pytest.raises(quality.QualityGateError):
        quality.enforce(quality.report(df, gates))


def test_empty_table_fails_volume_only(spark):
    df = silver_rows(spark, [])
    rep = {x.check: x.violations for x in quality.report(df, quality.listing_gates()).collect()}
    assert rep["volume"] == 1 and sum(rep.values()) == 1


def test_clean_table_passes(spark):
    df = silver_rows(spark, [r(lid=str(i)) for i in range(5)])
    quality.enforce(quality.report(df, quality.listing_gates(), unique_keys=["listing_id"]))
