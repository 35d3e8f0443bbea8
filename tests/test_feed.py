from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from silverline.operators import change_feed, daily_versions, latest_per_key, union_days
from silverline.plans import write_entities
from tests.conftest import rows


def test_record_of_one_row(spark):
    df = spark.createDataFrame([(90_001, date(2026, 1, 3))], "id long, day date")
    row = change_feed(df, "id", "day", "customer", 5000, "2026-01-01").first().asDict()
    assert row == {
        "id_customer": "1",
        "dat_update": datetime(2026, 1, 3, 2),
        "ind_status": "I",
        "des_customer": "customer_1_v2",
        "flg_ativo": "N",
        "dat_kafka": datetime(2026, 1, 4, 1, 0, 1),
        "dt_ref": date(2026, 1, 3),
    }


def test_statuses_and_flags(spark):
    df = spark.range(6).withColumn("day", F.lit(date(2026, 1, 1)))
    out = change_feed(df, "id", "day", "e", 10, "2026-01-01").orderBy("dat_kafka").collect()
    assert "".join(r["ind_status"] for r in out) == "AIPAIP"
    assert "".join(r["flg_ativo"] for r in out) == "YNYNYN"


def test_zoned_and_zoneless_times(spark):
    df = spark.range(1).withColumn("day", F.lit(date(2026, 1, 1)))
    zoned = change_feed(df, "id", "day", "e", 10, "2026-01-01")
    plain = change_feed(df, "id", "day", "e", 10, "2026-01-01", timestamp_type="timestamp_ntz")
    assert dict(zoned.dtypes)["dat_kafka"] == "timestamp"
    assert dict(plain.dtypes)["dat_kafka"] == "timestamp_ntz"


def test_generated_days_equal_united_days(spark, plan_of):
    ids = spark.range(40)
    generated = daily_versions(ids, "2026-01-01", "2026-01-03")
    frames = [ids.withColumn("dt_ref", F.lit(date(2026, 1, d))) for d in (1, 2, 3)]
    assert rows(generated) == rows(union_days(frames))
    assert "Exchange" not in plan_of(generated)


def test_empty_ranges_are_errors(spark):
    with pytest.raises(ValueError):
        daily_versions(spark.range(1), "2026-01-02", "2026-01-01")
    with pytest.raises(ValueError):
        union_days([])


def test_latest_record_of_every_key_is_from_the_last_day(spark, tmp_path):
    paths = write_entities(
        {"customer": (spark.range(700), "id"), "product": (spark.range(90), "id")},
        str(tmp_path), "s", "2026-01-01", "2026-01-05", key_space=300,
    )
    for name, keys in (("customer", 300), ("product", 90)):
        feed = spark.read.parquet(paths[name])
        kept = latest_per_key(feed, f"id_{name}", "dat_kafka").collect()
        assert len(kept) == keys
        assert all(r[f"des_{name}"] == f"{name}_{r[f'id_{name}']}_v4" for r in kept)
        assert {r["dt_ref"] for r in kept} == {date(2026, 1, 5)}
