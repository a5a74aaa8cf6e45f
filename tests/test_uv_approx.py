"""The estimate is set against the exact count."""

import datetime as dt


def test_uv_approx_stands_beside_the_exact_count(spark, tmp_path):
    import __spark_entry__ as E
    rows = [(i, dt.datetime(2024, 1, 1, i % 3), i % 700, "view", 1.0, '{"k": 1}') for i in range(3000)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    got = E.queries()["uv_approx"](spark, str(tmp_path)).collect()
    assert len(got) == 3 and all(r["cnt"] == 700 and r["within"] for r in got)
