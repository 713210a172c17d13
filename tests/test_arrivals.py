"""Checks on arrival: every row ends up once, passed or in quarantine."""

import datetime
from collections import Counter
from decimal import Decimal

import pytest

from storkline.plans.queries import QUERIES
from storkline.sources.births import births_from
from storkline.streaming import arrivals, jobs

KIND = "id long, weight_grams double, mother_age double, is_male int"
ROWS = [(1, 3000.0, 30.0, 1), (2, 100.0, 30.0, 1), (3, None, 70.0, 0), (4, 2500.0, None, None), (5, 3000.0, 9.0, 2), (5, 3000.0, 9.0, 2)]


def test_routes_rows(spark, tmp_path):
    out, state, folder = (str(tmp_path / x) for x in ("out", "state", "in"))
    run = lambda: arrivals.check_arrivals(jobs.stream_table(spark, folder, "*.parquet"), out, state)
    spark.createDataFrame(ROWS[:3], KIND).coalesce(1).write.mode("append").parquet(folder)
    run()
    spark.createDataFrame(ROWS[3:], KIND).coalesce(1).write.mode("append").parquet(folder)
    run()
    run()
    passed = [tuple(r) for r in arrivals.arrived(spark, out, False).select("id", "weight_grams", "mother_age", "is_male").collect()]
    bad = arrivals.arrived(spark, out, True).collect()
    assert Counter(passed) == Counter(ROWS[i] for i in (0, 3))
    assert Counter((r.id, tuple(sorted(r.failed_checks))) for r in bad) == Counter({
        (2, ("target_in_range",)): 1, (3, ("mother_age_in_range", "target_not_null")): 1, (5, ("is_male_is_flag", "mother_age_in_range")): 2,
    })
    counts = {r.check: (r.violations, r.rows) for r in arrivals.arrival_checks(spark, out).collect()}
    assert counts["target_not_null"] == (1, 6) and counts["mother_age_in_range"] == (3, 6) and counts["is_male_is_flag"] == (2, 6)
    assert "failed_checks" not in arrivals.arrived(spark, out, False).columns


LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
DAY = datetime.datetime(1995, 1, 1)


def lines(spark, first, n=40):
    return spark.createDataFrame([(first + i, first + 7 * i, i, 1 + i % 7, 20.0, 0.05, 0.02, "A", "O", DAY) for i in range(n)], LINES)


@pytest.mark.parametrize("files", [1, 3])
@pytest.mark.parametrize("first", [0, 53_999_000])
def test_large_keys_and_tables_of_several_files(spark, tmp_path, first, files):
    """Keys beyond the range of a long, and a table that is a folder of part files."""
    rows = lines(spark, first)
    if files == 1:
        rows.toPandas().to_parquet(tmp_path / "lineitem.parquet", coerce_timestamps="us")
    else:
        rows.repartition(files).write.parquet(str(tmp_path / "lineitem.parquet"))
    found = QUERIES["stream_expectations"](spark, str(tmp_path)).collect()
    kept = births_from(spark.read.parquet(str(tmp_path / "lineitem.parquet")), wide_key=True).filter("weight_pounds between 0.66 and 15.43").count()
    assert kept and {(r.rows, r.passed + r.quarantined, r.lost) for r in found} == {(kept, kept, 0)}


def test_wide_key_is_the_key(spark):
    assert [r.birth_id for r in births_from(lines(spark, 5), True).collect()] == [r.birth_id for r in births_from(lines(spark, 5)).collect()]
    key = births_from(lines(spark, 53_999_000, 1), True).first().birth_id
    assert key == Decimal(53_999_000) * 10**12 + 53_999_000 * 10**6 + 1
