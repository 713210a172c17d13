"""Bitmaps of hashes, and the rows that travel with them in operator 1."""

from pyspark.sql import functions as F

from storkline.llm import line_dedup, marks
from storkline.session import stored


def test_marks_miss_nothing(spark):
    hashes = spark.range(5000).select(F.xxhash64("id").alias("h"))
    for most_rows in (marks.MOST_ROWS, 1):
        table = marks.marks_of(stored(hashes, "hashes"), "h", most_rows)
        assert table[1] == min(4, most_rows)
        asked = spark.range(20000).select("id", F.xxhash64("id").alias("h"))
        found = {r.id for r in marks.with_marked(asked, "h", table, "in").filter("in").select("id").collect()}
        others = len(found - set(range(5000)))
        # a bit is set for one in sixteen hashes at most, and one in 6.6 in a single row
        assert found >= set(range(5000)) and 0 < others < 15000 * (0.08 if most_rows > 1 else 0.2)


def test_no_marks(spark):
    table = marks.marks_of(stored(spark.range(0).select(F.xxhash64("id").alias("h")), "none"), "h")
    asked = spark.range(10).select(F.xxhash64("id").alias("h")).unionAll(spark.range(1).select(F.lit(None).cast("long")))
    assert {r["in"] for r in marks.with_marked(asked, "h", table, "in").collect()} == {False}


def test_texts_that_lose_nothing_do_not_travel(spark):
    rows = [(i, f"first {i}\nsecond {i}\nthird {i}") for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(3)] + [(None, rows[1][1]), (7, None), (7, None)]
    out = line_dedup.remove_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(((r.doc_id, r.text), r.n_removed) for r in out.collect() if r.doc_id is not None and r.text is not None)
    assert got == sorted(((i, t), 3 * (i >= 1000)) for i, t in rows if i is not None and t is not None)
    assert [r.n_removed for r in out.filter("doc_id IS NULL").collect()] == [3]
    # the branch of the others meets nothing but the bitmap, which is broadcast
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan
    assert [("strategy=broadcast" in line) for line in plan[plan.rindex("NOT "):].splitlines() if "Join " in line] == [True]
