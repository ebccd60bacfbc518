import random

from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rebasket.operators.running import range_blocks, running_totals

pairs = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30), st.integers(0, 5)), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=pairs, width=st.integers(1, 40))
def test_totals_match_a_plain_loop(spark, data, width):
    data = [(k, at, i, w) for i, (k, at, w) in enumerate(data)]
    frame = spark.createDataFrame(data, "k int, at int, i int, w int")
    result = running_totals(frame, ["k"], F.floor(F.col("at") / width), ["at", "i"], ["w"])
    got = {r.i: (r.w_before, r.w_total) for r in result.collect()}
    want = {
        i: (sum(v for kk, a, j, v in data if kk == k and (a, j) < (at, i)),
            sum(v for kk, _, _, v in data if kk == k))
        for k, at, i, _ in data
    }
    assert got == want


def test_no_key_is_one_group(spark):
    numbers = random.Random(1).sample(range(1000), 50)
    frame = spark.createDataFrame([(n, 1) for n in numbers], "at int, one int")
    result = running_totals(frame, [], F.floor(F.col("at") / 100), ["at"], ["one"])
    got = {r["at"]: (r.one_before, r.one_total) for r in result.collect()}
    assert got == {n: (i, 50) for i, n in enumerate(sorted(numbers))}


def test_a_null_key_is_a_key(spark):
    frame = spark.createDataFrame([(None, 1, 1), (None, 2, 1), (1, 1, 1), (None, 9, 1)], "k int, at int, one int")
    result = running_totals(frame, ["k"], F.floor(F.col("at") / 2), ["at"], ["one"])
    assert rows(result, "k", "at", "one_before", "one_total") == sorted(
        [(None, 1, 0, 3), (None, 2, 1, 3), (None, 9, 2, 3), (1, 1, 0, 1)], key=repr)


def test_ranges_ascend_and_follow_the_rows(spark):
    frame = spark.range(5000).select(F.concat(F.lit("same beginning "), F.lpad("id", 5, "0")).alias("name"))
    found = range_blocks(frame, ["name"], "names", per_block=500)
    spans = found.groupBy("block").agg(F.min("name").alias("a"), F.max("name").alias("b"), F.count("*").alias("n")).orderBy("block").collect()
    assert len(spans) == 10 and max(r.n for r in spans) < 1000 and sum(r.n for r in spans) == 5000
    assert all(x.b < y.a for x, y in zip(spans, spans[1:]))
    assert range_blocks(frame.limit(0), ["name"], "none").count() == 0
