"""Property tests: Spark operators against brute-force Python on random inputs."""

import datetime as dt

from hypothesis import given, settings
from pyspark.sql import functions as F
from hypothesis import strategies as st

from labelforge.operators.mode import mode_category
from labelforge.operators.ranges import range_match
from labelforge.sources.wide import read_wide

SETTINGS = settings(max_examples=12, deadline=None)

values = st.lists(st.one_of(st.none(), st.floats(-100, 100, allow_nan=False).map(lambda v: round(v, 1))),
                  min_size=1, max_size=60)
range_list = st.lists(st.tuples(st.floats(-120, 120, allow_nan=False).map(lambda v: round(v, 1)),
                                st.floats(0, 80, allow_nan=False).map(lambda v: round(v, 1))),
                      min_size=1, max_size=12)


@SETTINGS
@given(values, range_list, st.sampled_from(["closed", "left_open"]), st.booleans())
def test_range_match_equals_brute_force(spark, vals, rngs, bounds, broadcast):
    df = spark.createDataFrame(list(enumerate(vals)), "id int, v double")
    ranges = [(f"r{i}", s, s + w) for i, (s, w) in enumerate(rngs)]
    r = spark.createDataFrame(ranges, "name string, start double, end double")
    got = sorted(tuple(x) for x in range_match(
        df, "v", r, bounds=bounds, max_broadcast_bytes=10**8 if broadcast else 0,
        axis_points=10**6 if broadcast else 5).collect())

    def hit(v, s, e):
        return s <= v <= e if bounds == "closed" else s < v <= e
    want = sorted((i, n) for i, v in enumerate(vals) if v is not None
                  for n, s, e in ranges if hit(v, s, e))
    assert got == want


days = st.dates(dt.date(2019, 1, 1), dt.date(2019, 12, 31))
stamps = st.lists(st.one_of(st.none(), st.builds(
    lambda d, s: dt.datetime.combine(d, dt.time()) + dt.timedelta(seconds=s), days,
    st.integers(0, 86399))), min_size=1, max_size=40)


@SETTINGS
@given(stamps, days, st.sampled_from(["eq", "ne", "gt", "lt", "ge", "le"]))
def test_typed_condition_equals_text_comparison(spark, ts, day, op):
    df = spark.createDataFrame(list(enumerate(ts)), "id int, m timestamp_ntz")
    got = sorted(int(r[0]) for r in read_wide(df, ["id"], f"m[{op}]{day.isoformat()}").collect())
    cmp = {"eq": lambda a, b: a == b, "ne": lambda a, b: a != b, "gt": lambda a, b: a > b,
           "lt": lambda a, b: a < b, "ge": lambda a, b: a >= b, "le": lambda a, b: a <= b}[op]
    want = sorted(i for i, t in enumerate(ts)
                  if t is not None and cmp(t.strftime("%Y-%m-%d"), day.isoformat()))
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from(["x", "y", "z", None])),
                min_size=1, max_size=50))
def test_mode_equals_brute_force(spark, pairs):
    df = spark.createDataFrame(pairs, "k string, c string")
    got = sorted(tuple(r) for r in mode_category(df, "k", "c").collect())
    want = []
    for k in sorted({k for k, _ in pairs}):
        counts = {}
        for kk, c in pairs:
            if kk == k and c is not None:
                counts[c] = counts.get(c, 0) + 1
        if counts:
            want.append((k, min(counts, key=lambda c: (-counts[c], c))))
    assert got == want


cells = st.lists(st.tuples(st.sampled_from(["1", "2", "3", "4"]), st.sampled_from(["a", "b"]),
                           st.one_of(st.none(), st.sampled_from(["x", "y", "z"]))),
                 max_size=12)


def _upsert_model(old, new):
    state = {}
    for k, t, v in old:
        if v is not None:
            state[(k, t)] = max(v, state.get((k, t), v))
    fresh = {}
    for k, t, v in new:
        if v is not None:
            fresh[(k, t)] = max(v, fresh.get((k, t), v))
    state.update(fresh)
    return sorted((k, t, v) for (k, t), v in state.items())


@SETTINGS
@given(cells, cells)
def test_profile_upsert_equals_dict_semantics(spark, old, new):
    from labelforge.operators import profile
    schema = "userId string, tag string, value string"
    o, n = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    # the old store has one cell per (key, tag): de-duplicate as a stored profile would
    o = o.where(F.col("value").isNotNull()).groupBy("userId", "tag").agg(F.max("value").alias("value"))
    got = sorted(tuple(r) for r in profile.upsert_long(o, n).collect())
    assert got == _upsert_model(old, new)
