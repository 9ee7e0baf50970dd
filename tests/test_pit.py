"""As-of join (J1-J5) and historical retrieval (K3-K5) edge cases."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from petalframe.defs import (BatchSource, Entity, FeatureService, FeatureView, Field, RequestSource,
                             on_demand_feature_view)
from petalframe.operators import pit

T0 = datetime(2021, 4, 12, 10, 0, 0)


def _spine(spark, rows):
    return spark.createDataFrame(rows, "sid int, k bigint, ts timestamp_ntz")


def _feats(spark, rows):
    return spark.createDataFrame(rows, "k bigint, ts timestamp_ntz, created timestamp_ntz, v double")


def _run(spine, feats, **kw):
    out = pit.as_of_join(spine, feats, ["k"], features=["v"], feature_ts_as="f_ts", **kw)
    return {r["sid"]: (r["v"], r["f_ts"]) for r in out.collect()}


@pytest.mark.parametrize("ranges", [None, 1, 40])
def test_asof_edges(spark, ranges):
    us = timedelta(microseconds=1)
    spine = _spine(spark, [
        (1, 1, T0),                                  # feature exactly at spine time
        (2, 2, T0),                                  # feature exactly ttl old
        (3, 3, T0),                                  # feature ttl + 1 us old
        (4, 4, T0),                                  # only future rows
        (5, 99, T0),                                 # unknown key
        (6, 6, T0),                                  # same time, different created
        (7, 1, T0), (8, 1, T0),                      # repeated spine rows
        (9, 7, T0 + timedelta(days=3)),              # newest row is days earlier (carry across buckets)
    ])
    feats = _feats(spark, [
        (1, T0, T0, 1.0), (1, T0 - timedelta(hours=1), T0, 0.5),
        (2, T0 - timedelta(days=1), T0, 2.0),
        (3, T0 - timedelta(days=1) - us, T0, 3.0),
        (4, T0 + us, T0, 4.0),
        (6, T0 - timedelta(minutes=5), T0, 6.0), (6, T0 - timedelta(minutes=5), T0 + us, 6.5),
        (7, T0 - timedelta(hours=2), T0, 7.0), (7, T0 - timedelta(hours=30), T0, 7.5),
    ])
    got = _run(spine, feats, ttl=timedelta(days=1), created="created", ranges=ranges)
    assert got[1] == (1.0, T0)
    assert got[2][0] == 2.0
    assert got[3] == (None, None)
    assert got[4] == (None, None)
    assert got[5] == (None, None)
    assert got[6][0] == 6.5
    assert got[7][0] == got[8][0] == 1.0
    assert got[9] == (None, None)  # three days later: beyond ttl
    no_ttl = _run(spine, feats, created="created", ranges=ranges)
    assert no_ttl[9] == (7.0, T0 - timedelta(hours=2))
    assert no_ttl[3][0] == 3.0


def test_asof_never_reads_future_and_matches_brute_force(spark):
    import random

    rnd = random.Random(3)
    f_rows = [(rnd.randint(0, 4), T0 + timedelta(minutes=rnd.randint(0, 5000)), T0, float(i)) for i in range(300)]
    s_rows = [(i, rnd.randint(0, 5), T0 + timedelta(minutes=rnd.randint(0, 5000))) for i in range(200)]
    # distinct (key, ts) in features so that "newest" is unique
    seen, fr = set(), []
    for r in f_rows:
        if (r[0], r[1]) not in seen:
            seen.add((r[0], r[1]))
            fr.append(r)
    got = _run(_spine(spark, s_rows), _feats(spark, fr), ttl=timedelta(hours=12))
    for sid, k, ts in s_rows:
        cands = [(t, v) for kk, t, _, v in fr if kk == k and t <= ts and t >= ts - timedelta(hours=12)]
        want = max(cands)[1] if cands else None
        assert got[sid][0] == want
        if got[sid][1] is not None:
            assert got[sid][1] <= ts


def test_same_result_any_partitioning(spark):
    spine = _spine(spark, [(i, i % 3, T0 + timedelta(hours=i)) for i in range(40)])
    feats = _feats(spark, [(i % 3, T0 + timedelta(hours=i, minutes=30), T0, float(i)) for i in range(40)])
    a = _run(spine.repartition(1), feats.repartition(1))
    b = _run(spine.repartition(17), feats.repartition(17))
    assert a == b


def test_clash_is_an_error(spark):
    spine = spark.createDataFrame([(1, 1, T0, 1.0)], "sid int, k bigint, ts timestamp_ntz, v double")
    with pytest.raises(ValueError):
        pit.as_of_join(spine, _feats(spark, [(1, T0, T0, 1.0)]), ["k"], features=["v"])


def _defs(spark):
    driver = Entity("driver", ["driver_id"])
    stats = spark.createDataFrame(
        [(1001, T0 - timedelta(hours=1), T0, 0.5, 10), (1002, T0 - timedelta(hours=2), T0, 0.25, 20),
         (1001, T0 - timedelta(days=2), T0, 0.1, 5)],
        "driver_id bigint, event_timestamp timestamp_ntz, created timestamp_ntz, conv_rate double, avg_daily_trips bigint")
    view = FeatureView("driver_hourly_stats", [driver], [Field("conv_rate", "float"), Field("avg_daily_trips", "bigint")],
                       BatchSource("s", "event_timestamp", "created", frame=stats), ttl=timedelta(days=1))
    req = RequestSource("vals", [Field("val_to_add", "bigint"), Field("val_to_add_2", "bigint")])

    @on_demand_feature_view(sources=[view, req], schema=[Field("conv_rate_plus_val1", "double"),
                                                          Field("conv_rate_plus_val2", "double")])
    def transformed(inputs):
        c = inputs["conv_rate"].cast("double")
        return {"conv_rate_plus_val1": c + inputs["val_to_add"], "conv_rate_plus_val2": c + inputs["val_to_add_2"]}

    return view, transformed


def test_feature_service_retrieval(spark):
    view, odfv = _defs(spark)
    spine = spark.createDataFrame(
        [(1001, T0, 1, 1, 10), (1002, T0, 5, 2, 20), (1003, T0, 3, 3, 30)],
        "driver_id bigint, event_timestamp timestamp_ntz, label int, val_to_add bigint, val_to_add_2 bigint")
    v1 = FeatureService("v1", [view[["conv_rate"]], odfv])
    out = pit.get_historical_features(spine, [v1], spark=spark)
    assert "avg_daily_trips" not in out.columns
    rows = {r["driver_id"]: r for r in out.collect()}
    assert rows[1001]["conv_rate"] == pytest.approx(0.5)
    assert rows[1001]["conv_rate_plus_val1"] == pytest.approx(1.5)
    assert rows[1003]["conv_rate"] is None and rows[1003]["conv_rate_plus_val2"] is None
    assert rows[1002]["label"] == 5  # spine columns pass through
    assert dict(out.dtypes)["conv_rate"] == "float"
    only = pit.get_historical_features(spine, [odfv], spark=spark)
    assert "conv_rate" not in only.columns and "conv_rate_plus_val2" in only.columns


def test_batch_scoring_spine(spark):
    view, _ = _defs(spark)
    ents = spark.createDataFrame([(1001,), (1002,)], "driver_id bigint")
    spine = pit.batch_scoring_spine(ents, "event_timestamp", F.lit(T0).cast("timestamp_ntz"))
    out = {r["driver_id"]: r["conv_rate"] for r in pit.get_historical_features(spine, [view], spark=spark).collect()}
    assert out[1001] == pytest.approx(0.5) and out[1002] == pytest.approx(0.25)


def _brute(s_rows, f_rows, ttl=None):
    """Newest row by time, then created, then value (None smallest)."""
    out = {}
    for sid, k, ts in s_rows:
        cand = [(t, c, v is not None, v or 0.0, v) for kk, t, c, v in f_rows if None not in (k, kk, ts, t) and kk == k and t <= ts
                and (ttl is None or t >= ts - ttl)]
        best = max(cand, default=None)
        out[sid] = (best[4], best[0]) if best else (None, None)
    return out


@pytest.mark.parametrize("ranges", [1, 4, 30])
@pytest.mark.parametrize("ttl", [None, timedelta(hours=2)])
def test_hot_key_and_instant_span_ranges(spark, ranges, ttl):
    """Half of all rows at one key, a third of the spine at one instant of it,
    ties in time and created, NULL keys, times and values, keys of one side only."""
    import random

    rnd = random.Random(11)

    def t():
        return T0 + timedelta(minutes=rnd.randint(0, 2_000))

    f_rows = [(rnd.choice([0, 0, 0, 1, 2, 3, None]), rnd.choice([t(), T0 + timedelta(minutes=500)]), T0 + timedelta(days=rnd.randint(0, 1)),
               rnd.choice([None, float(i), 7.0])) for i in range(500)] + [(1, None, T0, 1.0), (9, T0, T0, 2.0)]
    s_rows = [(i, 0, T0 + timedelta(minutes=900)) for i in range(150)]
    s_rows += [(150 + i, rnd.choice([0, 0, 1, 2, 4, None]), rnd.choice([t(), t(), None])) for i in range(300)]
    s_rows += [(900, 4, T0), (901, 9, T0 + timedelta(days=30))]
    want = _brute(s_rows, f_rows, ttl)
    for parts in (1, 7):
        spine, feats = _spine(spark, s_rows).repartition(parts), _feats(spark, f_rows).repartition(parts)
        out = pit.as_of_join(spine, feats, ["k"], features=["v"], feature_ts_as="f_ts", created="created", ttl=ttl, ranges=ranges)
        rows = out.collect()
        assert len(rows) == len(s_rows) and out.columns == ["sid", "k", "ts", "v", "f_ts"]
        assert {r["sid"]: (r["v"], r["f_ts"]) for r in rows} == want


def test_ties_without_created_go_to_the_larger_row(spark):
    f_rows = [(1, T0, T0, float(i % 50)) for i in range(50)]
    for parts in (1, 5, 11):
        got = _run(_spine(spark, [(1, 1, T0)]), _feats(spark, f_rows).repartition(parts), ranges=parts)
        assert got == {1: (49.0, T0)}


def test_asof_empty_sides(spark):
    none = _spine(spark, [])
    assert pit.as_of_join(none, _feats(spark, [(1, T0, T0, 1.0)]), ["k"], features=["v"]).count() == 0
    assert _run(_spine(spark, [(1, 1, T0), (2, None, None)]), _feats(spark, [])) == {1: (None, None), 2: (None, None)}


def test_bounds_in_a_zone_with_repeated_hours(spark):
    """01:30 happens twice on that day; the later instant is still within the spine's bounds."""
    from datetime import timezone

    zone = spark.conf.get("spark.sql.session.timeZone")
    later = datetime(2024, 11, 3, 6, 30, tzinfo=timezone.utc)
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        spine = spark.createDataFrame([(1, 1, int(later.timestamp()))], "sid int, k int, s long").withColumn("ts", F.timestamp_seconds("s")).drop("s")
        feats = spark.createDataFrame([(1, int(later.timestamp()) - 60, 1.0), (1, int(later.timestamp()) - 3_700, 0.5)], "k int, s long, v double")
        feats = feats.withColumn("ts", F.timestamp_seconds("s")).drop("s")
        for ttl in (None, timedelta(minutes=5)):
            assert [r["v"] for r in pit.as_of_join(spine, feats, ["k"], ttl=ttl).collect()] == [1.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
