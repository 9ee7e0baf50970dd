"""Materialisation, versioned stores, online lookup and labels."""

from datetime import datetime, timedelta

from petalframe.defs import BatchSource, Entity, FeatureView, Field, LabelView
from petalframe.operators import online

T0 = datetime(2024, 1, 10)
SCHEMA = "k bigint, ts timestamp_ntz, created timestamp_ntz, v double"


def test_materialize_bounds_and_late_rows(spark):
    hist = spark.createDataFrame([
        (1, T0, T0, 1.0),                                # at the previous end: belongs to slice 1
        (1, T0 + timedelta(days=1), T0, 2.0),            # slice 2
        (2, T0 + timedelta(days=2), T0, 5.0),            # exactly at the new end: in
        (2, T0 + timedelta(days=2), T0 + timedelta(seconds=1), 6.0),  # same time, newer created: wins
        (3, T0 + timedelta(days=3), T0, 9.0),            # after the end: out
    ], SCHEMA)
    snap = online.materialize_frame(hist, None, ["k"], "ts", "created", end=T0)
    assert {r["k"]: r["v"] for r in snap.collect()} == {1: 1.0}
    late = spark.createDataFrame([(1, T0 - timedelta(days=5), T0, -1.0)], SCHEMA)  # older than snapshot row
    new = online.materialize_frame(hist.unionByName(late), snap, ["k"], "ts", "created",
                                   start=T0, end=T0 + timedelta(days=2))
    assert {r["k"]: r["v"] for r in new.collect()} == {1: 2.0, 2: 6.0}


def _view(spark, frame):
    return FeatureView("stats", [Entity("driver", ["k"])], [Field("v", "float")],
                       BatchSource("s", "ts", "created", frame=frame), ttl=timedelta(days=1))


def test_store_incremental_push_and_lookup(spark, tmp_dir):
    hist = spark.createDataFrame([(1, T0, T0, 1.0), (2, T0 + timedelta(days=1), T0, 2.0)], SCHEMA)
    view = _view(spark, hist)
    store = online.OnlineStore(spark, tmp_dir)
    assert store.materialize_incremental(view, T0) == 1
    assert store.materialize_incremental(view, T0 + timedelta(days=1)) == 2
    pushed = spark.createDataFrame([(1, T0 + timedelta(days=2), T0, 7.0), (3, T0, T0, 3.0)], SCHEMA)
    v = store.push(view, pushed, offline_path=tmp_dir + "/offline", version=3)
    assert v == 3
    assert store.push(view, pushed, offline_path=tmp_dir + "/offline", version=3) == 3  # replay: no-op
    assert spark.read.parquet(tmp_dir + "/offline").count() == 2
    req = spark.createDataFrame([(0, 1), (1, 2), (2, 1), (3, 99)], "req_id int, k bigint")
    out = store.get_online_features(view, req, order_col="req_id").collect()
    assert [(r["req_id"], r["v"]) for r in out] == [(0, 7.0), (1, 2.0), (2, 7.0), (3, None)]
    assert dict(store.get_online_features(view, req).dtypes)["v"] == "float"


def test_labels_last_write_wins(spark):
    view = LabelView("q", [Entity("driver", ["k"])], [Field("is_reliable", "bigint")], None,
                     tags={"label-values:is_reliable": "1,0"})
    labels = spark.createDataFrame([
        (1, T0, 1, "alice"), (1, T0 + timedelta(hours=1), 0, "bob"),
        (2, T0, 1, "alice"), (2, T0, 0, "carol"),        # same time: larger labeler name wins
        (3, T0, 7, "alice"),                              # not an allowed value
    ], "k bigint, event_timestamp timestamp_ntz, is_reliable bigint, labeler string")
    got = {r["k"]: (r["is_reliable"], r["labeler"], r["is_valid"]) for r in
           online.resolve_labels(labels, view).collect()}
    assert got == {1: (0, "bob", True), 2: (0, "carol", True), 3: (7, "alice", False)}
    spine = spark.createDataFrame([(1,), (4,)], "k bigint")
    j = {r["k"]: r["is_reliable"] for r in online.join_latest_labels(spine, labels, view).collect()}
    assert j == {1: 0, 4: None}


def test_push_after_materialise_is_kept_and_replay_changes_nothing(spark, tmp_dir):
    hist = spark.createDataFrame([(1, T0, T0, 1.0)], SCHEMA)
    view = _view(spark, hist)
    store = online.OnlineStore(spark, tmp_dir)
    for day in range(3):
        store.materialize_incremental(view, T0 + timedelta(days=day))
    rows = spark.createDataFrame([(2, T0, T0, 5.0)], SCHEMA)
    off = tmp_dir + "/off"
    assert store.push(view, rows, off, version=0, source="a") == 4  # first batch, below the table's version
    assert store.push(view, rows, off, version=0, source="a") == 4
    assert store.push(view, rows, off, version=0, source="b") == 5  # another stream's first batch
    assert {r["k"]: r["v"] for r in store.table("stats").read().collect()} == {1: 1.0, 2: 5.0}
    assert spark.read.parquet(off).count() == 2


def test_references_by_name(spark):
    import pytest

    from petalframe.defs import Project
    from petalframe.operators import pit

    view = _view(spark, spark.createDataFrame([(1, T0, T0, 2.5)], SCHEMA))
    project = Project("p").apply([view])
    spine = spark.createDataFrame([(1, T0)], "k bigint, event_timestamp timestamp_ntz")
    assert pit.get_historical_features(spine, ["stats:v"], spark=spark, project=project).first()["v"] == 2.5
    with pytest.raises(KeyError):
        pit.resolve_references(["stats:w"], project)
    with pytest.raises(ValueError):
        pit.resolve_references(["stats:v"])


def _newest(rows, keys):
    return online.latest_per_key(rows, keys, "ts")


def _folders(table):
    return table._newest()["buckets"]


def test_a_push_of_one_key_rewrites_one_bucket(spark, tmp_dir):
    table = online.VersionedTable(spark, tmp_dir + "/t", buckets=16)
    rows = [(k, T0, float(k)) for k in range(200)]
    assert table.merge(spark.createDataFrame(rows, "k bigint, ts timestamp_ntz, v double"), ["k"], _newest) == 1
    before = _folders(table)
    assert len(before) == 16
    one = spark.createDataFrame([(7, T0 + timedelta(days=1), 70.0)], "k bigint, ts timestamp_ntz, v double")
    assert table.merge(one, ["k"], _newest) == 2
    after = _folders(table)
    assert sum(before[b] != after[b] for b in before) == 1
    assert {r["k"]: r["v"] for r in table.read().collect()} == {k: float(k) for k in range(200)} | {7: 70.0}
    assert table.read(1).where("k = 7").first()["v"] == 7.0  # the version before is still there
    empty = one.limit(0)
    assert table.merge(empty, ["k"], _newest, source="s", batch=0) == 3 and _folders(table) == after
    assert table.committed("s", 0) == 3 and table.committed("s", 1) is None


def test_old_versions_expire(spark, tmp_dir):
    import os

    table = online.VersionedTable(spark, tmp_dir + "/t", buckets=2, keep=2)
    for i in range(5):
        table.merge(spark.createDataFrame([(k, T0 + timedelta(days=i), float(i)) for k in range(8)], "k bigint, ts timestamp_ntz, v double"), ["k"], _newest)
    parts = [d for d, _, files in os.walk(tmp_dir + "/t") if any(f.endswith(".parquet") for f in files)]
    assert len(parts) == 4 and table.read(3) is None  # two versions of two buckets
    assert {r["v"] for r in table.read().collect()} == {4.0} and {r["v"] for r in table.read(4).collect()} == {3.0}


def test_two_writers_of_one_version(spark, tmp_dir, monkeypatch):
    schema = "k bigint, ts timestamp_ntz, v double"
    mine, theirs = (online.VersionedTable(spark, tmp_dir + "/t", buckets=4) for _ in range(2))
    mine.merge(spark.createDataFrame([(k, T0, 0.0) for k in range(10)], schema), ["k"], _newest)
    commit, raced = mine._commit, []

    def late(state):
        if not raced:  # the other writer commits the same version first
            raced.append(theirs.merge(spark.createDataFrame([(1, T0 + timedelta(days=1), 1.0), (2, T0 + timedelta(days=3), 9.0)], schema), ["k"], _newest))
        return commit(state)

    monkeypatch.setattr(mine, "_commit", late)
    assert mine.merge(spark.createDataFrame([(2, T0 + timedelta(days=2), 2.0), (3, T0 + timedelta(days=1), 3.0)], schema), ["k"], _newest) == 3
    assert raced == [2]
    assert {r["k"]: r["v"] for r in mine.read().collect()} == {k: 0.0 for k in range(10)} | {1: 1.0, 2: 9.0, 3: 3.0}


def test_latest_ties_do_not_depend_on_partitions(spark):
    rows = spark.createDataFrame([(1, T0, float(i), {"a": i}) for i in range(40)], "k int, ts timestamp_ntz, v double, m map<string,int>")
    assert {online.latest_per_key(rows.repartition(n), ["k"], "ts").first()["v"] for n in (1, 3, 9)} == {39.0}


def test_online_features_of_a_service(spark, tmp_dir):
    from petalframe.defs import FeatureService, Project, RequestSource, on_demand_feature_view

    stats = _view(spark, spark.createDataFrame([(1, T0, T0, 1.5), (2, T0, T0, 2.5)], SCHEMA))
    other = FeatureView("other", [Entity("driver", ["k"])], [Field("w", "int"), Field("x", "int")],
                        BatchSource("o", "ts", frame=spark.createDataFrame([(2, T0, 20, 21), (3, T0, 30, 31)], "k bigint, ts timestamp_ntz, w int, x int")))
    req = RequestSource("req", [Field("add", "bigint")])

    @on_demand_feature_view(sources=[stats, req], schema=[Field("v_plus", "double")])
    def plus(row):
        return {"v_plus": row["v"] + row["add"]}

    store = online.OnlineStore(spark, tmp_dir)
    for v in (stats, other):
        store.materialize_incremental(v, T0)
    asked = spark.createDataFrame([(0, 2, "10"), (1, 1, "5"), (2, 9, "1"), (3, 2, "7")], "n int, k bigint, add string")
    out = store.get_features(asked, [FeatureService("s", [other[["w"]], plus])], order_col="n")
    assert out.columns == ["n", "k", "add", "w", "v_plus"] and dict(out.dtypes)["add"] == "bigint"
    assert [tuple(r) for r in out.collect()] == [(0, 2, 10, 20, 12.5), (1, 1, 5, None, 6.5), (2, 9, 1, None, None), (3, 2, 7, 20, 9.5)]
    named = store.get_features(asked, ["stats:v", "other:x"], project=Project("p").apply([stats, other, plus]), full_feature_names=True)
    assert {r["n"]: (r["stats__v"], r["other__x"]) for r in named.collect()} == {0: (2.5, 21), 1: (1.5, None), 2: (None, None), 3: (2.5, 21)}


def test_validation_and_serving_log_of_a_view(spark, tmp_dir):
    from petalframe.defs import FeatureService

    view = FeatureView("raw", [Entity("e", ["k"])], [Field("v", "int")], BatchSource("b", "ts", frame=None), enable_validation=True)
    store = online.OnlineStore(spark, tmp_dir + "/s")
    rows = spark.createDataFrame([(1, T0, "5"), (2, T0, "x"), (3, T0, None)], "k bigint, ts timestamp_ntz, v string")
    store.push(view, rows, version=0, source="a")
    store.push(view, rows, version=0, source="a")  # replayed: neither rows nor rejects twice
    assert {r["k"]: r["v"] for r in store.table("raw").read().collect()} == {1: 5, 3: None}
    assert [(r["k"], r["v"], r["reason"]) for r in store.rejects(view).collect()] == [(2, "x", "v: 'x' is not INT")]
    service = FeatureService("s", [view], logging_path=tmp_dir + "/served")
    asked = spark.createDataFrame([(1,), (9,)], "k bigint")
    for _ in range(2):
        assert {r["k"]: r["v"] for r in store.get_features(asked, [service]).collect()} == {1: 5, 9: None}
    log = spark.read.parquet(tmp_dir + "/served")
    assert log.count() == 4 and log.where("served_at is null or log_date is null").count() == 0
