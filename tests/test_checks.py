"""Data checks and ingest validation."""

from petalframe.defs import Field
from petalframe.operators import checks


def test_missing_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "c")], "x double, s string")
    got = {r["column_name"]: r["n_missing"] for r in checks.missing_cells(df).collect()}
    assert got == {"x": 2, "s": 1}


def test_range_contract(spark):
    df = spark.createDataFrame([(4.0,), (8.0,), (float("nan"),), (None,), (8.0000001,)], "x double")
    r = checks.range_checks(df, {"x": (4, 8)}).first()
    assert r["failed_rows"] == 3 and not r["passed"]
    empty = spark.createDataFrame([], "x double")
    assert checks.range_checks(empty, {"x": (4, 8)}).first()["passed"]


def test_suite(spark):
    df = spark.createDataFrame([(5.0, 3.0), (6.0, None)], "sepal_length double, sepal_width double")
    got = {r["check"]: (r["passed"], r["failed_rows"]) for r in checks.check_suite(
        df, expected=["sepal_length", "sepal_width", "species"], ranges={"sepal_length": (4, 8)}).collect()}
    assert got["no_missing_cells"] == (False, 1)
    assert got["columns_present"] == (False, 1)
    assert got["range:sepal_length:[4,8]"] == (True, 0)


def test_validate_rejects(spark):
    df = spark.createDataFrame([("1.5", '{"k": 3}'), ("abc", '{"k": 4}'), ("2", "not json"), ("3", '{"k": "x"}')],
                               "v string, props string")
    ok, bad = checks.validate(df, [Field("v", "double"), Field("props", "string")], {"props": "k INT"})
    assert ok.count() == 1 and ok.first()["props"]["k"] == 3
    reasons = sorted(r["reason"] for r in bad.collect())
    assert reasons == ["props.k: 'x' is not INT", "props: 'not json' is not A JSON OBJECT", "v: 'abc' is not DOUBLE"]


def test_scaler_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    st = checks.standard_scaler_fit(df, ["a", "b"])
    assert st["a"] == (2.0, 1.0) and st["b"] == (5.0, 1.0)  # zero deviation scales by 1
    r = checks.standard_scaler_transform(df, st, "_z").orderBy("a").collect()
    assert [x["a_z"] for x in r] == [-1.0, 1.0] and [x["b_z"] for x in r] == [0.0, 0.0]


def test_distinct_classes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "c string")
    rows = sorted((r["c"], r["class_index"], r["n_classes"]) for r in checks.distinct_classes(df, "c").collect())
    assert rows == [("a", 0, 2), ("b", 1, 2)]


def test_json_fields_are_checked_one_by_one(spark):
    from petalframe.defs import Field

    rows = [(1, '{"a": 5, "b": "x", "c": {"d": 1.5}}', "1"), (2, '{"a": "x", "b": 2}', "2"), (3, "{}", "3"), (4, None, "4"),
            (5, "[1]", "5"), (6, "nonsense", "6"), (7, '{"a": null, "c": {"d": "q"}, "e": 1}', "7"), (8, '{"a": 1.5}', "8z"), (9, '{"a": "12"}', None)]
    df = spark.createDataFrame(rows, "id int, js string, n string")
    ok, bad = checks.validate(df, [Field("n", "int"), Field("js", "string")], {"js": "a INT, b STRING, c STRUCT<d: DOUBLE>"})
    got = {r["id"]: (r["js"] and (r["js"]["a"], r["js"]["b"], r["js"]["c"] and r["js"]["c"]["d"]), r["n"]) for r in ok.collect()}
    assert got[1] == ((5, "x", 1.5), 1) and got[3] == ((None, None, None), 3) and got[4] == (None, 4) and got[9] == ((12, None, None), None)
    told = {r["id"]: (r["js"], r["n"], r["reason"]) for r in bad.collect()}
    assert told[2] == ('{"a": "x", "b": 2}', "2", "js.a: 'x' is not INT")  # raw text, the field at fault
    assert told[6] == ("nonsense", "6", "js: 'nonsense' is not A JSON OBJECT") and told[5][2].startswith("js: '[1]'")
    assert told[8][2].split("; ")[0] == "n: '8z' is not INT" and told[8][0] == '{"a": 1.5}'
    assert set(got) | set(told) == set(range(1, 10)) and not set(got) & set(told)
