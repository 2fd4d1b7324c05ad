"""Schema evolution and compatibility verdicts."""

import pytest
from pyspark.sql import functions as F

from logflow.functions import parsing, payloads
from logflow.functions.payloads import ORDER_V2
from logflow.operators import schemas
from logflow.sinks import schemas as schema_sink
from logflow.sinks.schemas import SchemaStore
from logflow.versions import VersionConflict


def table(spark, rows):
    return spark.createDataFrame(rows, schemas.SCHEMA_COLUMNS)


def report(spark, old, new, rules=None):
    rows = [("s", 1, *f) for f in old] + [("s", 2, *f) for f in new]
    found = schemas.compatibility_report(table(spark, rows), rules).collect()
    return {(r.field, r.change): (r.backward, r.forward, r.full, r.none) for r in found}


def test_each_kind_of_change(spark):
    base = [("id", "integer", True, None, None), ("note", "string", False, None, None), ("kind", "string", True, "A,B", None)]
    identical = report(spark, base, base)
    assert identical == {}
    assert report(spark, base, [*base, ("x", "string", False, None, None)]) == {
        ("x", "add optional field"): (True, True, True, True)
    }
    assert report(spark, base, [*base, ("x", "string", True, None, None)]) == {
        ("x", "add required field"): (False, True, False, True)
    }
    assert report(spark, base, [base[0], base[2]]) == {("note", "remove optional field"): (True, True, True, True)}
    assert report(spark, base, base[1:]) == {("id", "remove required field"): (True, False, False, True)}
    assert report(spark, base, [("id", "string", True, None, None), *base[1:]]) == {
        ("id", "change field type"): (False, False, False, True)
    }
    renamed = [("key", "integer", True, None, "id"), *base[1:]]
    assert report(spark, base, renamed) == {("key", "rename field"): (False, False, False, True)}
    grown = [*base[:2], ("kind", "string", True, "A,B,C", None)]
    assert report(spark, base, grown) == {("kind", "add enum symbol"): (False, True, False, True)}
    assert report(spark, base, grown, schemas.RESOLUTION_RULES) == {
        ("kind", "add enum symbol"): (True, False, False, True)
    }
    swapped = [*base[:2], ("kind", "string", True, "A,C", None)]
    assert set(report(spark, base, swapped)) == {("kind", "add enum symbol"), ("kind", "remove enum symbol")}


def test_rename_without_alias_is_remove_and_add(spark):
    old, new = [("id", "integer", True, None, None)], [("key", "integer", True, None, None)]
    assert set(report(spark, old, new)) == {("id", "remove required field"), ("key", "add required field")}


def test_versions_with_a_gap_are_neighbours(spark):
    rows = [("s", 1, "a", "string", True, None, None), ("s", 5, "a", "integer", True, None, None)]
    found = schemas.schema_changes(table(spark, rows)).collect()
    assert [(r.version, r.change) for r in found] == [(5, "change field type")]


def test_subject_versions(spark):
    rows = [("s", v, f, "string", True, None, None) for v in (1, 2, 10) for f in ("a", "b")]
    got = schemas.subject_versions(table(spark, rows)).first()
    assert (got.latest_version, got.versions) == (10, "1,2,10")


def test_observed_schemas(spark):
    rows = [
        ("s", 1, '{"a":1,"b":"x","e":"U"}'),
        ("s", 1, '{"a":2,"b":null,"e":"V"}'),
        ("s", 2, '{"a":1.5,"e":"V","n":{"q":1}}'),
        ("s", 2, '{"a":3,"e":"V"}'),
    ]
    df = spark.createDataFrame(rows, "subject STRING, version INT, value STRING")
    got = {
        (r.version, r.field): (r.type, r.required, r.symbols)
        for r in schemas.observed_schemas(df, "subject", "version", "value", ["e"]).collect()
    }
    assert got[(1, "a")] == ("integer", True, "")
    assert got[(1, "b")] == ("string", False, "")
    assert got[(1, "e")] == ("string", True, "U,V")
    assert got[(2, "a")][0] == "number"
    assert got[(2, "n")][1] is False


def test_old_and_new_records_read_with_the_new_schema(spark):
    v1 = '{"orderId":"ORD-V1-001","customerId":"C","product":"P","quantity":1,"totalPrice":9.5,"status":"NEW","timestamp":1}'
    v2 = v1.replace("V1", "V2")[:-1] + ',"shippingAddress":"123 Main St, City, Country"}'
    df = spark.createDataFrame([(1, v1), (2, v2)], "i INT, value STRING")
    got = schemas.evolve_read(df, ORDER_V2).orderBy("i").collect()
    assert [r.shippingAddress for r in got] == [None, "123 Main St, City, Country"]
    assert [r.orderId for r in got] == ["ORD-V1-001", "ORD-V2-001"]


def test_union_versions(spark):
    one = spark.createDataFrame([(1,)], "a INT")
    two = spark.createDataFrame([(2, "x")], "a INT, b STRING")
    got = schemas.union_versions(one, two).orderBy("a")
    assert [tuple(r) for r in got.collect()] == [(1, None), (2, "x")]
    assert F.col is not None


def test_mixed_types_are_named(spark):
    rows = [("s", 1, v) for v in ('{"a":1,"b":1,"o":{"x":1}}', '{"a":"t","b":2.5,"o":{"y":"z"}}', '{"a":true,"b":3,"o":[1]}')]
    df = spark.createDataFrame([*rows, ("s", 2, "{}"), ("s", 3, "no json"), ("s", 3, '{"a":null}')], "s STRING, v INT, j STRING")
    found = schemas.observed_schemas(df, "s", "v", "j")
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan ") == 1
    got = {(r.version, r.field): (r.type, r.required) for r in found.collect()}
    assert got == {
        (1, "a"): ("boolean|integer|string", True),
        (1, "b"): ("number", True),
        (1, "o"): ("array|object", True),
        (3, "a"): (None, False),
    }


def test_schema_store(spark, tmp_path):
    store = SchemaStore(spark, str(tmp_path / "schemas"))
    assert store.read().count() == 0
    one = [("s", 1, "id", "integer", True, None, None)]
    two = [("s", 2, *f[2:]) for f in one] + [("s", 2, "note", "string", False, None, None)]
    assert store.register(table(spark, one)) == 1
    assert store.register(table(spark, one + two)) == 2
    assert store.register(table(spark, two)) == 2, "nothing new"
    assert [tuple(r) for r in store.versions().collect()] == [("s", 2, "1,2")]

    with pytest.raises(schema_sink.IncompatibleSchema, match="other fields"):
        store.register(table(spark, [("s", 1, "id", "string", True, None, None)]))
    worse = [("s", 4, "id", "string", True, None, None)]
    with pytest.raises(schema_sink.IncompatibleSchema, match="s 4: change field type id"):
        store.register(table(spark, worse), "full")
    assert store.read().count() == 3
    assert store.register(table(spark, worse), "none") == 3
    # Version 3 comes late: the step to version 4 is a change of its own.
    late = [("s", 3, "id", "integer", True, None, None)]
    with pytest.raises(schema_sink.IncompatibleSchema, match="s 4"):
        store.register(table(spark, late))
    with pytest.raises(ValueError, match="unknown"):
        store.register(table(spark, late), "sideways")


def test_two_registrations_at_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "schemas")
    a, b = SchemaStore(spark, root), SchemaStore(spark, root)
    seen = b._manifest.latest()
    monkeypatch.setattr(b._manifest, "latest", lambda: seen)
    a.register(table(spark, [("s", 1, "id", "integer", True, None, None)]))
    with pytest.raises(VersionConflict):
        b.register(table(spark, [("s", 1, "id", "string", True, None, None)]))
    assert a.read().count() == 1


def test_user_events_are_typed(spark):
    rows = [
        '{"userId":"u","email":"e","name":"n","eventType":"LOGOUT","timestamp":1700000000123,"attributes":{"a":"1"}}',
        '{"userId":"u","email":"e","name":"n","eventType":"LEFT","timestamp":-1}',
        "no json",
        None,
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "i INT, value STRING")
    required = ["userId", "email", "name", "eventType", "timestamp"]
    codes = parsing.required_errors(required, {"eventType": payloads.USER_EVENT_TYPES})
    got = payloads.user_events(df).select("i", F.unix_millis("timestamp").alias("at"), "attributes", codes.alias("errors"))
    missing = [f"{f}_missing" for f in required]
    assert [tuple(r) for r in got.orderBy("i").collect()] == [
        (0, 1700000000123, {"a": "1"}, []),
        (1, -1, None, ["eventType_unknown"]),
        (2, None, None, missing),
        (3, None, None, missing),
    ]
