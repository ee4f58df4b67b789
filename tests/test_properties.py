"""Pipelines against brute force on small random tables."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.numbering import number_rows
from tidemark.operators.routing import merge_routed, routing_dimension
from tidemark.operators.schema import CATALOGUE_SCHEMA, schema_drift_report, schema_diff_import
from tidemark.plans.unique import unique_incremental

BUSY = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
small = st.one_of(st.none(), st.integers(0, 3))
AT = dt.datetime(2024, 1, 1)


def key_of(row):
    return tuple((v is not None, v or 0) for v in row)


@BUSY
@given(
    st.lists(st.tuples(small, small, small, st.integers(0, 9)), min_size=1, max_size=40),
    st.lists(st.tuples(st.sampled_from(["t", "T", "u"]), small, small, small), max_size=20),
)
def test_unique_incremental(spark, log, deletes):
    rows = spark.createDataFrame(log, "id int, orgid int, ts int, v int")
    dead = spark.createDataFrame(deletes, "tablename string, p_id int, p_orgid int, updatestamp int")
    out = unique_incremental(rows, dead, ["id", "orgid"], "ts", "t", tie_break=["v"], etl_time=F.lit(AT)).drop("etl_time")

    latest = {}
    for row in log:
        held = latest.get(row[:2])
        if held is None or key_of(row[2:]) > key_of(held[2:]):
            latest[row[:2]] = row
    stamps = {}
    for name, p_id, p_orgid, stamp in deletes:
        if name.lower() == "t" and None not in (p_id, p_orgid, stamp):
            stamps[p_id, p_orgid] = max(stamp, stamps.get((p_id, p_orgid), stamp))
    want = [
        row
        for key, row in latest.items()
        if key not in stamps or (row[2] is not None and row[2] > stamps[key])
    ]
    assert sorted(map(tuple, out.collect()), key=key_of) == sorted(want, key=key_of)


@BUSY
@given(
    st.lists(st.tuples(st.integers(0, 99), small), max_size=30),
    st.lists(st.tuples(st.integers(0, 99), small), max_size=30),
    st.dictionaries(st.integers(0, 3), st.one_of(st.none(), st.just(1)), max_size=4),
)
def test_merge_routed(spark, old, new, clinics):
    dim = [(c, moved, f"b{c}", f"n{c}") for c, moved in clinics.items()]
    dimension = spark.createDataFrame(dim, "clinic_id int, pmsweb_id int, brand_code string, clinic_name string")
    frames = [spark.createDataFrame(rows, "id int, orgid int") for rows in (old, new)]
    merged = merge_routed(*frames, routing_dimension(dimension))
    want = [(f"b{o}", f"n{o}", i, o) for i, o in old if o in clinics and clinics[o] is None]
    want += [(f"b{o}", f"n{o}", i, o) for i, o in new if o in clinics and clinics[o] is not None]
    assert sorted(map(tuple, merged.collect())) == sorted(want)


@BUSY
@given(st.lists(small, max_size=60))
def test_number_rows(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id int, k int").repartition(5)
    numbered = number_rows(df, [F.col("k").asc_nulls_last(), F.col("id").asc()])
    got = [r["id"] for r in sorted(numbered.collect(), key=lambda r: r["no"])]
    want = sorted(range(len(values)), key=lambda i: (values[i] is None, values[i] or 0, i))
    assert got == want and sorted(r["no"] for r in numbered.collect()) == list(range(1, len(values) + 1))


TYPES = ["int", "varchar(9)", "datetime", "decimal(5,1)", "bit"]
WAREHOUSE = {"int": "int", "varchar(9)": "string", "datetime": "string", "decimal(5,1)": "double", "bit": "boolean"}
columns = st.lists(st.tuples(st.sampled_from("abcdE"), st.sampled_from(TYPES)), max_size=5)


@BUSY
@given(st.lists(st.tuples(columns, columns), min_size=1, max_size=6))
def test_schema_diff(spark, tables):
    def catalogue(side, kind):
        rows = [(f"t{i}", j, n, kind(k)) for i, pair in enumerate(tables) for j, (n, k) in enumerate(pair[side], 1)]
        return spark.createDataFrame(rows, CATALOGUE_SCHEMA)

    report = schema_drift_report(schema_diff_import(catalogue(0, str), catalogue(1, WAREHOUSE.get)))
    want = {}
    for i, (source, target) in enumerate(tables):
        pairs = list(zip(source, target))
        drifted = sum(s[0].lower() != t[0].lower() for s, t in pairs)
        retyped = sum(s[0].lower() == t[0].lower() and WAREHOUSE[s[1]] != WAREHOUSE[t[1]] for s, t in pairs)
        added = max(len(source) - len(target), 0) if target else 0
        if added + retyped + drifted:
            want[f"t{i}"] = (added, retyped, drifted)
    assert {r["table_name"]: (r["added"], r["retyped"], r["drifted"]) for r in report.collect()} == want
