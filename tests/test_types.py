"""Loads whose columns change their types (A10)."""

import datetime
import decimal

import pytest
from pyspark.sql import types as T

from stellate.functions.types import variant_name, widened


@pytest.mark.parametrize("old,new,wide", [
    (T.IntegerType(), T.LongType(), T.LongType()), (T.LongType(), T.ShortType(), T.LongType()), (T.IntegerType(), T.DoubleType(), T.DoubleType()),
    (T.LongType(), T.DoubleType(), None), (T.DoubleType(), T.LongType(), None), (T.FloatType(), T.DoubleType(), T.DoubleType()),
    (T.LongType(), T.DecimalType(10, 2), T.DecimalType(22, 2)), (T.DecimalType(10, 2), T.DecimalType(12, 6), T.DecimalType(14, 6)),
    (T.DecimalType(38, 0), T.DecimalType(38, 10), None), (T.StringType(), T.LongType(), T.StringType()), (T.LongType(), T.StringType(), None),
    (T.BooleanType(), T.IntegerType(), None), (T.StringType(), T.ArrayType(T.LongType()), None), (T.DateType(), T.TimestampType(), None)])
def test_widening_is_exact(old, new, wide):
    assert widened(old, new) == wide


def test_variant_names():
    assert [variant_name("a", t) for t in (T.StringType(), T.DecimalType(9, 2), T.ArrayType(T.LongType()))] == ["a__v_string", "a__v_decimal", "a__v_array"]


def test_appends_with_changed_types(spark, store):
    loads = [("k int, v int, w bigint, x string", [(1, 1, 10, "a")]),
             ("k bigint, v double, w string, x bigint", [(2 ** 40, 2.5, "ten", 9)]),
             ("k smallint, v int, w boolean, x date", [(3, 3, True, datetime.date(2024, 1, 2))]),
             ("k decimal(5,1), v string, w string, x array<int>", [(decimal.Decimal("4.5"), "four", None, [1])])]
    for schema, rows in loads:
        store.append("s.t", spark.createDataFrame(rows, schema))
    rows = {float(r["k"]): r.asDict() for r in store.read("s.t").collect()}
    assert {k: r["v"] for k, r in rows.items()} == {1.0: 1.0, float(2 ** 40): 2.5, 3.0: 3.0, 4.5: None}
    assert {k: r["v__v_string"] for k, r in rows.items()} == {1.0: None, float(2 ** 40): None, 3.0: None, 4.5: "four"}
    assert [rows[k]["w"] for k in (1.0, 3.0)] == [10, None] and rows[float(2 ** 40)]["w__v_string"] == "ten" and rows[3.0]["w__v_boolean"] is True
    assert rows[float(2 ** 40)]["x"] == "9" and rows[3.0]["x"] == "2024-01-02" and rows[4.5]["x"] is None and rows[4.5]["x__v_array"] == [1]
    with pytest.raises(TypeError):  # what another writer has changed meanwhile is refused, not misread
        store.commit({"s.t": type(store.write_version("s.t", spark.range(1)))("append", "nowhere", T.StructType([T.StructField("v", T.BooleanType())]))})
