import pytest

from stellate.operators.checks import (ConstraintViolation, fk_violations, merge_cardinality_violations,
                                       null_counts, pk_violations, require_not_null)


def test_pk_violations(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    got = {(r.k, r.n) for r in pk_violations(df, "k").collect()}
    assert got == {(1, 2), (None, 1)}


def test_fk_violations_ignore_nulls(spark):
    fact = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id long, fk long")
    dim = spark.createDataFrame([(10,)], "k long")
    assert [r.id for r in fk_violations(fact, "fk", dim, "k").collect()] == [2]


def test_not_null(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "a long, b string")
    assert {(r.column_name, r.n_nulls) for r in null_counts(df, ["a", "b"]).collect()} == {("a", 0), ("b", 1)}
    with pytest.raises(ConstraintViolation) as e:
        require_not_null(df, ["b"])
    assert e.value.getSqlState() == "23502"
    require_not_null(df, ["a"])


def test_merge_cardinality(spark):
    target = spark.createDataFrame([("A",), ("B",)], "k string")
    source = spark.createDataFrame([("A",), ("A",), ("C",), ("C",), ("B",)], "k string")
    assert [r.k for r in merge_cardinality_violations(source, target, ["k"]).collect()] == ["A"]


def test_fk_violation_counts_single_pass(spark):
    from stellate.operators.checks import fk_violation_counts
    fact = spark.createDataFrame([(1, 10), (2, 99), (None, 10), (3, None)], "a long, b long")
    da = spark.createDataFrame([(1,), (2,), (2,)], "k long")
    db = spark.createDataFrame([(10,)], "k long")
    assert fk_violation_counts(fact, [("a", da, "k"), ("b", db, "k")]) == {"a": 1, "b": 1}


def test_sqlstate_of_wrappers():
    from stellate.plans.audit import message_of, sqlstate_of

    class JavaErr:
        def __init__(self, state, cause=None):
            self.state, self.cause = state, cause

        def getSqlState(self):  # noqa: N802
            if self.state is None:
                raise RuntimeError("no such method")
            return self.state

        def getCause(self):  # noqa: N802
            return self.cause

    class Py4JLike(Exception):
        pass

    wrapped = Py4JLike("An error occurred\n\nJVM stacktrace:\nat ...")
    wrapped.java_exception = JavaErr(None, JavaErr("22012"))
    assert sqlstate_of(wrapped) == "22012"
    assert message_of(wrapped) == "An error occurred"
    assert sqlstate_of(ValueError("x")) == "ValueError"
    try:
        try:
            raise ConstraintViolation("dup", "23505")
        except ConstraintViolation as inner:
            raise RuntimeError("job failed") from inner
    except RuntimeError as outer:
        assert sqlstate_of(outer) == "23505"
