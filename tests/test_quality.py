import pytest

from stellate.operators.quality import QualityCheckError, enforce, quality_report


def _tables(spark):
    mk = lambda rows: spark.createDataFrame(rows, "k int, v string")
    return {
        "empty": (mk([]), "k"),
        "one_row": (mk([(1, "a")]), "k"),
        "one_null": (mk([(None, "a"), (2, "b")]), "k"),
        "two_null": (mk([(None, "a"), (None, "b"), (3, "c")]), "k"),
        "no_null": (mk([(1, "a"), (2, "b")]), "k"),
    }


def test_report_rows(spark):
    rows = {(r["table"], r["check"]): r for r in quality_report(_tables(spark)).collect()}
    assert len(rows) == 10
    assert rows[("empty", "not_empty")]["passed"] is False
    assert rows[("empty", "not_empty")]["n_rows"] == 0
    assert rows[("one_row", "not_empty")]["passed"] is True
    assert rows[("one_null", "null_key")]["n_bad"] == 1
    assert rows[("one_null", "null_key")]["passed"] is False
    assert rows[("two_null", "null_key")]["n_bad"] == 2
    assert rows[("no_null", "null_key")]["passed"] is True


def test_threshold_reproduces_lenient_rule(spark):
    rows = {(r["table"], r["check"]): r["passed"]
            for r in quality_report(_tables(spark), null_key_threshold=1).collect()}
    assert rows[("one_null", "null_key")] is True
    assert rows[("two_null", "null_key")] is False


def test_enforce(spark):
    report = quality_report(_tables(spark))
    assert len(enforce(report, "report")) == 10
    with pytest.raises(QualityCheckError, match="empty:not_empty"):
        enforce(report, "raise")


def test_null_key_check_must_precede_assertion(spark):
    from stellate.operators.columns import require_not_null

    df = spark.createDataFrame([(None,), (1,)], "k int")
    plain = {r["check"]: r for r in quality_report({"t": (df, "k")}).collect()}
    assert plain["null_key"]["n_bad"] == 1 and plain["null_key"]["passed"] is False
    # Documented pitfall: after the assertion the optimizer folds the count.
    asserted = {r["check"]: r for r in
                quality_report({"t": (require_not_null(df, ["k"]), "k")}).collect()}
    assert asserted["null_key"]["n_bad"] == 0


def test_star_tables_keep_nulls_for_checks(spark):
    from stellate.plans import tables as TB
    from stellate import schemas

    a = spark.createDataFrame([tuple(20545.0 if n == "arrdate" else None
                                     for n in schemas.ARRIVALS.fieldNames())], schemas.ARRIVALS)
    fact = TB.build_fact_immigration(TB.with_arrival_dates(a), with_id=False, assert_keys=False)
    rows = {r["check"]: r for r in quality_report({"fact": (fact, "cicid")}).collect()}
    assert rows["null_key"]["n_bad"] == 1
