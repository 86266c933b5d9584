"""The report parses the prepared transcripts once."""

from vaani.plans import catalog as C

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(str, df.collect()))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_staged_outputs_are_the_same(spark):
    plain, staged = C._prepared(spark, SF), C._prepared(spark, SF, stage=True)
    assert _rows(plain.failures) == _rows(staged.failures)
    a, b = plain.segments, staged.segments
    assert a.columns == b.columns and _rows(a) == _rows(b) and a.count()


def test_report_plans_hold_no_parse(spark):
    assert "parsejson" in _plan(C._prepared(spark, SF).segments).replace("_", "")
    assert "parsejson" not in _plan(C._prepare_rows(spark, SF)).replace("_", "")
