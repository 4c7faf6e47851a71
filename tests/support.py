"""What several test modules use; conftest.py holds fixtures only, as its name is not unique."""

SMALL = "/root/testdata/sf0.001"


def rows(df, *order):
    """Rows as tuples, sorted by the given columns (or by everything)."""
    names = list(order) or df.columns
    return [tuple(r) for r in df.orderBy(*names).collect()]


def plan_text(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
