from datetime import datetime

TINY = "/root/testdata/sf0.001"


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df, *order):
    """Rows as plain tuples, sorted by their text."""
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
