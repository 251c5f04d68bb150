"""Helpers that look at physical plans."""


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    """The plan after it has run, with what AQE changed on the way."""
    df.collect()
    return planned(df)
