"""Plan text of a DataFrame."""


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The adaptive plan as it ran."""
    rows = df._jdf.queryExecution()
    rows.executedPlan().execute().count()
    return rows.executedPlan().toString()
