def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
