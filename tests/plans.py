"""Helpers that look at executed plans."""

import re


def executed(df) -> str:
    """Executed plan without truncated fields, after running the query once."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan: str) -> list[str]:
    """Partitioning of each shuffle in the plan."""
    return re.findall(r"Exchange ((?:hash|range|round)partitioning\([^)]*|SinglePartition)", plan)


def no_python(plan: str) -> bool:
    return not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas", plan)
