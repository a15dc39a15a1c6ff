"""What a physical plan must and must not hold."""

import re

FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInPandas",
    "MapInArrow",
    "FlatMapGroupsInPandas",
)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(plan, operator):
    return len(re.findall(rf"(?m)^[ :+*()\d-]*{operator}\b", plan))


def check(df):
    plan = executed(df)
    found = [name for name in FORBIDDEN if name in plan]
    assert not found, found
    # a window without keys would pull all rows into one task
    for window in re.findall(r"windowspecdefinition\((\S+)", plan):
        assert "series_key" in window, window
