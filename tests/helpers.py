"""What the tests share beside their fixtures."""

import datetime as dt

from starloom.spec import LoadStamp


def day(text):
    return dt.date.fromisoformat(text)


def at(text):
    return LoadStamp(dt.datetime.fromisoformat(text + " 06:00:00"), "tester")


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def scanned_files(df):
    """Files that a plan's scans open, after pruning."""
    df = df.select("*")  # a plan counts its files when it is run for the first time
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "FileSourceScanExec":
            total += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return total
