"""Plan inspection helpers (used by tests and when reviewing operators)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints, as a string."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)




def unbounded_nested_loops(text: str) -> list[str]:
    """Nested-loop joins whose broadcast side is not capped at one row.

    Catalyst turns a semi/anti/existence join whose key is a known constant into
    an existence check: a ``BroadcastNestedLoopJoin`` whose build side is
    ``LocalLimit 1``. That is bounded by construction and is not reported; any
    other nested-loop join or cartesian product is.
    """
    lines = text.splitlines()
    bad = []
    for i, ln in enumerate(lines):
        if "CartesianProduct" in ln:
            bad.append(ln.strip())
        m = re.search(r"BroadcastNestedLoopJoin (\w+) (BuildRight|BuildLeft) \((\d+)\)", ln)
        if not m:
            continue
        indent = ln.index("BroadcastNestedLoopJoin")
        # the build child is the BroadcastExchange one level below this node
        child = None
        for nxt in lines[i + 1:]:
            pos = nxt.find("BroadcastExchange")
            if pos == indent + 3:
                child = nxt
                break
            if len(nxt) - len(nxt.lstrip(" :+-")) <= indent - 3:
                break
        j = lines.index(child) if child else -1
        capped = j >= 0 and j + 1 < len(lines) and "LocalLimit" in lines[j + 1]
        if not capped:
            bad.append(ln.strip())
    return bad
