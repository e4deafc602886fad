"""The plan that ran, as text."""


def executed_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def ancestors(plan: str, mark: str) -> list[list[str]]:
    """For every line of a plan that holds ``mark``, the operators above it."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-|"))
    lines, out = plan.splitlines(), []
    for i, line in enumerate(lines):
        if mark in line:
            above, d = [], depth(line)
            for other in reversed(lines[:i]):
                if depth(other) < d:
                    above.append(other.strip(" :+-|"))
                    d = depth(other)
            out.append(above)
    return out
