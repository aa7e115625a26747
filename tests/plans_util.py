"""Physical plans as text."""


def outer_plan(df) -> str:
    """The plan of ``df`` without the plans that filled its cached inputs."""
    kept, hidden = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        depth = len(line) - len(line.lstrip(" :+-*|"))
        if hidden is not None and depth > hidden:
            continue
        hidden = depth if "InMemoryRelation" in line else None
        kept.append(line)
    return "\n".join(kept)
