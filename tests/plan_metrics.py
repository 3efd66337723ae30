"""Figures of a plan's shuffles after it ran (for plans without adaptive stages)."""


def exchanges(df, metric):
    """``metric`` of every exchange of ``df``, from the top of the plan down."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    nodes, found = [plan], []
    while nodes:
        node = nodes.pop(0)
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply(metric).value())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return found
