"""What tests ask of a plan."""


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled(df) -> list[tuple[str, int]]:
    """What stands below each shuffle of a plan without adaptive execution, and the rows it moves when the plan runs."""
    plan, found = df._jdf.queryExecution().executedPlan(), []
    plan.execute().count()

    def walk(node):
        if node.nodeName() == "Exchange":
            found.append((node.toString(), node.metrics().apply("shuffleRecordsWritten").value()))
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    return found
