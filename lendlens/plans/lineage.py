"""P3 by lineage: which columns a column is computed from, read off the analysed plan.

A check of names misses an outcome that was renamed or went into a derived
input.  Every attribute of the plan has an id; an alias refers to the ids of
its inputs, a union to its branches, a generator to what it reads.  Following them
from a column gives every name on its way back to the stored tables.
Conditions of filters and joins are not followed: they choose rows, not values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _ids(attributes) -> set[int]:
    return {a.exprId().id() for a in _items(attributes.toSeq())}


def _aliases(expression, parents: dict) -> None:
    """Alias id -> ids it refers to, for all aliases inside an expression."""
    kind = expression.getClass().getSimpleName()
    if kind == "Alias":
        parents.setdefault(expression.exprId().id(), set()).update(_ids(expression.references()))
    for child in _items(expression.children()):
        _aliases(child, parents)


def ancestors(df: DataFrame) -> dict[str, set[str]]:
    """Output column -> names of all columns it is computed from (its own name left out unless it is stored under it)."""
    plan = df._jdf.queryExecution().analyzed()
    parents: dict[int, set[int]] = {}
    names: dict[int, str] = {}
    todo = [plan]
    while todo:
        node = todo.pop()
        children = _items(node.children())
        todo += children
        for a in _items(node.output()):
            names[a.exprId().id()] = a.name()
        kind = node.getClass().getSimpleName()
        if kind == "Union":
            for k, a in enumerate(_items(node.output())):
                parents.setdefault(a.exprId().id(), set()).update(c.output().apply(k).exprId().id() for c in children)
        elif kind == "Generate":
            read = _ids(node.generator().references())
            for a in _items(node.generatorOutput()):
                parents.setdefault(a.exprId().id(), set()).update(read)
        elif kind in ("MapInPandas", "MapInArrow", "FlatMapGroupsInPandas", "FlatMapGroupsInArrow", "FlatMapCoGroupsInPandas"):
            read = {a.exprId().id() for c in children for a in _items(c.output())}       # a function may use all it is given
            for a in _items(node.output()):
                parents.setdefault(a.exprId().id(), set()).update(read)
        for e in _items(node.expressions()):
            _aliases(e, parents)
    out = {}
    for a in _items(plan.output()):
        start = a.exprId().id()
        seen, todo_ids = set(), [start]
        while todo_ids:
            i = todo_ids.pop()
            for p in parents.get(i, ()):
                if p != i and p not in seen:
                    seen.add(p)
                    todo_ids.append(p)
        out[a.name()] = {names[i] for i in seen if i in names}
    return out
