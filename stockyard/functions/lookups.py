"""Code and state lookups, as literal maps and CASE arms that stay inside codegen."""

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockyard import fixed_values as V


def _literal(kind: str, values) -> Column:
    """A literal ``map`` or ``array``, folded to a constant by Catalyst."""
    return F.expr(f"{kind}({', '.join(repr(v) for v in values)})")


def _literal_map(pairs: dict) -> Column:
    return _literal("map", chain.from_iterable(pairs.items()))


def supervisor_of(state: Column) -> Column:
    by_state = {uf: who for who, states in V.SUPERVISOR_STATES.items() for uf in states}
    return F.coalesce(F.element_at(_literal_map(by_state), state), F.lit(V.NO_SUPERVISOR))


def cost_center_of(code: Column) -> Column:
    return F.coalesce(F.element_at(_literal_map(V.COST_CENTERS), code), F.lit(V.NO_COST_CENTER))


def branch_size_of(code: Column) -> Column:
    return (F.when(code.isin(V.LARGE_BRANCHES), V.LARGE)
            .when(code.isin(V.SMALL_BRANCHES), V.SMALL)
            .otherwise(V.MEDIUM))


def name_at(names: list[str], position: Column) -> Column:
    """1-based name; NULL outside the list."""
    return F.get(_literal("array", names), position - 1)
