"""A05–A09 with caller-given states."""

from __future__ import annotations

import pyarrow.compute as pc

from vireo.operators.combiners import Combiner, combine_general, tree_general
from vireo.plans.registry import query
from vireo.sources.tables import table

_LINES = ["l_quantity", "l_extendedprice", "l_orderkey", "l_linenumber"]
#: Rows up to which plain Python takes less time than calls of Arrow functions.
FEW = 20


def mean_and_cheapest() -> Combiner:
    """Rows, the sum of quantities, and the line with the lowest price (the first order and line of equal ones)."""
    def plus(a, b):
        return b if a is None else a if b is None else a + b

    def least(*found):
        return min((x for x in found if x is not None), default=None)

    def add(state, rows):
        if rows.num_rows <= FEW:
            quantity, price, order, line = (rows.column(c).to_pylist() for c in _LINES)
            total = sum(known) if (known := [q for q in quantity if q is not None]) else None
            first = min((x for x in zip(price, order, line) if x[0] is not None and x[0] == x[0]), default=None)
        else:
            price = rows.column("l_extendedprice")
            lines = rows.filter(pc.equal(price, pc.min(price)))
            total = pc.sum(rows.column("l_quantity")).as_py()
            first = min(zip(*(lines.column(c).to_pylist() for c in _LINES[1:])), default=None)
        return state[0] + rows.num_rows, plus(state[1], total), least(state[2], first)

    def merge(a, b):
        return a[0] + b[0], plus(a[1], b[1]), least(a[2], b[2])

    def finish(s):
        return s[0], None if s[1] is None else s[1] / s[0], *(s[2] or (None, None, None))

    return Combiner(lambda: (0, None, None), add, merge, finish, "n long, mean_qty double, low_price double, low_order long, low_line int")


_LOWEST = """count(*) AS n, sum(l_quantity) / count(*) AS mean_qty, min(l_extendedprice) AS low_price,
  CAST(arg_min(l_orderkey, (l_extendedprice, l_orderkey, l_linenumber)) AS BIGINT) AS low_order,
  CAST(arg_min(l_linenumber, (l_extendedprice, l_orderkey, l_linenumber)) AS INT) AS low_line FROM lineitem"""


@query("combine_general", sql=f"SELECT l_suppkey, {_LOWEST} GROUP BY l_suppkey")
def combine_lines(spark, sf):
    """A state that is no sum, per supplier."""
    return combine_general(table(spark, sf, "lineitem"), "l_suppkey", _LINES, mean_and_cheapest())


@query("tree_general", sql=f"SELECT {_LOWEST}")
def tree_lines(spark, sf):
    """The same state over the whole table, merged in a tree."""
    return tree_general(table(spark, sf, "lineitem"), _LINES, mean_and_cheapest())
