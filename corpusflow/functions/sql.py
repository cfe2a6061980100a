"""Small helpers for writing nested expressions as Spark SQL text.

Higher-order functions nest deeply in HTML handling. As SQL text such an
expression reaches the JVM in one call and is parsed there; built from Column
objects it takes thousands of calls and seconds per query.
"""

from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

_fresh = count()

# Longer than any array, for slices that run to the end.
TO_END = 1 << 30


def lit(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lam(body) -> str:
    """A SQL lambda of one variable."""
    v = f"v{next(_fresh)}"
    return f"{v} -> {body(v)}"


def bind(x: str, body) -> str:
    """body(x) with x evaluated once, however often body uses it."""
    return f"get(transform(array({x}), {lam(body)}), 0)"


def apply(c: Column, body) -> Column:
    """bind() on a Column."""
    return F.get(F.call_function("transform", F.array(c), F.expr(lam(body))), F.lit(0))
