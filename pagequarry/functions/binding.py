"""A value used several times in an expression."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` in the expression once.

    Steps that mention their argument several times would otherwise multiply
    when they are chained, and the plan with them.
    """
    return F.transform(F.array(value), body)[0]
