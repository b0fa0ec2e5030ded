"""Status code to label. The three label words."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def status_label(code: Column, strict_bounds: bool = False) -> Column:
    """``success`` for 2xx, ``error`` for 4xx and 5xx, else ``unknown``.

    ``strict_bounds`` leaves out both ends of each hundred (200, 299, 400, ...), which are
    then ``unknown``.
    """
    def within(low: int) -> Column:
        high = low + 99
        if strict_bounds:
            return (code > low) & (code < high)
        return code.between(low, high)

    return (
        F.when(within(200), "success")
        .when(within(400) | within(500), "error")
        .otherwise("unknown")
    )
