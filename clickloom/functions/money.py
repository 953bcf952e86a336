"""Sums and means of money, exact or as doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ten decimal places, and sums of up to 28 digits before them.
EXACT = "decimal(28,10)"


def exact_amount(amount: Column | str) -> Column:
    """The amount as a decimal; NULL for what is none: NaN, infinities, 1e18 and above."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return amount.try_cast(EXACT)


def unsummed(amount: Column | str) -> Column:
    """Number of amounts that exact sums and means leave out."""
    given = F.col(amount) if isinstance(amount, str) else amount
    return F.count_if(given.isNotNull() & exact_amount(given).isNull())


def total(amount: Column | str, exact: bool = True) -> Column:
    """Sum of amounts as a double.

    Amounts are summed as decimals, so the result does not depend on how the data is
    partitioned; :func:`unsummed` counts what cannot take part. Without ``exact`` they
    are summed as doubles, whose last digits depend on the order the rows meet.
    """
    if not exact:
        return F.sum(amount)
    return F.sum(exact_amount(amount)).cast("double")


def mean(amount: Column | str, exact: bool = True) -> Column:
    """Mean amount as a double; ``exact`` as in :func:`total`."""
    if not exact:
        return F.avg(amount)
    return F.try_divide(total(amount), F.count(exact_amount(amount)))
