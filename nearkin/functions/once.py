"""Keeping expensive expressions from being worked out more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.functions.vectors import quoted


def computed_once(df: DataFrame, *names: str) -> DataFrame:
    """The same table, the named columns last and fixed.

    The planner moves a filter below the projection it stands on by copying the
    projected expressions into the filter, each as often as it is named there.
    For long expressions this costs the work several times over, and the
    generated code grows past what the JIT compiles. Unfolding the columns with
    ``inline`` stops that; the rows are still passed on one by one.
    """
    others = [F.col(quoted(name)) for name in df.columns if name not in names]
    fixed = F.struct(*[F.col(quoted(name)) for name in names])
    return df.select(*others, F.inline(F.array(fixed)))
