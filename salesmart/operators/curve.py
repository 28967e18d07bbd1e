"""Rows laid along a curve through several columns, so that filters on each of them skip files."""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX_BYTES = 7  # as many bytes of a text as a long can hold in order


def _number(df: DataFrame, name: str, skipped: dict[str, int]) -> Column:
    """A number that orders as the column does; of texts the bytes after what all begin with."""
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, T.NumericType):
        return column.cast("double")
    if not isinstance(kind, T.StringType):
        raise TypeError(f"{name}: {kind.simpleString()} has no order to cluster by")
    first = F.substring(F.encode(column, "UTF-8"), skipped[name] + 1, PREFIX_BYTES)
    return F.conv(F.rpad(F.hex(first), 2 * PREFIX_BYTES, "0"), 16, 10).cast("double")


def curve_position(df: DataFrame, columns: Sequence[str], bits: int = 5) -> Column:
    """Where a row lies on the curve: the bits of the columns' ranks, one of each in turn.

    A column's rank is the one of at most ``2**bits`` ranges of about equal row counts, or
    distinct values, that its value falls in; the bounds come to the driver. Ranks are spread
    over all ``bits``, so a column of few values takes part in the leading bits too. NULL has
    the least rank. ``df`` is read twice for it, if any column holds text; store it first.
    """
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    skipped = {}
    if texts:
        ends = df.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in texts for f in (F.min, F.max)]).first()
        for c in texts:
            least, most = ((ends[f"{f}_{c}"] or "").encode() for f in ("min", "max"))
            skipped[c] = len(os.path.commonprefix([least, most]))
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = {c: _number(df, c, skipped) for c in columns}
    found = df.agg(*[F.percentile_approx(numbers[c], cuts).alias(c) for c in columns]).first()
    position = F.lit(0).cast("long")
    for j, c in enumerate(columns):
        bounds = sorted(set(found[c] or ()))
        above = reduce(add, [(numbers[c] > b).cast("int") for b in bounds], F.lit(0))
        rank = F.floor(F.coalesce(above, F.lit(0)) * (1 << bits) / (len(bounds) + 1)).cast("long")
        for i in range(bits):
            bit = F.shiftright(rank, i).bitwiseAND(F.lit(1).cast("long"))
            position = position + F.shiftleft(bit, i * len(columns) + len(columns) - 1 - j)
    return position
