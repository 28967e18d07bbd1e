"""String cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode space separators (category Zs). Spark's trim strips
# U+0020 only, so they are named; tabs and line ends are not among them.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)


def clean_str(column: Column | str) -> Column:
    """Strip space separators from both ends.

    Text of one-byte characters has no separator but U+0020, which the plain trim takes
    off several times faster.
    """
    column = F.col(column) if isinstance(column, str) else column
    one_byte = F.octet_length(column) == F.char_length(column)
    return F.when(one_byte, F.trim(column)).otherwise(
        F.btrim(column, F.lit(SPACE_SEPARATORS))
    )


def empty_to_null(column: Column | str) -> Column:
    """Strip, then turn what is left empty into NULL."""
    return F.nullif(clean_str(column), F.lit(""))
