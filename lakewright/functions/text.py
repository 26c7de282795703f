"""Small text helpers shared by the column rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The characters Unicode and ASCII call white space, without the blank.
WHITE_SPACE = (
    "\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column) -> Column:
    """``value`` without any white space at its ends (``trim`` drops blanks only).

    Blanks go the fast way; the pattern runs only where something else is left.
    """
    short = F.trim(value)
    ends = F.left(short, F.lit(1)).isin(*WHITE_SPACE) | F.right(short, F.lit(1)).isin(*WHITE_SPACE)
    white = "[ " + WHITE_SPACE + "]+"
    return F.when(ends, F.regexp_replace(short, f"^{white}|{white}$", "")).otherwise(short)
