"""String clean-up for keys and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space at the ends of a text.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The visible ASCII characters lie from the first to below the second.
VISIBLE = "!", "\x7f"

# Marks carried by names and keys.
SHARED_MARK = "~"
NAME_MARK = "*"
VALID_ISBN_LENGTH = 13


def strip(column: Column) -> Column:
    """Remove white space of any kind from both ends (SQL TRIM only takes spaces).

    Most texts begin and end with a visible ASCII character; two comparisons
    tell, and spare them the search through the white-space characters.
    """
    low, high = VISIBLE
    last = F.substring(column, -1, 1)
    clean = (column >= low) & (column < high) & (last >= low) & (last < high)
    return F.when(clean, column).otherwise(F.btrim(column, F.lit(WHITE_SPACE)))


def strip_hyphens(column: Column) -> Column:
    return F.replace(column, F.lit("-"), F.lit(""))


def strip_name_mark(column: Column) -> Column:
    return F.replace(column, F.lit(NAME_MARK), F.lit(""))


def mark_shared(column: Column) -> Column:
    return F.concat(column, F.lit(SHARED_MARK))


def repair_isbn(column: Column) -> Column:
    """Undo what a spreadsheet does to a 13-digit code it took for a number.

    The order of the removals matters: ``.0`` goes before a lone ``.``.
    """
    for remnant in (".0", ".", "E+", "e+"):
        column = F.replace(column, F.lit(remnant), F.lit(""))
    return column


def is_invalid_isbn(column: Column) -> Column:
    """True where the code does not have 13 characters; a missing code is invalid."""
    return F.coalesce(F.length(column) != VALID_ISBN_LENGTH, F.lit(True))
