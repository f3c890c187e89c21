"""Normalising names, e-mail addresses and phone numbers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as a blank.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_ODD_BLANKS = BLANKS.replace(" ", "")


def clean_name(c: Column) -> Column:
    """Upper case, no blanks at the edges, single spaces inside."""
    spaced = F.trim(F.translate(F.upper(c), _ODD_BLANKS, " " * len(_ODD_BLANKS)))
    return F.when(spaced.contains("  "), F.regexp_replace(spaced, " {2,}", " ")).otherwise(spaced)


def clean_email(c: Column) -> Column:
    """Lower case, no blanks at the edges."""
    return F.btrim(F.lower(c), F.lit(BLANKS))


def clean_phone(c: Column) -> Column:
    """The last ten digits; shorter numbers are kept whole."""
    return F.right(F.regexp_replace(c, r"(?U)\D+", ""), F.lit(10))
