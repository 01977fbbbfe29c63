"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and their replacements, pair by pair; the key of an unknown place.
ACCENTED = "áàãâäéèêëíìîïóòõôöúùûüçÁÀÃÂÄÉÈÊËÍÌÎÏÓÒÕÔÖÚÙÛÜÇ"
PLAIN = "aaaaaeeeeiiiiooooouuuucAAAAAEEEEIIIIOOOOOUUUUC"
UNKNOWN_LOCATION = "00000||unknown||XX"

# Characters after which a new word begins, besides white space.
WORD_DELIMITERS = r"""\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""

_WORD_MARK = "\u0001 "


def trim_space(c: Column) -> Column:
    """Strip every kind of Unicode white space from both ends (Spark's ``trim`` knows U+0020 only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def normalize_city(c: Column) -> Column:
    """Lower-case city name without accents and with single blanks."""
    plain = F.translate(c, ACCENTED, PLAIN)
    return F.lower(trim_space(F.regexp_replace(plain, r"[\t\n\f\r ]+", " ")))


def zip5(c: Column) -> Column:
    """Five-character zip prefix with its leading zeros back."""
    return F.lpad(c.cast("string"), 5, "0")


def location_key(zip_code: Column, city: Column, state: Column) -> Column:
    """``zip||city||state``, or the unknown place if any part is missing."""
    return F.coalesce(F.concat(zip_code, F.lit("||"), city, F.lit("||"), state), F.lit(UNKNOWN_LOCATION))


def title_case(c: Column) -> Column:
    """Capitalise each word, where a word also begins after punctuation.

    Spark's ``initcap`` starts words at blanks only, so a marked blank is put behind every other
    delimiter first and taken out again afterwards.
    """
    marked = F.regexp_replace(c, rf"([\t\n\f\r{WORD_DELIMITERS}])", "$1" + _WORD_MARK)
    return F.replace(F.initcap(marked), F.lit(_WORD_MARK), F.lit(""))
