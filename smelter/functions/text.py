"""Text measures and masks, as plain column expressions over whole texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as an e-mail address or a phone number, and what replaces it.
EMAIL_PATTERN = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE_PATTERN = r"\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}"
EMAIL_MASK = "[EMAIL]"
PHONE_MASK = "[PHONE]"
ANONYMOUS = "Anonymous"


def mask_text(c: Column) -> Column:
    """Replace every e-mail address, then every phone number.

    The e-mail pattern retries at each character of each word, so texts without an ``@`` skip it; texts without four
    digits in a row, which a phone number ends with, skip the other.
    """
    no_email = F.when(c.contains("@"), F.regexp_replace(c, EMAIL_PATTERN, EMAIL_MASK)).otherwise(c)
    return F.when(c.rlike("[0-9]{4}"), F.regexp_replace(no_email, PHONE_PATTERN, PHONE_MASK)).otherwise(no_email)


def mask_name(c: Column) -> Column:
    """First character, then one asterisk per further character; nothing to show gives ``Anonymous``."""
    return F.when(F.length(c) > 0, F.rpad(F.left(c, F.lit(1)), F.length(c), F.lit("*"))).otherwise(ANONYMOUS)


def count_char(c: Column, ch: str) -> Column:
    """Occurrences of one character."""
    return (F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))).cast("bigint")


def list_size(c: Column, sep: str = ",") -> Column:
    """Items of a delimited string: one more than its separators, so ``''`` has one item.

    Counting separators keeps the value in one expression; ``size(split(..))`` would build an array of
    the whole text for each row.
    """
    return count_char(c, sep) + F.lit(1).cast("bigint")


def word_count(c: Column) -> Column:
    """Items between single blanks (a run of blanks counts its empty items)."""
    return list_size(c, " ")


def char_length(c: Column) -> Column:
    return F.length(c).cast("bigint")


def non_empty_flag(c: Column) -> Column:
    """1 where there is text, 0 for null and ``''``."""
    return F.when(F.length(c) > 0, 1).otherwise(0).cast("bigint")
