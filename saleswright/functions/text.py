"""Text standardisation. All built-in expressions; NULL stays NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The address form that counts as valid (ASCII only, no padding)
# and the characters a phone number keeps.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE_NOISE = "[^0-9+]"


def title_text(text: Column) -> Column:
    """Names and places: padding removed, each space-separated word capitalised."""
    return F.initcap(F.trim(text))


def code_text(text: Column) -> Column:
    """Codes such as payment method and segment: padding removed, upper case."""
    return F.upper(F.trim(text))


def valid_email(text: Column) -> Column:
    """Lower-cased address, or NULL where the form is not valid.

    The form is tested on the text as it came, so a padded address is invalid.
    """
    return F.when(text.rlike(EMAIL_PATTERN), F.lower(F.trim(text)))


def phone_digits(text: Column) -> Column:
    """Digits and plus signs only."""
    return F.regexp_replace(text, PHONE_NOISE, "")


def has_non_ascii(text: Column) -> Column:
    """True where any character lies outside ASCII."""
    return text.rlike(r"[^\x00-\x7F]")
