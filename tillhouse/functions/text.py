"""Text cleaning: names, e-mails, phones, addresses (CLN1-CLN13, CLN19-CLN20).

Everything is a ``Column -> Column`` expression inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that must match the source rules exactly.
NON_PRINTABLE = r"[^\x20-\x7E]"
PHONE_PUNCTUATION = r"[-().]"
US_PREFIX = r"^(?:\+1|001)"
STORE_PHONE_NOISE = r"[^0-9x+()-]"
DUPLICATE_MARKER = "DUP"
EMAIL_SHAPE = "%@%.%"


def blank(c: Column) -> Column:
    """NULL or nothing but spaces."""
    return c.isNull() | (F.trim(c) == "")


def strip_non_printable(c: Column) -> Column:
    """CLN1: keep printable ASCII only, then trim."""
    return F.trim(F.regexp_replace(c, NON_PRINTABLE, ""))


def is_clean(c: Column) -> Column:
    """True when the cleaning of :func:`strip_non_printable` changes nothing."""
    return c == strip_non_printable(c)


def full_name(first: Column, last: Column) -> Column:
    """CLN3: 'first last'; NULL if either part is NULL."""
    return F.concat(strip_non_printable(first), F.lit(" "), strip_non_printable(last))


def normalize_email(c: Column) -> Column:
    """CLN4: repair ' at ', lower-case, and drop what has no address shape."""
    address = F.lower(F.trim(F.regexp_replace(c, " at ", "@")))
    return F.when(~blank(c) & address.like(EMAIL_SHAPE), address)


def _without_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, PHONE_PUNCTUATION, "")


def phone_country_code(c: Column) -> Column:
    """CLN5: '+1' for US-prefixed numbers."""
    bare = _without_punctuation(c)
    return F.when(bare.contains("+1") | bare.startswith("001"), F.lit("+1"))


def phone_extension(c: Column) -> Column:
    """CLN6: what follows the first 'x'."""
    return F.when(c.contains("x"), F.split_part(c, F.lit("x"), F.lit(2)))


def phone_extract(c: Column) -> Column:
    """CLN7: the subscriber number without prefix and extension."""
    bare = _without_punctuation(c)
    prefixed = bare.startswith("+1") | bare.startswith("001")
    odd_start = bare.startswith("+") | bare.startswith("001")
    extended = bare.contains("x")
    short_plain = (F.length(bare) <= 10) & ~odd_start & ~extended
    return (
        F.when(short_plain, bare)
        .when(prefixed & extended, F.regexp_extract(bare, US_PREFIX + r"(\d+?)x", 1))
        .when(prefixed, F.regexp_replace(bare, US_PREFIX, ""))
        .when(extended & ~odd_start, F.regexp_extract(bare, r"^(\d+?)x", 1))
        .otherwise(bare)
    )


def phone_digits(c: Column) -> Column:
    """Every digit of the number, nothing else."""
    return F.regexp_replace(c, "[^0-9]", "")


def digits_after_x(c: Column) -> Column:
    """CLN8: extension digits inside an already extracted phone."""
    return F.when(c.contains("x"), F.regexp_extract(c, r"x(\d+)", 1))


def drop_first_non_digit(c: Column) -> Column:
    """Remove one non-digit only: the rule is a first-match replace."""
    return F.regexp_replace(c, r"(?s)^([0-9]*)[^0-9]", "$1")


def phone_digits_only(c: Column) -> Column:
    """CLN8: cut the extension, then drop the first non-digit."""
    return drop_first_non_digit(F.regexp_replace(c, r"x[^\n]*$", ""))


def store_phone(c: Column) -> Column:
    """CLN9: keep digits and ``x+()-``."""
    return F.regexp_replace(c, STORE_PHONE_NOISE, "")


def street_from_address(c: Column) -> Column:
    """CLN10: the first line; failing that, the part before the comma."""
    newline, comma = F.lit("\n"), F.lit(",")
    cut = F.when(c.contains("\n"), F.split_part(c, newline, F.lit(1))).otherwise(
        F.split_part(c, comma, F.lit(1))
    )
    return F.when(~blank(c), F.trim(cut))


def full_address(street: Column, city: Column, state: Column, zip_code: Column) -> Column:
    """CLN11: 'street, city, state zip'."""
    return F.concat(street, F.lit(", "), city, F.lit(", "), state, F.lit(" "), zip_code)


def map_enum(c: Column, mapping: dict[str, str], default: str | None = None) -> Column:
    """CLN12: case-insensitive relabelling."""
    token = F.upper(F.trim(c))
    result = None
    for label in dict.fromkeys(mapping.values()):
        spellings = [k for k, v in mapping.items() if v == label]
        test = token.isin(*spellings)
        result = F.when(test, label) if result is None else result.when(test, label)
    return result.otherwise(F.lit(default).cast("string"))


# Label sets of the customer enums.
GENDERS = {"MALE": "Male", "M": "Male", "FEMALE": "Female", "F": "Female", "OTHER": "Other"}
CONTACTS = {"EMAIL": "Email", "PHONE": "Phone", "SMS": "SMS"}
SEGMENTS = {"VIP": "VIP", "PREMIUM": "Premium", "REGULAR": "Regular", "BUDGET": "Budget"}


def default_bool(c: Column) -> Column:
    """CLN13: a missing flag counts as false."""
    return F.coalesce(c, F.lit(False))


def strip_dup_marker(c: Column) -> Column:
    """CLN19: the id a duplicate-marked row is a copy of."""
    return F.replace(c, F.lit(DUPLICATE_MARKER), F.lit(""))


def upper_trim(c: Column) -> Column:
    """CLN20."""
    return F.upper(F.trim(c))
