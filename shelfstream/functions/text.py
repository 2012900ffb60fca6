"""Text, price, year and ISBN rules as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column, functions as F

# Letters with a stroke, which Unicode does not decompose, and the plain letters they fold to.
STROKED = "\u00f8\u0142\u0111"
UNSTROKED = "old"


@cache
def folds() -> tuple[str, str]:
    """Every composed letter of the basic plane and the letter it is composed on, by Unicode's own decompositions."""
    pairs = {}
    for code in range(0xC0, 0xD800):
        whole = unicodedata.normalize("NFD", chr(code))
        if len(whole) > 1 and whole[0].isalpha() and all(unicodedata.category(mark).startswith("M") for mark in whole[1:]):
            pairs[chr(code)] = whole[0]
    return "".join(pairs) + STROKED, "".join(pairs.values()) + UNSTROKED


def blank_if_null(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def csv_protect(value: Column, trim: bool = True) -> Column:
    """Quote a CSV field only when it holds a non-alphanumeric character.

    With ``trim`` one trailing slash and then trailing white space are dropped
    first (catalogue titles end in ``" /"``).
    """
    text = blank_if_null(value)
    if trim:
        text = F.regexp_replace(F.regexp_replace(text, r"/$", ""), r"\s+$", "")
    doubled = F.replace(text, F.lit('"'), F.lit('""'))
    return F.when(doubled.rlike("[^a-zA-Z0-9]"), F.concat(F.lit('"'), doubled, F.lit('"'))).otherwise(doubled)


def csv_line(fields: Sequence[Column]) -> Column:
    return F.concat_ws(",", *[blank_if_null(field) for field in fields])


def hash_quote(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull() | (text == ""), F.lit("")).otherwise(F.concat(F.lit("##"), text, F.lit("##")))


def attempt_year(value: Column) -> Column:
    return F.substring(F.regexp_replace(value, "[^0-9]", ""), 1, 4)


def attempt_price(value: Column) -> Column:
    """Price text to cents; text without a usable number gives ``''``, NULL stays NULL."""
    amount = F.regexp_replace(value, "[^0-9.]", "").try_cast("decimal(8,2)")
    cents = (amount * 100).cast("int").cast("string")
    return F.when(value.isNotNull(), F.coalesce(cents, F.lit("")))


def price_fallback(first: Column, second: Column) -> Column:
    return F.coalesce(F.nullif(first, F.lit("")), second)


def isbn_token(value: Column) -> Column:
    """Leading token of an 020 value, up to white space, bracket, colon or full stop."""
    return F.regexp_extract(value, r"^\s*([^\s():.]*)", 1)


def _isbn13_from_ten(ten: Column) -> Column:
    body = F.concat(F.lit("978"), F.substring(ten, 1, 9))
    weighted = [
        F.substring(body, place, 1).cast("int") * (1 if place % 2 else 3) for place in range(1, 13)
    ]
    total = weighted[0]
    for term in weighted[1:]:
        total = total + term
    return F.concat(body, F.pmod(F.lit(10) - total % 10, F.lit(10)).cast("string"))


def norm_isbn(value: Column) -> Column:
    """Canonical ISBN-13 text, or NULL where the text starts with no ISBN."""
    packed = F.lower(F.regexp_replace(value, r"[-\s]", ""))
    return (
        F.when(packed.rlike(r"^\d{12}[0-9x]"), F.nullif(
            F.when(packed.rlike(r"^\d*[1-9]"), F.substring(packed, 1, 13)), F.lit("")))
        .when(packed.rlike(r"^\d{9}[0-9x]"), _isbn13_from_ten(packed))
    )


def extract_isbns(joined: Column, separator: str = ";") -> Column:
    """Normalised distinct ISBNs of a separated list, in first-seen order."""
    parts = F.transform(F.split(joined, separator), norm_isbn)
    return F.coalesce(F.array_join(F.array_distinct(F.filter(parts, lambda p: p.isNotNull())), separator), F.lit(""))


def uniq_list(values: Column) -> Column:
    return F.array_distinct(values)


def naco_normalize(value: Column) -> Column:
    """Approximate authority-heading normalisation.

    Lower case, no diacritics (composed or combining), no apostrophes or square brackets, other
    punctuation as single spaces.
    """
    folded = F.translate(F.lower(value), *folds())
    bare = F.regexp_replace(folded, r"['\[\]\p{M}]", "")
    return F.trim(F.regexp_replace(bare, r"[^\p{L}\p{N}]+", " "))


def call_number_display(prefix: Column, label: Column, suffix: Column) -> Column:
    return F.trim(F.concat_ws(" ", prefix, label, suffix))
