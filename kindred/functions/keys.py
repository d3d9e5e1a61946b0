"""Blocking-key and token scalars.

Three street-number and three postal-code definitions exist side by side; the names say which.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kindred.functions.normalize import fold, tokens

#: Address tokens that say nothing about a place.
GENERIC = (
    "road rd street st avenue ave lane ln drive dr route highway hwy boulevard blvd parkway pkwy place pl court ct way "
    "city town county state north south east west n s e w india indian united states usa america maharashtra california texas florida"
).split()
DIGITS = r"(\p{Nd}+)"


def _text(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def postal_last(address: Column) -> Column:
    """The last digit run of the raw address."""
    return F.coalesce(F.try_element_at(F.regexp_extract_all(_text(address), F.lit(DIGITS), F.lit(1)), F.lit(-1)), F.lit(""))


def street_lead(address: Column) -> Column:
    """A digit run that starts the raw address."""
    return F.regexp_extract(_text(address), r"^\s*" + DIGITS, 1)


def first_token(core: Column) -> Column:
    return F.coalesce(F.try_element_at(tokens(core), F.lit(1)), F.lit(""))


def last_token(core: Column) -> Column:
    return F.coalesce(F.try_element_at(tokens(core), F.lit(-1)), F.lit(""))


def sorted_name(core: Column) -> Column:
    return F.array_join(F.sort_array(tokens(core)), " ")


def long_tokens(address: Column) -> Column:
    """Lower-case alphanumeric tokens of three characters or more, in order, repeats kept."""
    return F.filter(F.split(F.regexp_replace(F.lower(_text(address)), "[^a-z0-9]", " "), " "), lambda t: F.length(t) >= 3)


def addr_sig(address: Column) -> Column:
    return F.array_join(F.sort_array(long_tokens(address)), "_")


def num_any(address: Column) -> Column:
    """The first digit run anywhere in the raw address."""
    return F.regexp_extract(_text(address), DIGITS, 1)


def postal_56(address: Column) -> Column:
    """The first five or six digits in a row, even within a longer run."""
    return F.regexp_extract(_text(address), r"(\p{Nd}{5,6})", 1)


def address_key(core: Column) -> Column:
    return F.trim(F.regexp_replace(core, r"\s+", " "))


def prefix(core: Column, n: int) -> Column:
    return F.substring(core, 1, n)


def informative_tokens(core: Column) -> Column:
    """Distinct tokens of three characters or more that aren't generic; none for null."""
    found = F.regexp_extract_all(F.lower(_text(core)), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.array_distinct(F.filter(found, lambda t: (F.length(t) >= 3) & ~t.isin(*GENERIC)))


def leading_num(address: Column) -> Column:
    """The first digit run anywhere in the folded address."""
    return F.regexp_extract(fold(address), DIGITS, 1)


def postal_feature(address: Column) -> Column:
    """The first run of exactly five or six digits in the folded address."""
    return F.regexp_extract(fold(address), r"(?<!\p{Nd})(\p{Nd}{5,6})(?!\p{Nd})", 1)


def _place(core: Column, at: int) -> Column:
    return F.coalesce(F.try_element_at(F.filter(tokens(core), lambda t: F.length(t) > 3), F.lit(at)), F.lit(""))


def city(core: Column) -> Column:
    return _place(core, -1)


def state(core: Column) -> Column:
    return _place(core, -2)


def street_name(core: Column) -> Column:
    words = F.filter(tokens(core), lambda t: (F.length(t) > 2) & ~t.rlike(r"^\p{Nd}+$"))
    return F.coalesce(F.try_element_at(words, F.lit(1)), F.lit(""))


def acronym(core: Column) -> Column:
    toks = tokens(core)
    return F.when(F.size(toks) >= 2, F.array_join(F.transform(toks, lambda t: F.substring(t, 1, 1)), "")).otherwise(F.lit(""))


def squashed(core: Column) -> Column:
    return F.replace(core, F.lit(" "), F.lit(""))


def token_count(core: Column) -> Column:
    return F.size(tokens(core))
