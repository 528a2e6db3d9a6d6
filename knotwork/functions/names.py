"""Comparison and normalisation of person fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def edit_distance(a: Column, b: Column, threshold: int | None = None) -> Column:
    """Levenshtein distance; with a threshold, -1 as soon as it is exceeded."""
    return F.levenshtein(a, b) if threshold is None else F.levenshtein(a, b, threshold)


def same_sound(a: Column, b: Column) -> Column:
    return F.soundex(a) == F.soundex(b)


def bare_name(name: Column) -> Column:
    """Lower case letters only, so that ``J.`` becomes ``j``."""
    return F.regexp_replace(F.lower(name), "[^a-z]", "")


def initial_match(a: Column, b: Column) -> Column:
    """Equal, or one is the other's initial."""
    x, y = bare_name(a), bare_name(b)
    by_initial = ((F.length(x) == 1) & y.startswith(x)) | ((F.length(y) == 1) & x.startswith(y))
    return (x != "") & (y != "") & ((x == y) | by_initial)


def hashed_identifier(value: Column, salt: str) -> Column:
    """Salted one-way hash of a trimmed, lower-cased identifier; null stays null."""
    return F.sha2(F.concat(F.lit(salt), F.lower(F.trim(value))), 256)
