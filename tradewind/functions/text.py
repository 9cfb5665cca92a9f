"""Fuzzy and full-text matching as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NON_WORD = r"[^\p{L}\p{N}]+"


def words(col: Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.filter(F.split(F.lower(col), _NON_WORD), lambda w: w != "")


def trigrams(col: Column) -> Column:
    """Distinct three-letter windows of every word, padded with two blanks before and one after."""
    per_word = F.transform(
        words(col),
        lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.concat(F.lit("  "), w, F.lit(" ")).substr(i, F.lit(3))),
    )
    return F.array_distinct(F.flatten(per_word))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over joint elements of two sets; 0 when both are empty."""
    shared = F.size(F.array_intersect(a, b))
    joint = F.size(a) + F.size(b) - shared
    return F.when(joint == 0, F.lit(0.0)).otherwise(shared / joint)


def similarity(a: Column, b: Column) -> Column:
    """Trigram similarity of two texts, between 0 and 1."""
    return jaccard(trigrams(a), trigrams(b))


def search_terms(query: str) -> list[str]:
    """Distinct words of a query, lower case."""
    import re

    found = re.findall(r"[^\W_]+", query.lower())
    return list(dict.fromkeys(found))


def matches_any(fields: list[Column], terms: list[str]) -> Column:
    """At least one term is a word of at least one field. No stemming, no stop words."""
    wanted = F.array(*map(F.lit, terms))
    hit = F.lit(False)
    for field in fields:
        hit = hit | F.coalesce(F.arrays_overlap(words(field), wanted), F.lit(False))
    return hit


def text_score(fields: list[Column], terms: list[str]) -> Column:
    """Relevance: for every field and term, the share of the field's words that are the term."""
    total = F.lit(0.0)
    for field in fields:
        tokens = words(F.coalesce(field, F.lit("")))
        wanted = F.array(*map(F.lit, terms))
        hits = F.size(F.filter(tokens, lambda w: F.array_contains(wanted, w)))
        total = total + F.when(F.size(tokens) > 0, hits / F.size(tokens)).otherwise(F.lit(0.0))
    return total
