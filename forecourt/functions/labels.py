"""Closed vocabularies and bands as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed


def look_up(code: Column, words: Mapping[str, str], default: str) -> Column:
    """Exact lookup in a small literal map; unknown and NULL give the default."""
    pairs = F.create_map(*[F.lit(part) for item in words.items() for part in item])
    return F.coalesce(F.try_element_at(pairs, code), F.lit(default))


def kind_of(code: Column) -> Column:
    return look_up(code, fixed.KIND_BY_CODE, fixed.OTHER_KIND)


def within_vocabulary(word: Column, vocabulary: Sequence[str], default: str) -> Column:
    """Lower-cased word when it belongs to the vocabulary, else the default."""
    folded = F.lower(word)
    return F.when(folded.isin(list(vocabulary)), folded).otherwise(F.lit(default))


def band(value: Column, edges: Sequence[int], labels: Sequence[str]) -> Column:
    """Label of the first edge above the value; NULL and the rest take the last label."""
    if len(labels) != len(edges) + 1 or list(edges) != sorted(edges):
        raise ValueError("need ascending edges and one more label than edges")
    *inner, last = labels
    chain = F.lit(last)
    for edge, label in reversed(list(zip(edges, inner))):
        chain = F.when(value < edge, F.lit(label)).otherwise(chain)
    return chain
