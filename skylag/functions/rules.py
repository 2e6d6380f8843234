"""Ordered substring rules: the first matching rule names the result."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from skylag import fixed

Rules = tuple[tuple[str, tuple[str, ...]], ...]


def shadowed_terms(rules: Rules = fixed.STATION_RULES) -> list[tuple[str, str]]:
    """(term, earlier term) pairs where the term can never win.

    An earlier rule with another result has a term that is part of this one.
    """
    return [
        (term, early_term)
        for position, (result, terms) in enumerate(rules)
        for term in terms
        for early_result, early_terms in rules[:position]
        for early_term in early_terms
        if early_term in term and early_result != result
    ]


def specific_first(rules: Rules = fixed.STATION_RULES) -> Rules:
    """Same rules, each shadowed term moved to just before the rule that shadows it.

    Other terms of its rule stay where they are.
    """
    ordered: list[tuple[str, tuple[str, ...]]] = []
    for result, terms in rules:
        staying = []
        for term in terms:
            spots = [
                spot
                for spot, (early_result, early_terms) in enumerate(ordered)
                if early_result != result and any(early in term for early in early_terms)
            ]
            if spots:
                ordered.insert(spots[0], (result, (term,)))
            else:
                staying.append(term)
        if staying:
            ordered.append((result, tuple(staying)))
    return tuple(ordered)


def classify(key, rules: Rules = fixed.STATION_RULES, strict_order: bool = False) -> Column:
    """Result of the first rule one of whose terms is in `key`; null when none is.

    `key` should be a plain column that already holds the normalised text, or the
    clean-up is repeated once per term. `strict_order` keeps the list order as it is,
    in which a rule that an earlier, shorter term shadows never wins.
    """
    text = F.col(key) if isinstance(key, str) else key
    chain = F
    for result, terms in rules if strict_order else specific_first(rules):
        chain = chain.when(reduce(or_, [text.contains(term) for term in terms]), F.lit(result))
    return chain
