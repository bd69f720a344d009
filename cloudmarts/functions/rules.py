"""Data-quality rules as named three-valued predicates.

A rule's predicate is True when the row passes, False when it fails and NULL
when it cannot be decided (e.g. a NULL cost compared with a threshold).  The
verdict of a row is derived from the list of rule outcomes, never from a bare
``filter(p)`` / ``filter(~p)`` pair, which would drop undecided rows from both
outputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

VALID = "valid"
QUARANTINE = "quarantine"
UNKNOWN = "unknown"
UNKNOWN_SUFFIX = "_unknown"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: Column


def usage_rules(min_cost: float = -0.01) -> list[Rule]:
    """Q1-Q3: id present; cost not below ``min_cost``; a value carries a unit."""
    return [
        Rule("event_id_missing", F.col("event_id").isNotNull()),
        Rule("cost_negative", F.col("cost_usd_increment") >= F.lit(min_cost)),
        Rule("unit_missing", ~(F.col("value").isNotNull() & F.col("unit").isNull())),
    ]


def error_list(rules: list[Rule]) -> Column:
    """array<string> of failed rule names; undecided rules appear as ``<name>_unknown``.

    Built by concatenating one-element (or empty) arrays, so it stays plain codegen'd
    expressions -- no lambda functions evaluated per row.
    """
    none = F.array().cast("array<string>")
    parts = [F.when(~r.predicate, F.array(F.lit(r.name)))
              .when(r.predicate.isNull(), F.array(F.lit(r.name + UNKNOWN_SUFFIX)))
              .otherwise(none)
             for r in rules]
    return F.concat(*parts)


def status(rules: list[Rule]) -> Column:
    """valid / quarantine / unknown straight from the predicates (no arrays, no
    lambdas), so the valid-row filter stays a plain codegen'd predicate."""
    all_true = rules[0].predicate.eqNullSafe(True)
    any_false = rules[0].predicate.eqNullSafe(False)
    for r in rules[1:]:
        all_true = all_true & r.predicate.eqNullSafe(True)
        any_false = any_false | r.predicate.eqNullSafe(False)
    return (F.when(all_true, F.lit(VALID)).when(any_false, F.lit(QUARANTINE))
             .otherwise(F.lit(UNKNOWN)))


def verdict(rules: list[Rule]) -> Column:
    """Three-valued AND of all predicates (the raw verdict)."""
    out = rules[0].predicate
    for r in rules[1:]:
        out = out & r.predicate
    return out
