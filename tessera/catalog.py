"""All registered queries of the engine and the SQL that each must equal."""

from __future__ import annotations

from .plans import derived, domain, fuzzy, inventory, matching, relational, reports, rules, sources  # noqa: F401  all fill the registries

QUERIES = relational.Q
ORACLES = relational.S
