"""The registered queries over the given tables."""

from tierwell.catalogue import checks, issues, layers, reports, rules, scalars, scans, streams  # noqa: F401
from tierwell.catalogue.registry import ENTRIES

__all__ = ["ENTRIES"]
