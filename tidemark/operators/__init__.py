"""Row-set operators: latest version per key, merge with change feed, silver views."""

from tidemark.operators.latest import latest_version, latest_change
from tidemark.operators.merge import MergeResult, evolve, merge

__all__ = ["latest_version", "latest_change", "MergeResult", "evolve", "merge"]
