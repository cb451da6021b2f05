"""The registered queries and, where SQL can say it, the same question for DuckDB."""

from workload import assessment, bi, coherence, conformity, duplicates, heterogeneity, integration, repairs, storage  # noqa: F401
from workload.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
