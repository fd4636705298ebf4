from quern.plans.registry import ORACLES, QUERIES
from quern.plans import corpus, reports, search  # noqa: F401  (they register their queries)

__all__ = ["ORACLES", "QUERIES"]
