"""All registered queries."""

from meterloom.plans import (  # noqa: F401
    clean_queries,
    compare_queries,
    event_queries,
    job_queries,
    load_queries,
    model_queries,
    quality_queries,
    source_queries,
)
from meterloom.plans.compare_queries import flagship  # noqa: F401
from meterloom.plans.registry import CHECKS, QUERIES  # noqa: F401
