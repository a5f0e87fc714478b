"""Models built from the operators: staging, dimensions, fact, KPIs, pipeline run order."""

from larder.plans import dims, fact, kpis, staging, warehouse  # noqa: F401
