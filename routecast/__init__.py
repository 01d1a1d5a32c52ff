"""routecast: scheduled-transport analytics as Spark DataFrame jobs.

Layers (each a plain ``DataFrame -> DataFrame`` function):

* ``sources``   – raw input schemas, CSV seeds, the test-data binding,
                  the date spine and mart writers.
* ``functions`` – column-level helpers (boundary minutes, 0-based weekday,
                  NULL-strict clamps, rounding casts) and row classifiers.
* ``operators`` – staging, intermediate, marts, data quality, feedback.
* ``plans``     – the warehouse build, named queries, the semantic metric
                  API and the batch reports.
* ``streaming`` – incremental (Structured Streaming) runs of the staging
                  layer.
"""

from routecast.session import build_session, scratch_dir  # noqa: F401


def __getattr__(name: str):
    """Lazy top-level access to the main entry points (keeps ``import
    routecast`` light)."""
    lazy = {
        "build_warehouse": ("routecast.plans.warehouse", "build_warehouse"),
        "Warehouse": ("routecast.plans.warehouse", "Warehouse"),
        "semantic_query": ("routecast.plans.semantic", "semantic_query"),
        "semantic_facts": ("routecast.plans.semantic", "semantic_facts"),
        "OPERATIONS": ("routecast.plans.semantic", "OPERATIONS"),
        "PUNCTUALITY": ("routecast.plans.semantic", "PUNCTUALITY"),
        "route_report": ("routecast.plans.reports", "route_report"),
        "revenue_at_risk": ("routecast.plans.reports", "revenue_at_risk"),
        "dq_summary": ("routecast.operators.quality", "dq_summary"),
        "RawInputs": ("routecast.sources.schemas", "RawInputs"),
    }
    if name in lazy:
        import importlib

        module, attr = lazy[name]
        return getattr(importlib.import_module(module), attr)
    raise AttributeError(name)


__all__ = [
    "build_session", "scratch_dir", "build_warehouse", "Warehouse", "semantic_query", "semantic_facts",
    "OPERATIONS", "PUNCTUALITY", "route_report", "revenue_at_risk", "dq_summary", "RawInputs",
]
