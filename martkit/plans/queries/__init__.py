"""One registered query per operator and mart."""

from martkit.plans.queries import (  # noqa: F401
    aggregates,
    changing,
    filters,
    geo,
    joins,
    loading,
    marts,
    scalars,
    sources,
    streams,
    vault,
    windows,
)
from martkit.plans.queries.registry import REGISTRY, Tables, comparable

__all__ = ["REGISTRY", "Tables", "comparable"]
