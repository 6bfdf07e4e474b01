
from quarry.catalog import features, inference, models, plans, relational, sources, stats  # noqa: F401  (register on import)
from quarry.catalog.registry import REGISTRY

__all__ = ["REGISTRY"]
