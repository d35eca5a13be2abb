"""DataFrame operators, grouped by concern."""

from urbanlens.operators import cleaning, enrich, kpi, model, profile, quality, recsys, sampling, text

__all__ = ["cleaning", "enrich", "kpi", "model", "profile", "quality", "recsys", "sampling", "text"]
