"""Plan-level building blocks shared by the operators (ranking, top-k)."""

from fieldatlas.plans.ranking import global_rank, top_k

__all__ = ["global_rank", "top_k"]
