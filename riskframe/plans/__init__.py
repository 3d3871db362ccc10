"""Query plans: each registered query is a composition of operators over the
provided tables. Importing this package fills the registry."""

from riskframe.plans import q_profile, q_clean, q_stats, q_model, q_fit, q_io  # noqa: F401
from riskframe.plans.registry import REGISTRY, oracle_text

__all__ = ["REGISTRY", "oracle_text"]
