
from aeroseries.plans import q_flagship, q_clean, q_profile, q_series, q_scalars, q_features, q_models, q_score, q_registry, q_stream, q_io  # noqa: F401
from aeroseries.plans.catalog import OPERATOR_IDS, ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES", "OPERATOR_IDS"]
