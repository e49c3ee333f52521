"""Query plans over the given tables."""

from importlib import import_module

MODULES = (
    "q_sources", "q_clean", "q_nutrition", "q_response", "q_context", "q_profiles", "q_metrics", "q_scoring",
    "q_models", "q_ridge", "q_federated",
)


def load() -> None:
    """Import every plan module, so that its queries are registered."""
    for name in MODULES:
        import_module(f"sensorloom.plans.{name}")
