"""Ready-made questions on the star-schema tables, each with its SQL twin where SQL can say it."""

from larkspur.plans.registry import CATALOG, Tables

__all__ = ["CATALOG", "Tables", "load_all"]


def load_all():
    """Import every plan module, which fills the catalog."""
    from larkspur.plans import (  # noqa: F401
        calendar, charts, cleaning, features, files, forecasting, modelling, profiling, relational, sampling, series, statistics,
    )

    return CATALOG
