"""Every registered query with its comparison SQL."""

from barscreen.plans.catalog import bars, features, screens, universe, flags, study, sources  # noqa: F401
from barscreen.plans.catalog.base import ORACLES, QUERIES  # noqa: F401
