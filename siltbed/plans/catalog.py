"""Imports every catalog module so that all queries are registered."""

from siltbed.plans import catalog_decode  # noqa: F401
from siltbed.plans import catalog_plan  # noqa: F401
from siltbed.plans import catalog_land  # noqa: F401
