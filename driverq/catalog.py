"""Imports every catalog module so their queries register."""

from driverq import catalog_fn  # noqa: F401
from driverq import catalog_io  # noqa: F401
from driverq import catalog_ops  # noqa: F401
from driverq import catalog_rel  # noqa: F401
