"""Named driver queries. Importing this package registers all of them."""

from . import change_plans, misc_plans, order_plans, query_plans, raster_plans, web_plans  # noqa: F401
from .registry import ORACLES, QUERIES, register  # noqa: F401
