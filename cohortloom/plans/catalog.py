"""All registered queries."""

from . import aggregations, genome, joining, kin, modelling, projections, scans, statistics, traits  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
