"""Imports every query module so the registry is complete."""

from . import (q_channels, q_checks, q_clean, q_customers, q_features, q_io, q_metrics,  # noqa: F401
               q_models, q_prep, q_products, q_stats, q_time, q_timeseries)
from .registry import QUERIES  # noqa: F401
