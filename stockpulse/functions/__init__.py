"""Reusable column expressions."""
from stockpulse.functions.columns import *  # noqa: F401,F403
