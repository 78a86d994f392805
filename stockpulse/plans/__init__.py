"""Stage compositions (the reference's seven stages as one lazy plan)."""
from stockpulse.plans.pipeline import Pipeline  # noqa: F401
