"""Insurance claims and policies on Spark: landing, cleaning, star schema, measures and checks."""

from floodledger.plans.layers import Star
from floodledger.plans.warehouse import run

__all__ = ["Star", "run"]
