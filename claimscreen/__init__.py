"""claimscreen: claim screening and training-corpus operators on Spark DataFrames."""

from claimscreen.config import ScreenConfig
from claimscreen.plans.screening import ClaimScreen

__all__ = ["ClaimScreen", "ScreenConfig"]
