"""Service analytics on Spark: clean tier, star schema, views and slices."""

from clinicmart.plans.gold import Star
from clinicmart.plans.slices import Selection
from clinicmart.session import build_session
from clinicmart.sources.store import TierStore

__all__ = ["Selection", "Star", "TierStore", "build_session"]
