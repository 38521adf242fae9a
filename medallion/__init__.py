"""Facility-quality measures: raw to Silver to Gold, and the analyst queries on top."""

from medallion.locations import Paths
from medallion.plans.dashboard import dashboard, snapshot_dashboard
from medallion.plans.gold import gold
from medallion.plans.pipeline import publish_gold, run

__all__ = ["Paths", "dashboard", "gold", "publish_gold", "run", "snapshot_dashboard"]
