"""Whole jobs, in running order: ingest, star schema, delivery report, CSV delivery."""

from freight.plans.arrivals import DropGone, ingest_new_drops
from freight.plans.delivery_report import last_month_report
from freight.plans.hand_over import hand_over_latest_drop
from freight.plans.ingest import UndeclaredColumns, ingest, stage
from freight.plans.publish import StarIncomplete, publish_star, published_star
from freight.plans.star_schema import materialise_salted_fact, materialise_star

__all__ = [
    "DropGone",
    "StarIncomplete",
    "UndeclaredColumns",
    "hand_over_latest_drop",
    "ingest",
    "ingest_new_drops",
    "last_month_report",
    "materialise_salted_fact",
    "materialise_star",
    "publish_star",
    "published_star",
    "stage",
]
