"""The five report views under their SQL names."""

from __future__ import annotations

from pyspark.sql import DataFrame

from leafmill.plans.coverage import auction_coverage, data_overview
from leafmill.plans.health import health_daily, health_overall
from leafmill.plans.items import item_facts
from leafmill.sites.base import SitePack


def register_views(raw: DataFrame, parsed: DataFrame, pack: SitePack) -> list[str]:
    """Replace the site's temporary views, worked out on read; returns their names."""
    views = {
        "items": item_facts(parsed, pack),
        "data_overview": data_overview(parsed, pack),
        "auction_coverage": auction_coverage(raw, parsed, pack),
        "crawl_health_daily": health_daily(raw, pack),
        "crawl_health_overall": health_overall(raw, pack),
    }
    for name, rows in views.items():
        rows.createOrReplaceTempView(f"{pack.name}_{name}")
    return [f"{pack.name}_{name}" for name in views]
