"""Staging projections P1–P7: rename raw (dotted) columns to flat staging names.

Each function is a pure projection; Catalyst inlines it into whatever reads it
(the reference materialises staging as views) and prunes unused columns down
to the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventmart.config import schemas
from eventmart.functions.columns import raw


def rename_project(df: DataFrame, mapping: list[tuple[str, str]]) -> DataFrame:
    """Select ``raw AS staged`` for every pair; a missing raw column is an error."""
    return df.select(*[raw(src).alias(dst) for src, dst in mapping])


def stg_events(raw_events: DataFrame) -> DataFrame:
    return rename_project(raw_events, schemas.STG_EVENTS)


def stg_groups(raw_groups: DataFrame) -> DataFrame:
    return rename_project(raw_groups, schemas.STG_GROUPS)


def stg_venues(raw_venues: DataFrame) -> DataFrame:
    return rename_project(raw_venues, schemas.STG_VENUES)


def stg_categories(raw_categories: DataFrame) -> DataFrame:
    return rename_project(raw_categories, schemas.STG_CATEGORIES)


def stg_topics(raw_topics: DataFrame) -> DataFrame:
    return rename_project(raw_topics, schemas.STG_TOPICS)


def stg_groups_topics(raw_groups_topics: DataFrame) -> DataFrame:
    return rename_project(raw_groups_topics, schemas.STG_GROUPS_TOPICS)


STAGING_BUILDERS = {
    "events": stg_events,
    "groups": stg_groups,
    "venues": stg_venues,
    "categories": stg_categories,
    "topics": stg_topics,
    "groups_topics": stg_groups_topics,
}


def stage_all(raw_tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Build every staging view for which a raw table is present."""
    return {name: build(raw_tables[name]) for name, build in STAGING_BUILDERS.items()
            if name in raw_tables}


def register_views(staged: dict[str, DataFrame], prefix: str = "stg_") -> list[str]:
    """K3: expose the staging projections as temporary views for SQL users."""
    names = []
    for name, df in staged.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names
