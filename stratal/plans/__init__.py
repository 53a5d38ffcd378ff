"""Composite pipelines (the user-facing jobs)."""

from stratal.plans.family import assign_families, family_relation, family_table
from stratal.plans.jobs import FamilyParams, build_family, land, land_table, run_family
from stratal.plans.products import product_master
from stratal.plans.sales import recent_sales

__all__ = ["assign_families", "family_relation", "family_table", "FamilyParams", "build_family",
           "land", "land_table", "run_family", "product_master", "recent_sales"]
