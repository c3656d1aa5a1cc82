"""Plans: the pipeline, the query catalogue and the reports built from the operators."""

from starfold.plans.catalog import CATALOG, Gold, run_catalog
from starfold.plans.pipeline import LAYOUT, Lake, open_gold, open_table
from starfold.plans.reports import REPORTS

__all__ = ["CATALOG", "LAYOUT", "REPORTS", "Gold", "Lake", "open_gold", "open_table", "run_catalog"]
