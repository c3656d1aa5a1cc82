"""Operators: functions from DataFrames to DataFrames."""

from starfold.operators.claims import claims_by_severity, claims_profile, generate_claims
from starfold.operators.clean import CleanSpec, clean, reject_counts, row_id
from starfold.operators.copies import copy_limits, number_copies
from starfold.operators.dims import (
    build_code_dim,
    build_factor_dim,
    build_location_dim,
    build_time_dim,
    build_vehicle_dim,
)
from starfold.operators.fact import build_fact, natural_hot_keys, surrogate_hot_keys
from starfold.operators.keys import dense_key
from starfold.operators.lookup import lookup
from starfold.operators.present import present
from starfold.operators.quality import (
    check_key,
    check_reference,
    check_row_counts,
    check_rules,
    exit_code,
    orphan_keys,
    run_checks,
    summarize,
)
from starfold.operators.rollup import Measure, claim_rollup, rollup, star_rollup, with_share
from starfold.operators.sample import hash_sample, histogram, smallest
from starfold.operators.skew import LIMITS, Limits, hot_hashes, may_broadcast

__all__ = [
    "LIMITS",
    "CleanSpec",
    "Limits",
    "Measure",
    "build_code_dim",
    "build_fact",
    "build_factor_dim",
    "build_location_dim",
    "build_time_dim",
    "build_vehicle_dim",
    "check_key",
    "check_reference",
    "check_row_counts",
    "check_rules",
    "claim_rollup",
    "claims_by_severity",
    "claims_profile",
    "clean",
    "copy_limits",
    "dense_key",
    "exit_code",
    "generate_claims",
    "hash_sample",
    "histogram",
    "hot_hashes",
    "lookup",
    "may_broadcast",
    "natural_hot_keys",
    "number_copies",
    "orphan_keys",
    "present",
    "reject_counts",
    "rollup",
    "row_id",
    "run_checks",
    "smallest",
    "star_rollup",
    "summarize",
    "surrogate_hot_keys",
    "with_share",
]
