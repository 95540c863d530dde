"""Retail star-schema warehouse, source profiling and data-quality tests on Spark."""

from lapakdw.plans.dq import DqSpec, run_dq, verify_dq
from lapakdw.plans.load import build_warehouse, load_counts, load_idempotency
from lapakdw.plans.profile import run_profile
from lapakdw.plans.warehouse import Warehouse
from lapakdw.sources.raw import RawSales, read_raw, register_raw, slice_filter

__all__ = [
    "DqSpec",
    "RawSales",
    "Warehouse",
    "build_warehouse",
    "load_counts",
    "load_idempotency",
    "read_raw",
    "register_raw",
    "run_dq",
    "run_profile",
    "slice_filter",
    "verify_dq",
]
