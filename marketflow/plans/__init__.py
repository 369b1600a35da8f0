"""Batch plans over stored messages, and the queries the repository registers."""

from marketflow.plans.batch import backfill, raw_to_rows

__all__ = ["backfill", "raw_to_rows"]
