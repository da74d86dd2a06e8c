"""Incremental dataset ingestion and its bookkeeping as Spark DataFrame plans."""

from bronzeflow.context import RunContext

__all__ = ["RunContext"]
