"""Run parameters shared by the plans.

Nothing in the library draws a random number or looks at the environment:
whatever a run depends on is a field here. Only a stream that goes on reads the
clock, once for each batch, and records it. So a replayed task or batch computes
the same rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass


class ConfigurationError(ValueError):
    """A run parameter is missing or malformed."""


def parse_site_ids(raw: str) -> list[int]:
    """Comma list to ints: blanks skipped, whitespace trimmed, duplicates kept."""
    try:
        return [int(part) for part in map(str.strip, raw.split(",")) if part]
    except ValueError as exc:
        raise ConfigurationError(f"site ids must be a comma list of integers: {raw!r}") from exc


def check_mapping_version(value: str) -> str:
    """Accept ``v<N>`` or the sentinel ``unknown``."""
    if not re.match(r"(v[0-9]+|unknown)$", value):
        raise ConfigurationError(f"mapping_version must be v<N> or unknown: {value!r}")
    return value


@dataclass(frozen=True)
class RunContext:
    """Parameters of one run.

    ``event_source``, ``dataschema`` and ``pipeline`` are the identifiers that
    downstream consumers pin; set them to the ones yours already accept.
    """

    run_ts: str
    correlation_id: str
    site_ids: tuple[int, ...] = ()
    bucket_url: str = ""
    historical_prefix: str = "pvdaq/2023-solar-data-prize"
    account_url: str = ""
    container: str = "bronze"
    tenant_id: str = "research"
    schema_version: str = "v1"
    mapping_version: str = "unknown"
    event_source: str = "/bronzeflow/pvdaq"
    dataschema: str = "urn:bronzeflow:dataset-available.v1"
    pipeline: str = "bronzeflow-v1"
    attempt: str = "1"
    retry_count: int = 0
    elapsed_seconds: float = 0.0

    def __post_init__(self) -> None:
        check_mapping_version(self.mapping_version)
        for name in ("run_ts", "correlation_id", "bucket_url", "account_url", "tenant_id"):
            if not getattr(self, name).strip():
                raise ConfigurationError(f"missing run parameter: {name}")

    @property
    def run_date(self) -> str:
        """UTC calendar date of the run."""
        return self.run_ts[:10]

    @property
    def endpoint_prefix(self) -> str:
        """Prefix written to the sidecar; fixed, independent of ``historical_prefix``."""
        return "pvdaq/2023-solar-data-prize"
