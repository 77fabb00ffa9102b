"""One frozen settings object shared by batch and streaming code."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Required fields of a raw transaction, in reporting order.
REQUIRED_FIELDS = (
    "transaction_id", "account_id", "transaction_type", "amount", "timestamp", "status",
)

# Accepted transaction types.
TRANSACTION_TYPES = (
    "TRANSFER", "UPI_PAYMENT", "CARD_PAYMENT", "ATM_WITHDRAWAL", "DEPOSIT", "BILL_PAYMENT", "REFUND",
)

# Accepted statuses.
STATUSES = ("SUCCESS", "FAILED", "PENDING", "REVERSED")

# Fixed value: ISO-8601 text accepted as an event time.
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})?$"

# Risk signal -> (reason code, flag column), in reporting order.
SIGNALS = {
    "high_amount": ("HIGH_AMOUNT", "high_amount_flag"),
    "burst": ("TRANSACTION_BURST", "burst_flag"),
    "repeated_failures": ("REPEATED_FAILURES", "failure_burst_flag"),
    "location_jump": ("LOCATION_JUMP", "location_jump_flag"),
    "new_device": ("NEW_DEVICE", "new_device_flag"),
    "unusual_hour": ("UNUSUAL_HOUR", "unusual_hour_flag"),
}


def _weights() -> dict[str, int]:
    # Points per risk signal.
    return {
        "high_amount": 2,
        "burst": 2,
        "repeated_failures": 2,
        "location_jump": 2,
        "new_device": 1,
        "unusual_hour": 1,
    }


@dataclass(frozen=True)
class Config:
    # --- validation -------------------------------------------------------
    required_fields: tuple[str, ...] = REQUIRED_FIELDS
    transaction_types: tuple[str, ...] = TRANSACTION_TYPES
    statuses: tuple[str, ...] = STATUSES
    iso_timestamp: str = ISO_TIMESTAMP
    currency: str = "INR"

    # --- streaming --------------------------------------------------------
    watermark: str = "10 minutes"
    # A streamed event further in the future than this is quarantined.
    max_ahead: str = "1 day"
    pipeline_source: str = "tallylake-streaming"
    default_topic: str = "transactions"
    # Accounts silent for so long (such as "30 days", by event time) lose their last amounts; None keeps them.
    account_state_ttl: str | None = None
    # Copies of one id in a stream are first dropped per id and salt; 1 leaves that step out.
    stream_dedup_salts: int = 8

    # Windows, history and scoring limits.
    # --- windows ----------------------------------------------------------
    window_minutes: int = 5
    slide_minutes: int = 1
    trailing_rows: int = 50
    location_jump_minutes: int = 10
    new_device_lookback_days: int = 30

    # --- scoring ----------------------------------------------------------
    high_amount_multiplier: float = 3.0
    burst_limit: int = 8
    failures_limit: int = 3
    unusual_hour_start: int = 0
    unusual_hour_end: int = 5
    weights: dict[str, int] = field(default_factory=_weights)
    watch_score: int = 3
    anomaly_score: int = 5

    # --- gold -------------------------------------------------------------
    # None: all of Silver.
    lookback_hours: int | None = 26
    # Without it the KPI tables lack a load's facts until a later load takes them in.
    refresh_kpis: bool = True
    full_kpi_refresh: bool = False
    # Silver files up to this much older than the newest one read before are read again: they may have been written long
    # before they could be seen.
    arrival_overlap_hours: int = 6
    # Stored ids lie in 2**bits folders by hash.
    id_part_bits: int = 6
    # So many loads of one level are rewritten into one of the next.
    loads_per_level: int = 16

    # --- scale ------------------------------------------------------------
    # Windows of an account are computed in time blocks of this many seconds.
    block_seconds: int = 3600
    # Salts used when the copies of one id are ranked.
    salts: int = 64
    # A lookup table is broadcast only when it was counted and is not larger than this.
    broadcast_rows: int = 100_000
    broadcast_bytes: int = 32 << 20
    # Surrogate keys are ranked inside 2**bits hash buckets.
    dimension_key_bits: int = 12
    fact_key_bits: int = 16

    def with_(self, **changes) -> "Config":
        return replace(self, **changes)


DEFAULT = Config()
