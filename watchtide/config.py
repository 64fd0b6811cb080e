"""Constants and run configuration."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
GAP_SECONDS = 1800  # a gap of more than 30 minutes starts a new session
HEARTBEAT_INTERVAL_SEC = 10  # one heartbeat stands for 10 seconds watched
HIGH_DATE = "9999-12-31"  # open end of the current SCD2 version
ATTR_HASH_SEP = "||"  # separator inside the SCD2 attribute hash
GENRE_SEP = ","  # separator for genres inside the SCD2 attribute hash
TITLE_ATTRS = ["title_id", "title_name", "genres", "content_type", "release_year", "runtime_min"]
SNAPSHOT_PATH_PATTERN = r"/title/(\d{4}-\d{2}-\d{2})/"
# ---------------------------------------------------------------------------

# Lookback (days before the processing date) of each scoped rebuild.
SESSION_LOOKBACK_DAYS = 2
SESSION_FACT_LOOKBACK_DAYS = 2
EVENT_FACT_LOOKBACK_DAYS = 1

# Upper bound for a broadcast side, by the optimizer's size of its plan.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class PipelineConfig:
    """Where the tables of one deployment live, and the business knobs."""

    root: str  # shared storage root of bronze/silver/gold tables
    landing: str | None = None  # root of landing JSON folders
    gap_seconds: int = GAP_SECONDS
    interval_sec: int = HEARTBEAT_INTERVAL_SEC
    session_lookback_days: int = SESSION_LOOKBACK_DAYS
    session_fact_lookback_days: int = SESSION_FACT_LOOKBACK_DAYS
    event_fact_lookback_days: int = EVENT_FACT_LOOKBACK_DAYS

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    @property
    def ops(self) -> str:
        """Bookkeeping (schemas, checkpoints); never inside a scanned folder."""
        return f"{self.root.rstrip('/')}/_ops"
