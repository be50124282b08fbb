"""Triggers of the streaming jobs."""

from __future__ import annotations

AVAILABLE_NOW = "availableNow"
# Fixed value: the interval of a continuously running job.
PROCESSING_INTERVAL = "5 seconds"


def trigger_options(kind: str = AVAILABLE_NOW, interval: str = PROCESSING_INTERVAL) -> dict[str, object]:
    """Arguments for ``writeStream.trigger``: what there is now, or every interval."""
    return {"availableNow": True} if kind == AVAILABLE_NOW else {"processingTime": interval}
