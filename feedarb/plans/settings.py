"""Settings of the registered reports."""

from __future__ import annotations

from feedarb.params import ArbitrationParams, RemovalParams

# The derived fleet has five live machines and far fewer events than a market
# feed, hence long windows and a short lag.
OBSERVE = ArbitrationParams(
    expected_sources=5,
    window_seconds=172_800,
    minimum_events=45,
    stall_warn_seconds=43_200,
    emit_tally_every=25,
    lag=20,
)
STALL = ArbitrationParams(expected_sources=5, stall_warn_seconds=600)
REMOVAL = RemovalParams(dry_run=False, terminate_enabled=True)
TOPIC_PARTITIONS = 6
AUDIT_PARTITIONS = 3
