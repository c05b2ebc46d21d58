"""Reasons written into messages and reports."""

from __future__ import annotations

# Consumers read these texts, so their wording stays as it is.

# Why a window names no source.
TOO_FEW_SOURCES = "fewer than two sources contributed"
TOO_FEW_EVENTS = "only %s events, need %s"
TIED = "tie between %s sources on %s wins"

# Why a log message is acted on or not.
UNRECOGNISED = "unrecognised message type or schema version"
NOT_A_VERDICT = "not a verdict (%s)"
NO_CONCLUSION = "verdict reached no conclusion: %s"
NO_REASON = "no reason given"
ALREADY_ACTED = "already acted on %s for %s/%s"
SLOWEST = "%s was slowest over %s events from %s sources"

# Why a node may not be removed.
NODE_NOT_FOUND = "node not found in the cluster"
LABEL_MISSING = "node has no '%s' label; only nodes labelled %s=%s may be removed"
LABEL_DIFFERS = "node is %s='%s', not '%s'"
