"""DataFrame operators of the arbitration pipeline."""
