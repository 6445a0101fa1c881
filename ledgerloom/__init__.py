"""Part of the ledgerloom engine."""
