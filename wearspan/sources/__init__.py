"""Readers and writers for telemetry text, window tables, requests and ledgers."""
