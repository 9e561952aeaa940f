"""Readers, contracts, staging, sinks and table profiles."""
