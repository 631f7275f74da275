"""Landed files in, snapshots and exports out."""
