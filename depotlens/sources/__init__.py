"""Inputs and outputs: test-table derivations, landing files, readers, store."""
