"""Inputs and outputs: raw schemas, seeds, test-data binding, date spine,
layer writers."""
