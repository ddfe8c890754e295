"""Shared plan shapes: stored intermediates, ordered totals, rank cut-offs, input bindings."""
