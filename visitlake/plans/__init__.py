"""The jobs a user runs: generate, clean, check, analyse, measure, cross-filter, reconcile."""
