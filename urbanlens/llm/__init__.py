"""Operators for preparing training data. Nothing outside this subpackage (but
the entry module and the pipeline) imports it."""
