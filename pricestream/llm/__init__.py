"""Operators of a training-data pipeline, one module each.

Nothing outside this folder (and the pipeline script) imports it.
"""
