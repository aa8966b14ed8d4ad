"""Operators of a training-data pipeline (self-contained: nothing outside this
folder and the top-level entry files imports it)."""
