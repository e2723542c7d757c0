"""Parametrised DataFrame operators."""
