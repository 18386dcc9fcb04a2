"""Operators for preparing training corpora (optional subpackage)."""
