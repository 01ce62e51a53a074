"""Operators over invoice lines, stock, the star schema and stored tables."""
