"""Invoices in, stock and star schema out, on Spark."""
