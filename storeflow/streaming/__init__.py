"""Micro-batch writers and the streaming jobs that run them."""
