"""Landed files, fact stores and reference lists."""
