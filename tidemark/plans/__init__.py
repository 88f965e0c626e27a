"""Whole loads: landed files to fact tables."""
