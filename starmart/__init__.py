"""Retail sales and marketing mart as PySpark DataFrame functions."""
