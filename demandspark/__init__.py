"""Retail-demand jobs and training-data operators as PySpark DataFrame programs."""
