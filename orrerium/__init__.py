"""Orrerium: dataset-impact analytics and training-data preparation, as Spark plans."""
