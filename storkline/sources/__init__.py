"""Readers and writers: raw CSV files, split Parquet sets, run and registry tables."""
