"""Readers: files to DataFrames under an explicit schema."""
