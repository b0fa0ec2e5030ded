"""Tidewell: periodic batch ingest, cleansing and keyed upsert on Spark DataFrames.

Every operator is a function from DataFrame to DataFrame; the caller owns the session.
"""
