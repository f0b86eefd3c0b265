"""Medallion analytics over daily snapshots of trending videos, built on Spark DataFrames."""
