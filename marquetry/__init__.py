"""Layered media-catalogue analytics on Spark DataFrames."""
