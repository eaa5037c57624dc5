"""Relational and ML operators over DataFrames."""
