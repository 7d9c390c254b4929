"""Subscriber-attrition analytics on Spark DataFrames."""
