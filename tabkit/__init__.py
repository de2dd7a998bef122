"""Tabular analytics and predictive modelling on Spark DataFrames."""
