"""Readers that turn files, literals and tables into labelled or tokenised DataFrames."""
