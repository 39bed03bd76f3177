"""Inputs: raw text files, documents handed over as records, and question tables."""
