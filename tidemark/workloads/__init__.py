"""Scenarios over the given test tables: registered queries and their SQL oracles."""
