"""Batch analytics for bank data: branches, customers, card transactions, loans.

Every operator takes and returns DataFrames, so the same call runs on a laptop
sample and on a cluster-sized table.
"""
