"""Training-data operators: packing, secrets, URL rules, token files, search, counts, near copies, quality, BPE.

Nothing outside this folder imports it. Every operator takes a DataFrame whose id and text columns are named by
arguments, selects those columns first (so other columns, clashing names included, cannot interfere) and returns a
DataFrame.
"""
