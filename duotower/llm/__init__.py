"""Operators of a training-data pipeline: token counts, quality rules, license scans, URL filters, near-duplicate
joins, token-id files, benchmark decontamination, packing, HTML extraction and secret scans."""
