"""Training-data operators (token counts, chat formatting, quality rules, secret scans,
packing, WARC, decontamination, quality classifier, SimHash near-dedup, URL filters, embedding
near-dedup, conversation structure repair, source divergence audit).

Nothing outside this subpackage imports it; ``queries.py`` registers the queries.
"""
