"""Training-data operators: text filters, near-duplicates, decontamination, mixing, scoring, web archives.

Every module holds one operator with a general interface; ``queries.py`` registers the
thin ``opN_<name>`` queries over the driver tables.
"""
