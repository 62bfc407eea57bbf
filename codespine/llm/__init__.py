"""Training-data operators: search, formatting, output, dedup, scans, decontamination, tokenisation, scoring.

Nothing else in the library imports this subpackage. Each module holds one operator with its own general interface;
``catalog`` derives the registered ``opN_<name>`` queries from them.
"""
