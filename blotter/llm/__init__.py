"""Training-data operators: dedup, decontamination, filters, tokenisation, WARC.

Nothing else in the library imports this subpackage."""
