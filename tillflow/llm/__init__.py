"""Training-data operators: scoring, deduplication, decontamination, mixing,
search and extraction over whole document tables. Nothing else in the library
imports this subpackage."""
