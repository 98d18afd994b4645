"""Corpus operators: tokenizing, packing, scoring, classifying and de-duplicating documents."""
