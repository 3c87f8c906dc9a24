"""Operators that prepare text corpora for training language models; each works on tables of any size."""
