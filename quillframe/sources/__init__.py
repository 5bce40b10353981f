"""Readers and writers: delimited files, text corpora, submissions."""

from .corpus import attach_corpus, missing_texts, read_corpus, write_corpus
from .delimited import read_csv, read_keyed_csv, read_table, with_keys, write_csv
from .submission import build_submission

__all__ = [
    "attach_corpus",
    "build_submission",
    "missing_texts",
    "read_corpus",
    "read_csv",
    "read_keyed_csv",
    "read_table",
    "with_keys",
    "write_corpus",
    "write_csv",
]
