"""Operators for preparing language-model training data.

One module per operator: each holds the operator with its own interface, the
query ``opN_<name>`` that applies it to the given tables and, where SQL can say
it, the DuckDB twin of that query. ``QUERIES`` and ``SQL`` collect them.
"""

from larkspur.llm import bagminhash, chat, decontam, fuzzylines, langid, licenses, nbsvm, pieces, quality, structure, suffixes, trie, urls
from larkspur.llm.common import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "bagminhash", "chat", "decontam", "fuzzylines", "langid", "licenses", "nbsvm", "pieces", "quality", "structure", "suffixes", "trie", "urls"]
