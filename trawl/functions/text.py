"""Tokenizer (T1, T2, T4) as Column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: the 93 stop words, in the
# reference's order.
STOP_WORDS = (
    "a", "an", "the", "and", "or", "but", "in", "on", "at", "to", "for",
    "of", "with", "by", "from", "is", "it", "as", "be", "was", "were",
    "are", "been", "being", "have", "has", "had", "do", "does", "did",
    "will", "would", "could", "should", "may", "might", "shall", "can",
    "this", "that", "these", "those", "i", "you", "he", "she", "we", "they",
    "me", "him", "her", "us", "them", "my", "your", "his", "its", "our",
    "their", "not", "no", "so", "if", "up", "out", "about", "into",
    "than", "then", "just", "all", "also", "how", "what", "when", "where",
    "who", "which", "why", "each", "every", "both", "few", "more", "most",
    "other", "some", "such", "only", "own", "same", "too", "very",
)
MIN_TOKEN_LEN = 2
SPLIT_RE = "[^a-z0-9]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keep_token(t: Column) -> Column:
    """T2 + length rule; `isin` over >10 literals is planned as a hash set."""
    return (F.length(t) >= MIN_TOKEN_LEN) & ~t.isin(*STOP_WORDS)


def tokenize(text) -> Column:
    """Lower-case, split on non [a-z0-9], keep len>=2 non-stop-words; null -> []."""
    parts = F.split(F.lower(F.coalesce(_col(text), F.lit(""))), SPLIT_RE)
    return F.filter(parts, keep_token)


def tokenize_py(text: str | None) -> list[str]:
    """Driver-side tokenizer for the *query string* only (a few words)."""
    import re

    if not text:
        return []
    stop = set(STOP_WORDS)
    return [t for t in re.split(SPLIT_RE, text.lower())
            if len(t) >= MIN_TOKEN_LEN and t not in stop]
