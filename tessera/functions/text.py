"""Column expressions for text: whitespace strip, tokens, noun-lemma candidates.

Everything here is a native Catalyst expression (regexp, split, arrays), so
it runs inside whole-stage code generation without a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace class used for splitting and stripping (the
# same explicit class is written in the DuckDB oracles).
WHITESPACE = r"[ \t\n\x0B\f\r]"

# English clitics split from the word before them, as a word
# tokenizer does ("don't" -> "do n't"); the clitic piece is later dropped by
# the letters-only rule or the length rule.
CLITIC_PATTERN = r"(\p{L})(n't|'s|'re|'ve|'ll|'d|'m)([^\p{L}]|$)"
CLITIC_REPLACEMENT = "$1 $2$3"

# Characters stripped from both ends of a piece: neither letter nor digit.
OUTER_PUNCT_PATTERN = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"

# Noun detachment rules (suffix, replacement), in this order,
# as published for WordNet's morphological processing of nouns.
NOUN_SUFFIX_RULES = (
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Remove leading and trailing white space (tabs and line ends too)."""
    return F.regexp_replace(_col(c), rf"^{WHITESPACE}+|{WHITESPACE}+$", "")


def split_clitics(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), CLITIC_PATTERN, CLITIC_REPLACEMENT)


def raw_pieces(text: Column | str) -> Column:
    """Lower-cased text with clitics split off, cut on runs of white space."""
    return F.split(split_clitics(F.lower(_col(text))), f"{WHITESPACE}+")


def strip_outer_punct(piece: Column | str) -> Column:
    return F.regexp_replace(_col(piece), OUTER_PUNCT_PATTERN, "")


# One pass for "strip outer non-letter/digit characters, then keep the rest
# if it is at least 3 letters": the group is the token, '' when there is none.
WORD_PATTERN = r"^[^\p{L}\p{N}]*(\p{L}{3,})[^\p{L}\p{N}]*$"


def word_of(piece: Column | str) -> Column:
    """The token in a white-space-delimited piece, or '' (see ``WORD_PATTERN``)."""
    return F.regexp_extract(_col(piece), WORD_PATTERN, 1)


def is_word(token: Column | str, min_len: int = 3) -> Column:
    """Letters only and at least ``min_len`` characters long."""
    t = _col(token)
    return t.rlike(r"^\p{L}+$") & (F.length(t) >= min_len)


def lemma_candidates(term: Column | str) -> Column:
    """``array<struct<cand string, rule int>>``: the term itself (rule 0) and
    every form one detachment rule produces (rule 1..9), in rule order."""
    t = _col(term)
    items = [F.struct(t.alias("cand"), F.lit(0).alias("rule"))]
    for i, (suffix, repl) in enumerate(NOUN_SUFFIX_RULES, start=1):
        cand = F.concat(F.substring(t, F.lit(1), F.length(t) - F.lit(len(suffix))), F.lit(repl))
        items.append(
            F.when(t.endswith(suffix), F.struct(cand.alias("cand"), F.lit(i).alias("rule")))
        )
    return F.filter(F.array(*items), lambda x: x.isNotNull())
