"""Words of running text, for keyword counts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Clitics stand as tokens of their own, so "it's" counts as "it".
CLITIC = r"(?i)(n't|'(?:s|m|d|ll|re|ve))([^\p{L}]|$)"
# Blanks and the punctuation that always parts tokens. The marks listed here
# keep a token whole, and such a token is not alphabetic.
PARTING = r"[^\p{L}\p{M}\p{N}'._/\\*+=^~|`-]+"
ALPHABETIC = r"^\p{L}+$"


def raw_tokens(text: Column) -> Column:
    """Tokens of a text as an array, with quotes and full stops still on."""
    split_clitics = F.when(text.contains("'"), F.regexp_replace(text, CLITIC, " $1$2")).otherwise(text)
    return F.split(split_clitics, PARTING, -1)


def alphabetic_word(token: Column) -> Column:
    """Lower-case word of a token, NULL if it is not alphabetic."""
    bare = F.rtrim(F.ltrim(token, F.lit("'")), F.lit("'."))
    return F.when(bare.rlike(ALPHABETIC), F.lower(bare))
