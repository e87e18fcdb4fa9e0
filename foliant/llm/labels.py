"""Written language labels of documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LANGUAGES = ("en", "hi", "mr", "gu")
# Codes and names by which a language is labelled.
WRITTEN = {
    "en": ("en", "eng", "english"),
    "hi": ("hi", "hin", "hindi"),
    "mr": ("mr", "mar", "marathi"),
    "gu": ("gu", "guj", "gujarati"),
}


def label_language(c: Column) -> Column:
    """en, hi, mr or gu as named by a label in any notation (case, blanks, region), else null."""
    bare = F.regexp_replace(F.lower(F.regexp_replace(c, r"^\s+|\s+$", "")), "[-_](in|gb|us|latn|deva|gujr)$", "")
    out = F.lit(None).cast("string")
    for code, names in WRITTEN.items():
        out = F.when(bare.isin(*names), code).otherwise(out)
    return out
