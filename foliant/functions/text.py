"""Column functions on text; built-in expressions only, so they stay inside code generation."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^ \t\n\r\f]+"
DEVANAGARI = "[ऀ-ॿ]"
INDIC = "[ऀ-ൿ]"
#: How sentences end, how list items begin.
SENTENCE_END = "[.!?][\"'”’)\\]]*\\s*$"
LIST_MARKER = r"^\s*\(?([a-z]|[ivx]{2,3}|[0-9]{1,2})[.)]\s"
#: Presentation forms and the letters they stand for.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl"}
#: Small words of headings, and words that end no paragraph.
HEADING_SMALL = "a|an|and|or|the|of|to|in|on|for|at|by|is|as|with|from|into|over"
TAIL_WORDS = "the|a|an|of|and|or|to|in|for|with|by|from|as|on|at|that|which|this"
#: Words of legal form left out of names.
NAME_STOP = "limited|ltd|private|pvt|public|company|co|corporation|corp|industries|india|the|and|incorporated|inc|plc"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often and however deep in lambdas it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def hits(text: Column, pattern: str) -> Column:
    """How often a pattern occurs; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0))


def word_count(text: Column) -> Column:
    return hits(text, WORD)


def script(text: Column) -> Column:
    """latin, mixed, devanagari, other_indic or unknown, by shares of letters of each script."""
    dev, ind, latin = hits(text, DEVANAGARI), hits(text, INDIC), hits(text, "[A-Za-z]")
    share = ind / (dev + ind + latin)
    return (
        F.when(dev + ind + latin == 0, "unknown")
        .when(share < 0.05, "latin")
        .when(share <= 0.85, "mixed")
        .when(dev >= ind * 0.8, "devanagari")
        .otherwise("other_indic")
    )


def fold_ligatures(text: Column) -> Column:
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), LIGATURES.items(), text)


def normal_name(name: Column) -> Column:
    """Lower-case name without punctuation and words of legal form."""
    bare = F.regexp_replace(F.lower(name), "[^a-z0-9& ]", " ")
    bare = F.regexp_replace(bare, rf"\b({NAME_STOP})\b", " ")
    return F.trim(F.regexp_replace(F.replace(bare, F.lit("&"), F.lit(" ")), " +", " "))


def furniture_key(line: Column) -> Column:
    """A header or footer without digits, case and runs of blanks; what repeats from page to page."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, "[0-9]+", ""), r"\s+", " ")))


def slug(text: Column, length: int = 80) -> Column:
    return F.substring(F.upper(F.regexp_replace(F.trim(text), "[^A-Za-z0-9._-]+", "_")), 1, length)


def heading_shape(line: Column) -> Column:
    """A short line without closing punctuation in capitals or title case."""
    s = F.trim(line)
    letters, upper = hits(s, "[A-Za-z]"), hits(s, "[A-Z]")
    lower_words = hits(s, r"(?:^|[^A-Za-z'])[a-z]")
    small = hits(s, rf"(?:^|[^A-Za-z'])(?:{HEADING_SMALL})(?:[^A-Za-z']|$)")
    return (
        (F.length(s) > 0) & (F.length(s) <= 60) & ~s.rlike("[.!?:;,]$") & (word_count(s) <= 8) & (letters > 0)
        & ((upper >= letters * 0.7) | ((lower_words <= small) & s.rlike("^[A-Z]")))
    )


def luhn_valid(code: Column) -> Column:
    """The mod-10 check of a code whose letters count 10 to 35; null for null, false for other signs."""
    up = F.upper(F.trim(code))
    digits = F.array_join(F.transform(F.split(up, ""), lambda c: F.when(
        c.rlike("[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c)), "")
    back = F.split(F.reverse(digits), "")

    def step(acc: Column, c: Column) -> Column:
        twice = c.cast("int") * (F.lit(1) + acc["i"] % 2)
        return F.struct((acc["i"] + 1).alias("i"), (acc["s"] + F.when(twice > 9, twice - 9).otherwise(twice)).alias("s"))

    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("s"))
    total = F.aggregate(F.filter(back, lambda c: c != ""), start, step)["s"]
    return F.when(up.isNull(), None).when(~up.rlike("^[A-Z]{2}[A-Z0-9]{9}[0-9]$"), False).otherwise(total % 10 == 0)


def fiscal_year_end(first: Column, second: Column) -> Column:
    """Year end of a range such as 2014-15 or 2014-2015; null unless the years follow each other."""
    y1, y2 = first.cast("int"), second.cast("int")
    full = F.when(F.length(second) == 2, F.floor(y1 / 100).cast("int") * 100 + y2).otherwise(y2)
    full = F.when(full < y1, full + 100).otherwise(full)
    return F.when(full - y1 == 1, full)


#: A query parameter whose name tells a secret.
SECRET = r"(?i)([?&](?:[^=&#]*(?:token|auth|key|secret|sig|pass|cred|bearer|session)[^=&#]*|pwd)=)[^&#]*"


def redact_url(url: Column) -> Column:
    """A URL whose secret query values are hidden; scheme, host, path and other parameters stay."""
    return F.regexp_replace(url, SECRET, "$1%5BREDACTED%5D")


def iou(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Inclusive pages shared over pages in either span; 0 for disjoint spans, null for a null end."""
    shared = F.greatest(F.least(e1, e2) - F.greatest(s1, s2) + 1, F.lit(0))
    return F.when(s1.isNotNull() & e1.isNotNull() & s2.isNotNull() & e2.isNotNull(),
                  shared / ((e1 - s1 + 1) + (e2 - s2 + 1) - shared))


def hull_iou(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """As ``iou``, over the pages from the first start to the last end."""
    shared = F.greatest(F.least(e1, e2) - F.greatest(s1, s2) + 1, F.lit(0))
    return F.when(s1.isNotNull() & e1.isNotNull() & s2.isNotNull() & e2.isNotNull(),
                  shared / (F.greatest(e1, e2) - F.least(s1, s2) + 1))


def era3(year: Column) -> Column:
    """Three report eras; null is the latest."""
    return F.when(year < 2014, "2010-2013").when(year < 2019, "2014-2018").otherwise("2019-2025")


def era6(year: Column) -> Column:
    """Six regulatory eras."""
    return (
        F.when(year < 2013, "pre-2013").when(year < 2015, "2013-2014").when(year < 2016, "2015")
        .when(year < 2020, "2016-2019").when(year < 2023, "2020-2022").otherwise("2023+")
    )


def hash_rank(seed: str, *parts: Column) -> Column:
    """SHA-256 of seed and parts separated by NUL; the order of reproducible draws."""
    return F.sha2(F.concat_ws("\u0000", F.lit(seed), *[p.cast("string") for p in parts]), 256)
