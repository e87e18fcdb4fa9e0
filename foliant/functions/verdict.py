"""Evidence about a report and the verdict on it: codes, eras, years, reasons, grade. Built-in expressions only."""

from __future__ import annotations

from dataclasses import dataclass

from foliant.functions import patterns as P
from foliant.functions import text as T
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Verdict:
    """Gates of reasons and grades; scores in hundredths."""

    year_weight: int = 15
    too_short: int = 250
    too_long: int = 40_000
    orphan_share: float = 0.03
    high_supporters: int = 2
    high_score: int = 80
    medium_score: int = 60
    solo_score: int = 70
    most_long_tokens: float = 0.03
    devanagari_share: float = 0.10
    tail_lines: int = 15


VERDICT = Verdict()


def series_type(isin: Column, symbol: Column, name: Column) -> Column:
    """dvr, partly_paid, ordinary or other, by code prefix, symbol ending and name, in this order."""
    i, s, n = (F.upper(F.trim(F.coalesce(c, F.lit("")))) for c in (isin, symbol, name))
    dvr = i.startswith("IN9") | s.endswith("DVR") | s.endswith("DVREQS") | n.rlike(r"\b(DVR|DIFFERENTIAL\s+VOTING\s+RIGHTS)\b")
    partly = s.contains("-RE") | s.endswith("-PP") | n.rlike(r"\b(PARTLY\s+PAID|PART\s+PAID|RIGHTS\s+ENTITLEMENT)\b")
    return F.when(dvr, "dvr").when(partly, "partly_paid").when(i.startswith("INE"), "ordinary").otherwise("other")


def is_reprocessor(producer: Column) -> Column:
    return F.lower(F.coalesce(producer, F.lit(""))).rlike("|".join(P.REPROCESSORS))


def ratio_count(text: Column) -> Column:
    """How many of the mandated ratios a text names."""
    return sum((F.when(text.rlike("(?i)" + p), 1).otherwise(0) for p in P.RATIOS), F.lit(0)).cast("int")


def era_signs(text: Column) -> dict[str, Column]:
    """Boolean signs of the era a text was written in."""
    low = F.lower(text)
    return {"mandated_ratios": ratio_count(text) >= 4, **{k: low.rlike(p) for k, p in P.ERA_SIGNS.items()}}


def era_notes(year: Column, signs: dict[str, Column]) -> Column:
    """Codes of the rules that signs and year break; a null year breaks none."""
    rules = (
        (signs["mandated_ratios"] & (year < 2020), "ratios_early"), (~signs["mandated_ratios"] & (year >= 2020), "ratios_absent"),
        (signs["brsr"] & (year < 2023), "brsr_early"), (signs["companies_act_2013"] & (year < 2015), "act_2013_early"),
        (signs["ind_as"] & (year < 2016), "ind_as_early"),
    )
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for c, name in rules]))


def year_votes(text: Column) -> Column:
    """array<struct<year, weight, family, k>> of the years that a text mentions, in order within each family.

    Ranges of consecutive years weigh 3, years ended in March 5 and in other months 1, balances as
    at March 2, single fiscal years 2.
    """

    def found(pattern: str, *groups: int) -> list[Column]:
        return [F.regexp_extract_all(text, F.lit("(?i)" + pattern), F.lit(g)) for g in groups]

    a, b = found(P.FY_RANGE, 1, 2)
    ranges = F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x, k: F.struct(
        T.fiscal_year_end(x["a"], x["b"]).alias("year"), F.lit(3).alias("weight"), F.lit(0).alias("family"), k.alias("k")))
    m, y = found(P.YEAR_ENDED, 1, 2)
    ended = F.transform(F.arrays_zip(m.alias("m"), y.alias("y")), lambda x, k: F.struct(
        x["y"].cast("int").alias("year"), F.when(F.lower(x["m"]).startswith("mar"), 5).otherwise(1).alias("weight"), F.lit(1).alias("family"), k.alias("k")))
    m, y = found(P.AS_AT, 1, 2)
    as_at = F.transform(F.arrays_zip(m.alias("m"), y.alias("y")), lambda x, k: F.struct(
        F.when(F.lower(x["m"]).startswith("mar"), x["y"].cast("int")).alias("year"), F.lit(2).alias("weight"), F.lit(2).alias("family"), k.alias("k")))
    (s,) = found(P.FY_SINGLE, 1)
    single = F.transform(s, lambda x, k: F.struct(x.cast("int").alias("year"), F.lit(2).alias("weight"), F.lit(3).alias("family"), k.alias("k")))
    return F.filter(F.concat(ranges, ended, as_at, single), lambda x: x["year"].between(1995, 2100))


def leaks(text: Column) -> Column:
    """Different tags of passages that belong to other sections."""
    low = F.lower(text)
    return F.array_distinct(F.array_compact(F.array(*[F.when(low.rlike(p), F.lit(tag)) for p, tag in P.LEAKS])))


def tail_is_cautionary(text: Column, v: Verdict = VERDICT) -> Column:
    """The last lines that are not blank hold a cautionary statement; false for blank texts."""
    full = F.filter(F.transform(F.split(text, "\r?\n"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: x != "")
    tail = lambda own: F.array_join(F.slice(own, F.greatest(F.size(own) - (v.tail_lines - 1), F.lit(1)), F.lit(v.tail_lines)), " ")
    return T.once(full, tail).rlike(f"(?i){P.CAUTIONARY}")


def reasons(company_ok, year_ok, weight, leak, words, share, orphans, producer, cautious, split_share=None, budget=None, v: Verdict = VERDICT) -> Column:
    """Ordered codes of why a row is not certain; ``weight`` is the year vote's, ``split_share`` how often columns were cut."""
    split_share = F.lit(0.0) if split_share is None else split_share
    budget = F.lit(False) if budget is None else budget
    over = (share > v.orphan_share) & (orphans > 1)
    shredded = is_reprocessor(producer) | (over & (split_share >= 0.5))
    rules = (
        (~company_ok, "identity_unproven"), (~year_ok | (weight < v.year_weight), "year_unproven"), (leak > 0, "section_leak"),
        (words < v.too_short, "too_short"), (words > v.too_long, "too_long"), (shredded, "source_shredded"), (over & ~shredded, "order_scrambled"),
        (~cautious, "span_truncated"), (budget, "ocr_budget_exhausted"),
    )
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for c, name in rules]))


def grade(company_ok, year_ok, words, long_share, share, orphans, leak, notes, score, supporters, producer, v: Verdict = VERDICT) -> Column:
    """high, medium or low: what forces low comes first, then agreement of strategies and score."""
    scrambled = (share > v.orphan_share) & (orphans > 1)
    badly = (share > 2 * v.orphan_share) & (orphans > 1)
    low = ~company_ok | (words < v.too_short) | (long_share > v.most_long_tokens) | badly
    high = (supporters >= v.high_supporters) & year_ok & (score >= v.high_score) & (leak == 0) & (notes == 0) & ~scrambled
    medium = (supporters >= 1) & year_ok & (score >= v.medium_score) & (leak <= 1)
    solo = (supporters == 0) & year_ok & (score >= v.solo_score) & (leak == 0) & ~scrambled
    return F.when(low, "low").when(high & ~is_reprocessor(producer), "high").when(high | medium | solo, "medium").otherwise("low")
