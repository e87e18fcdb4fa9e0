"""Where a section of a report begins and ends: competing strategies over page rows, and their arbiter.

Everything that needs the text of a page is worked out in the page's own row by ``page_features``;
what is joined, aggregated or ordered afterwards are short facts about pages, never texts. All
thresholds come in a ``Location`` and scores are whole hundredths, so sums do not depend on order.
"""

from __future__ import annotations

from dataclasses import dataclass

from foliant.functions import patterns as P
from foliant.functions import text as T
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Location:
    """Scores in hundredths, and limits in pages, lines and words."""

    max_pages: int = 60
    min_words: int = 250
    prose_words: int = 120
    outline: int = 95
    outline_walked: int = 90
    walk: int = 8
    contents: int = 80
    heading_lines: int = 5
    skip_pages: int = 2
    heading_most: int = 78
    page_penalty: int = 12
    body_peak: int = 35
    body_most: int = 72
    supporter: int = 6
    near: int = 2
    best: int = 99
    extra: int = 12


LOCATION = Location()
_BLANKS = r"^\s+|\s+$"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, _BLANKS, "")


def is_caps(s: Column) -> Column:
    return s.rlike(r"\p{Lu}") & ~s.rlike(r"\p{Ll}")


def is_title_or_caps(s: Column) -> Column:
    """All capitals, or every word but small ones begins with a capital."""
    words = F.regexp_extract_all(s, F.lit("[A-Za-z]+"), F.lit(0))
    low = F.exists(words, lambda w: w.rlike("^[a-z]") & ~F.lower(w).isin(*P.TITLE_SMALL))
    return is_caps(s) | (s.rlike("[A-Z]") & ~s.rlike("^[^A-Za-z]*[a-z]") & ~low)


def is_section_title(s: Column) -> Column:
    return s.rlike(f"(?i)(?:{P.HEADING})|(?:{P.COMBINED})") | ((F.length(s) <= 24) & s.rlike(f"(?i){P.ACRONYM}"))


def is_pointer(s: Column) -> Column:
    """The text only refers to a section elsewhere; what is given "below" is no pointer."""
    return s.rlike(f"(?i){P.POINTER}") | F.regexp_replace(s, f"(?i){P.POINTER_BELOW}", " ").rlike(f"(?i){P.POINTER_GIVEN}")


def _few_capitals(part: Column) -> Column:
    """At most three words, all capitalised but small ones."""
    words = F.regexp_extract_all(part, F.lit("[A-Za-z]+"), F.lit(0))
    return (F.size(words) <= 3) & ~F.exists(words, lambda w: w.rlike("^[a-z]") & ~F.lower(w).isin(*P.TITLE_SMALL))


def is_terminator_shape(s: Column) -> Column:
    """A short whole line, in title case or capitals, that names a section which ends the one sought."""
    split = rf"(?i)^(.*?)(?:{P.TERMINATOR})(.*)$"
    named = s.rlike(f"(?i){P.TERMINATOR}")
    around = _few_capitals(F.regexp_extract(s, split, 1)) & _few_capitals(F.regexp_extract(s, split, 2))
    ended = s.rlike("[,;]$") | (s.rlike(r"\.$") & ~s.rlike(r"(?i)\b(?:Co|Ltd|Inc|Corp|No)\.$"))
    return (F.length(s) > 0) & (F.length(s) <= 80) & named & ~ended & around & is_title_or_caps(s)


def terminators(lines: Column) -> Column:
    """array<struct<line_index, text, font_signal, permille, norm>> of the lines of a page that may end the section.

    A line counts in the upper half of the page or under a blank line, and must then stand in the
    top third or under a blank line.
    """

    def look(own: Column, s: Column, i: Column) -> Column:
        n = F.size(own)
        under = (i > 0) & (F.get(own, i - 1) == "")
        upper = (i <= F.greatest(F.lit(8), F.floor(n / 2))) & (i < F.greatest(F.lit(4), F.floor(n / 3)))
        return F.when(
            (under | upper) & is_terminator_shape(s),
            F.struct(
                i.alias("line_index"), s.alias("text"), F.when(is_caps(s), "all_caps").otherwise("title_case").alias("font_signal"),
                F.floor(i * 1000 / F.greatest(n, F.lit(1))).cast("int").alias("permille"), T.furniture_key(s).alias("norm"),
            ),
        )

    return T.once(F.transform(lines, strip), lambda own: F.array_compact(F.transform(own, lambda s, i: look(own, s, i))))


def full_lines(lines: Column) -> Column:
    """Stripped lines that are not blank."""
    return F.filter(F.transform(lines, strip), lambda s: s != "")


def start_headers(full: Column) -> Column:
    """The first four lines as furniture keys: a running head of the start page ends no section."""
    return F.filter(F.transform(F.slice(full, 1, 4), T.furniture_key), lambda s: s != "")


def text_heading(full: Column, pointer: Column, at: Location = LOCATION) -> Column:
    """struct<score, neg_line, text> of the best title among the first lines of a page, else null.

    A title may stand on two lines. Higher, shorter and capital titles score more; pages that name
    three ending sections or more are contents pages and score less.
    """
    listing = F.size(F.filter(full, lambda s: s.rlike(f"(?i){P.TERMINATOR}"))) >= 3

    def look(s: Column, after: Column, i: Column) -> Column:
        two = F.concat_ws(" ", s, after)
        title = F.when((F.length(s) <= 110) & is_section_title(s), s).when(
            after.isNotNull() & ~is_section_title(after) & (F.length(two) <= 110) & is_section_title(two), two
        )

        def scored(t: Column) -> Column:
            score = (
                F.lit(40) + F.floor(10 * (at.heading_lines - i) / at.heading_lines).cast("int") + F.when(F.length(t) <= 60, 10).otherwise(0)
                + F.when(is_caps(t), 5).otherwise(0)
            )
            return F.when(t.isNotNull(), F.struct(score.cast("int").alias("score"), (-i).alias("neg_line"), t.alias("text")))

        return T.once(title, scored)

    best = T.once(F.slice(full, 1, at.heading_lines), lambda top: F.array_max(F.array_compact(F.transform(top, lambda s, i: look(s, F.get(top, i + 1), i)))))
    # A contents page lowers all its titles alike.
    low = lambda b: F.struct((b["score"] - F.when(listing, 30).otherwise(0)).alias("score"), b["neg_line"].alias("neg_line"), b["text"].alias("text"))
    # Whole pages are searched for pointers only where there is a title.
    return T.once(best, lambda b: F.when(b.isNotNull() & ~pointer, low(b)))


def body_score(text: Column) -> Column:
    """Evidence of the section's body on a page, in hundredths, at most 160."""
    hits = sum((F.when(text.rlike("(?i)" + p), 1).otherwise(0) for p in P.BODY_CUES), F.lit(0))
    extra = F.when(text.rlike(f"(?i){P.HEADING}"), 35).otherwise(0) + F.when(text.rlike(r"(?i)cautionary\s+statement"), 15).otherwise(0)
    return F.when(text.rlike(r"\S"), F.least(F.lit(160), F.least(F.lit(100), hits * 25) + extra)).otherwise(0).cast("int")


def page_features(pages: DataFrame, keys: list[str], text_col: str = "text", at: Location = LOCATION) -> DataFrame:
    """(keys, lines, terms, headers, heading, score, words, dense, cue, folios, entries, contents) of each page text.

    Null texts count as empty. ``entries`` are the title and printed page of lines of a contents
    page, ``folios`` the page numbers printed in its margin.
    """
    t = F.coalesce(F.col(text_col), F.lit(""))
    base = pages.select(*keys, t.alias("__t"), F.split(t, "\n").alias("__lines"))
    full = base.withColumn("__full", full_lines(F.col("__lines")))
    letters, size = T.hits(F.col("__t"), r"\p{L}"), F.length("__t")
    entry = F.transform(
        F.filter("__full", lambda s: s.rlike(P.CONTENTS_LINE) & is_title_or_caps(strip(F.regexp_extract(s, P.CONTENTS_LINE, 1)))),
        lambda s: F.struct(
            strip(F.regexp_extract(s, P.CONTENTS_LINE, 1)).alias("title"), F.regexp_extract(s, P.CONTENTS_LINE, 2).cast("int").alias("folio")
        ),
    )
    margin = F.concat(F.slice("__full", 1, 2), F.slice("__full", F.greatest(F.size("__full") - 2, F.lit(1)), F.lit(3)))
    folio = F.transform(F.filter(margin, lambda s: s.rlike(P.FOLIO_LINE)), lambda s: F.regexp_extract(s, P.FOLIO_LINE, 1).cast("int"))
    return full.select(
        *keys,
        F.size("__lines").alias("lines"),
        terminators(F.col("__lines")).alias("terms"),
        start_headers(F.col("__full")).alias("headers"),
        text_heading(F.col("__full"), is_pointer(F.col("__t")), at).alias("heading"),
        body_score(F.col("__t")).alias("score"),
        T.word_count(F.col("__t")).alias("words"),
        (letters * 100).between(size * 60, size * 92).alias("dense"),
        F.col("__t").rlike("(?i)" + "|".join(f"(?:{p})" for p in P.BODY_CUES)).alias("cue"),
        F.array_distinct(folio).alias("folios"),
        entry.alias("entries"),
        F.col("__t").rlike(r"(?i)\bcontents\b").alias("contents"),
    )


def first_end(starts: DataFrame, pages: DataFrame, doc: str = "document_id", at: Location = LOCATION) -> DataFrame:
    """``starts`` (doc, start_page) with ``end_page`` and ``terminator``: a forward as-of join on ending lines.

    Looked at are the ``max_pages`` pages there are after the start. A line at the top of a page ends
    the section on the page before; one further down on a page that still holds the body ends it
    there. Running heads of the start page end nothing. Without an ending line the last page ends it.
    """
    order = Window.partitionBy(doc).orderBy("page_no")
    ranked = pages.select(doc, "page_no", "terms", "score", F.row_number().over(order).alias("__rank"))
    at_start = pages.select(doc, F.col("page_no").alias("start_page"), "headers")
    rank = ranked.select(doc, F.col("page_no").alias("start_page"), F.col("__rank").alias("__from"))
    own = starts.select(doc, "start_page").join(at_start, [doc, "start_page"]).join(rank, [doc, "start_page"])
    later = own.join(ranked, doc).filter((F.col("__rank") > F.col("__from")) & (F.col("__rank") <= F.col("__from") + at.max_pages))
    held = F.filter("terms", lambda x: ~(((x["line_index"] <= 3) | (x["permille"] < 80)) & F.array_contains(F.col("headers"), x["norm"])))
    term = F.get(held, F.lit(0))
    inside = ((term["line_index"] >= 5) | (term["permille"] >= 350)) & (F.col("score") >= 25)
    end = F.greatest(F.col("start_page"), F.when(inside, F.col("page_no")).otherwise(F.col("page_no") - 1))
    found = later.withColumn("__e", F.when(term.isNotNull(), F.struct("page_no", end.alias("end_page"), term["text"].alias("terminator"))))
    best = found.groupBy(doc, "start_page").agg(F.min("__e").alias("__b"), F.max("page_no").alias("__last"))
    return starts.join(best, [doc, "start_page"], "left").select(
        *starts.columns, F.coalesce("__b.end_page", "__last", "start_page").cast("int").alias("end_page"), F.col("__b.terminator").alias("terminator")
    )


def locate_text_heading(pages: DataFrame, doc: str = "document_id", at: Location = LOCATION) -> DataFrame:
    """(doc, start_page, score, heading, end_page, terminator): the best title at the top of a page."""
    use = pages.filter((F.col("page_no") >= at.skip_pages) & F.col("heading").isNotNull())
    best = use.groupBy(doc).agg(F.max_by(F.struct("page_no", "heading"), F.struct("heading.score", -F.col("page_no"))).alias("b"))
    starts = best.select(
        doc, F.col("b.page_no").alias("start_page"), F.least(F.lit(at.heading_most), "b.heading.score").alias("score"), F.col("b.heading.text").alias("heading")
    )
    return first_end(starts, pages, doc, at)


def typographic_headings(lines: DataFrame, doc: str = "document_id", least: float = 1.12) -> DataFrame:
    """(doc, page_no, y, text, rel, bold) of lines (doc, page_no, y, text, size, bold) that look like headings.

    A line is one if it is clearly larger than the page's median, bold and short, or in capitals; ``y``
    is the place on the page from 0 to 1. Blank lines and lines without size are none.
    """
    own = lines.select(doc, "page_no", "y", strip(F.col("text")).alias("text"), "size", F.coalesce("bold", F.lit(False)).alias("bold")).filter("text <> '' and size > 0")
    body = own.groupBy(doc, "page_no").agg(F.percentile("size", 0.5).alias("__body"))
    out = own.join(body, [doc, "page_no"]).withColumn("rel", F.col("size") / F.col("__body"))
    look = (F.col("rel") >= least) | (F.col("bold") & (F.length("text") <= 90)) | is_caps(F.col("text"))
    return out.filter(look).select(doc, "page_no", "y", "text", "rel", "bold")


def locate_typographic(lines: DataFrame, pages: DataFrame, doc: str = "document_id", at: Location = LOCATION) -> DataFrame:
    """(doc, start_page, score, heading, end_page, terminator): the best title among lines that look like headings.

    A bold or large line and the next heading under it may make one title. Pages whose text only
    points to the section, and pages that name three ending sections, hold no start.
    """
    w = Window.partitionBy(doc, "page_no").orderBy("y", "text")
    heads = typographic_headings(lines, doc).withColumn("__t", F.lead("text").over(w)).withColumn("__y", F.lead("y").over(w)).withColumn("__r", F.lead("rel").over(w)).withColumn("__b", F.lead("bold").over(w))
    two = F.concat_ws(" ", "text", "__t")
    joined = ~is_section_title(F.col("text")) & F.col("__t").isNotNull() & ~is_section_title(F.col("__t")) & (F.col("bold") | (F.col("rel") >= 1.2)) & (F.col("__y") - F.col("y")).between(0, 0.1) & is_section_title(two)
    title = F.when(is_section_title(F.col("text")), F.col("text")).when(joined, two)
    rel, bold = F.when(joined, F.greatest("rel", "__r")).otherwise(F.col("rel")), F.when(joined, F.col("bold") | F.col("__b")).otherwise(F.col("bold"))
    own = heads.select(doc, "page_no", "y", title.alias("heading"), rel.alias("rel"), bold.alias("bold")).filter("heading is not null and page_no >= 1")
    use = own.join(pages.filter(F.size("terms") < 3).select(doc, "page_no", "words"), [doc, "page_no"]).filter(~is_pointer(F.col("heading")))
    score = (
        F.lit(45) + F.floor(25 * F.least(F.lit(1.0), (F.col("rel") - 1) / 0.6)) + F.when(F.col("y") < 0.35, 18).otherwise(0)
        + F.when(F.length("heading") <= 110, 12).otherwise(0) + F.when(F.col("bold"), 5).otherwise(0) + F.when(F.col("words") < 60, 5).otherwise(0)
    )
    best = use.withColumn("score", F.least(F.lit(92), score).cast("int")).groupBy(doc).agg(
        F.max_by(F.struct("page_no", "heading", "score"), F.struct("score", -F.col("page_no"), -F.col("y"))).alias("b"))
    return first_end(best.select(doc, F.col("b.page_no").alias("start_page"), "b.score", "b.heading"), pages, doc, at)


def prose_pages(pages: DataFrame, doc: str = "document_id", at: Location = LOCATION) -> DataFrame:
    """(doc, page_no) of pages of prose: enough words, mostly letters, a cue on it or the next page."""
    nxt = pages.filter("cue").select(doc, (F.col("page_no") - 1).alias("page_no"), F.lit(True).alias("__next"))
    both = pages.select(doc, "page_no", "words", "dense", "cue").join(nxt, [doc, "page_no"], "left")
    return both.filter((F.col("words") >= at.prose_words) & F.col("dense") & (F.col("cue") | F.coalesce("__next", F.lit(False)))).select(doc, "page_no")


def locate_outline(entries: DataFrame, pages: DataFrame, sizes: DataFrame, doc: str = "document_id", at: Location = LOCATION) -> DataFrame:
    """(doc, start_page, end_page, score, walked, outcome) by outline entries (doc, title, page_no) and page counts (doc, n_pages).

    The first entry that is a title starts the section, the next entry on a later page ends it. A
    start without prose walks on to the first page of prose, at most ``walk`` pages.
    """
    starts = entries.filter(is_section_title(F.col("title"))).groupBy(doc).agg(F.min("page_no").alias("proposed"))
    after = entries.join(starts, doc).filter(F.col("page_no") > F.col("proposed")).groupBy(doc).agg((F.min("page_no") - 1).alias("__end"))
    span = starts.join(after, doc, "left").join(sizes, doc, "left")
    last = F.least(F.coalesce("__end", F.col("n_pages") - 1, "proposed"), F.col("proposed") + at.max_pages - 1)
    span = span.withColumn("end_page", last)
    reach = F.least(F.col("proposed") + at.walk, F.col("end_page"))
    near = span.join(prose_pages(pages, doc, at), doc).filter(F.col("page_no").between(F.col("proposed"), reach))
    hit = near.groupBy(doc).agg(F.min("page_no").alias("start_page"))
    out = span.join(hit, doc, "left")
    walked = F.col("start_page") - F.col("proposed")
    return out.select(
        doc, "proposed", "start_page", F.greatest("end_page", "start_page").cast("int").alias("end_page"),
        F.when(walked == 0, at.outline).when(walked > 0, at.outline_walked).alias("score"), walked.alias("walked"),
        F.when(walked == 0, "accepted").when(walked > 0, "accepted_with_walk").otherwise("invalidated").alias("outcome"),
    )


def contents_offset(pages: DataFrame, contents: DataFrame, doc: str = "document_id") -> DataFrame:
    """(doc, offset, samples, agreement): physical less printed page, the most frequent difference of the margins.

    With fewer than three samples, or fewer than three that agree, the contents page's own number is taken.
    """
    each = pages.join(contents.select(doc, "toc_page"), doc).select(doc, "toc_page", "page_no", F.explode("folios").alias("folio")).filter("folio > 0")
    n = each.groupBy(doc, (F.col("page_no") - F.col("folio")).alias("diff")).agg(F.count_distinct("page_no").alias("n"))
    best = n.groupBy(doc).agg(F.max_by(F.struct("diff", "n"), F.struct("n", -F.col("diff"))).alias("b"))
    used = each.groupBy(doc).agg(F.count_distinct("page_no").alias("samples"))
    out = contents.select(doc, "toc_page").join(best, doc, "left").join(used, doc, "left")
    good = (F.coalesce("samples", F.lit(0)) >= 3) & (F.col("b.n") >= 3)
    return out.select(
        doc, F.when(good, F.col("b.diff")).otherwise(F.col("toc_page")).cast("int").alias("offset"), F.coalesce("samples", F.lit(0)).alias("samples"),
        F.when(good, F.floor(F.col("b.n") * 100 / F.col("samples"))).otherwise(0).cast("int").alias("agreement"),
    )


def contents_pages(pages: DataFrame, doc: str = "document_id", first: int = 20) -> DataFrame:
    """(doc, page_no, entries) of contents pages among the first: four entries, or two and the word."""
    n = F.size("entries")
    return pages.filter((F.col("page_no") < first) & ((n >= 4) | (F.col("contents") & (n >= 2)))).select(doc, "page_no", "entries")


def locate_contents(pages: DataFrame, sizes: DataFrame, doc: str = "document_id", at: Location = LOCATION) -> DataFrame:
    """(doc, start_page, end_page, score, heading, offset): the section's entry on a contents page and the next one's."""
    toc = contents_pages(pages, doc)
    entries = toc.select(doc, F.explode("entries").alias("e")).select(doc, "e.title", "e.folio")
    offset = contents_offset(pages, toc.groupBy(doc).agg(F.min("page_no").alias("toc_page")), doc)
    title = entries.filter(is_section_title(F.col("title"))).groupBy(doc).agg(F.min(F.struct("folio", "title")).alias("s"))
    after = entries.join(title, doc).filter("folio > s.folio").groupBy(doc).agg(F.min("folio").alias("next"))
    own = title.join(after, doc, "left").join(offset, doc).join(sizes, doc, "left")
    last = F.col("n_pages") - 1
    start = F.greatest(F.lit(0), F.least(F.col("s.folio") + F.col("offset"), last))
    end = F.greatest(start, F.least(F.coalesce(F.col("next") + F.col("offset") - 1, last), last))
    sure = F.col("agreement") >= 50
    low = F.greatest(F.lit(15), F.least(F.lit(40), F.floor(F.col("agreement") * at.contents / 100)))
    return own.select(
        doc, start.cast("int").alias("start_page"), F.least(end, start + at.max_pages - 1).cast("int").alias("end_page"),
        F.when(sure, at.contents).otherwise(low).cast("int").alias("score"), F.col("s.title").alias("heading"), "offset",
    )


def locate_body(pages: DataFrame, doc: str = "document_id", at: Location = LOCATION) -> DataFrame:
    """(doc, start_page, end_page, score): the run of pages with most evidence, each page costing a penalty.

    From each page the sum runs on for at most ``max_pages`` pages and stops below -0.9; a run ends at
    its last page of evidence. The pages of one report are the unit and come as one array of numbers.
    """
    entry = F.array_sort(F.collect_list(F.struct("page_no", "score"))).alias("p")
    own = pages.groupBy(doc).agg(F.max("score").alias("peak"), entry).filter(F.col("peak") >= at.body_peak)

    def run(x: Column, i: Column) -> Column:
        def step(a: Column, y: Column) -> Column:
            total = a["total"] + y["score"] - at.page_penalty
            good = F.when(y["score"] > 20, y["page_no"]).otherwise(a["good"])
            better = ~a["stop"] & (total > a["best"])
            return F.struct(
                F.when(a["stop"], a["total"]).otherwise(total).alias("total"), F.when(a["stop"], a["good"]).otherwise(good).alias("good"),
                F.when(better, total).otherwise(a["best"]).alias("best"), F.when(better, good).otherwise(a["end"]).alias("end"),
                (a["stop"] | (total < -90)).alias("stop"),
            )

        zero = F.struct(
            F.lit(0).alias("total"), x["page_no"].alias("good"), F.lit(0).alias("best"), x["page_no"].alias("end"), F.lit(False).alias("stop")
        )
        done = F.aggregate(F.slice(F.col("p"), i + 1, F.lit(at.max_pages)), zero, step)
        return F.struct(done["best"].alias("best"), (-x["page_no"]).alias("neg"), done["end"].alias("end"))

    best = own.withColumn("b", F.array_max(F.transform("p", run))).filter("b.best > 0")
    score = F.least(F.lit(at.body_most), F.lit(30) + F.floor(F.col("b.best") / 6)).cast("int")
    return best.select(doc, (-F.col("b.neg")).alias("start_page"), F.col("b.end").alias("end_page"), score.alias("score"))


def arbiter(candidates: DataFrame, pages: DataFrame, doc: str = "document_id", at: Location = LOCATION) -> DataFrame:
    """(doc, method, start_page, end_page, supporters, words, score) of the best span of each report.

    ``candidates`` are (doc, ord, method, start_page, end_page, score). The highest score stands, the
    lower ``ord`` of equal ones; other candidates that begin within ``near`` pages support it. A span
    of too few words counts half.
    """
    w = Window.partitionBy(doc).orderBy(F.desc("score"), "ord")
    top = candidates.withColumn("__r", F.row_number().over(w))
    first = top.filter("__r = 1").drop("__r")
    others = top.filter("__r > 1").select(doc, F.col("start_page").alias("__s"))
    support = (
        first.select(doc, "start_page").join(others, doc).filter(F.abs(F.col("start_page") - F.col("__s")) <= at.near)
        .groupBy(doc).agg(F.count("*").alias("supporters"))
    )
    inside = (
        first.select(doc, "start_page", "end_page").join(pages.select(doc, "page_no", "words"), doc)
        .filter(F.col("page_no").between(F.col("start_page"), F.col("end_page"))).groupBy(doc).agg(F.sum("words").alias("words"))
    )
    out = first.join(support, doc, "left").join(inside, doc, "left").fillna(0, ["supporters", "words"])
    score = F.least(F.lit(at.best), F.col("score") + at.supporter * F.col("supporters"))
    return out.select(
        doc, "method", "start_page", "end_page", "supporters", "words",
        F.when(F.col("words") < at.min_words, score / 2).otherwise(score.cast("double")).alias("score"),
    )


def prose_of(text: Column, furniture: Column) -> Column:
    """struct<prose, tables>: a page's text without furniture and runs of figures, words joined over line ends.

    ``furniture`` is an array of furniture keys. A run of three lines of figures or more is a table: its
    lines are counted, not kept. A null text has the empty prose.
    """
    lines = F.filter(full_lines(F.split(F.coalesce(text, F.lit("")), "\n")), lambda s: ~F.array_contains(furniture, T.furniture_key(s)))
    told = F.transform(lines, lambda s: F.struct(s.alias("s"), (T.hits(s, "[0-9]") * 2 >= T.hits(s, r"\p{L}")).alias("f")))

    def parted(own: Column) -> Column:
        near = lambda i, d: F.coalesce(F.get(own, i + d)["f"], F.lit(False))
        table = lambda i: near(i, 0) & ((near(i, -1) & near(i, 1)) | (near(i, 1) & near(i, 2)) | (near(i, -1) & near(i, -2)))
        return F.transform(own, lambda x, i: F.when(~table(i), x["s"]))

    def whole(rows: Column) -> Column:
        kept = F.array_compact(rows)
        prose = F.regexp_replace(F.array_join(kept, "\n"), "([a-z])-\n([a-z]+)", "$1$2\n")
        return F.struct(prose.alias("prose"), (F.size(rows) - F.size(kept)).alias("tables"))

    return T.once(T.once(told, parted), whole)


def refine_end(spans: DataFrame, pages: DataFrame, doc: str = "document_id", at: Location = LOCATION) -> DataFrame:
    """``spans`` (doc, start_page, end_page) with ``refined_end``: on from the end while pages go on.

    At most ``extra`` pages; a missing page, a page with an ending line or a nearly empty one stops the walk.
    """
    weak = (F.col("score") < 15) & (F.col("words") < 60)
    near = spans.select(doc, "end_page").distinct().withColumn("page_no", F.explode(F.sequence(F.col("end_page") + 1, F.col("end_page") + at.extra)))
    own = pages.select(doc, "page_no", "score", "words", "terms").withColumn("__here", F.lit(True))
    looked = near.join(own, [doc, "page_no"], "left")
    stops = F.col("__here").isNull() | (F.size("terms") > 0) | weak
    first = looked.filter(F.coalesce(stops, F.lit(True))).groupBy(doc, "end_page").agg(F.min("page_no").alias("__stop"))
    out = spans.join(first, [doc, "end_page"], "left")
    return out.select(*spans.columns, F.coalesce(F.col("__stop") - 1, F.col("end_page") + at.extra).cast("int").alias("refined_end"))
