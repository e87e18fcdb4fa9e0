"""Noise in the text of scanned pages (problem 6).

Words: candidates for correction come from an inverted join of character q-grams between all words
of the corpus and the trusted ones; a gradient-boosted ranker decides whether a candidate replaces
the word. Lines: boosted classifiers of line and neighbour decide which lines are page furniture
and which words go on in the next line, with a hyphen or without. All three are trained here, without hand labels: the
ranker and the joiner on trusted words that are misread or split on purpose, the furniture
classifiers on lines that repeat, or count on, over the pages of long reports.

The lexicon stays a table. What goes to the tasks are models and two sieves of fixed greatest size
(Bloom filters of the words that are replaced and of the words that broken pieces may make); what
passes a sieve by chance falls out in the join behind it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.boost import Booster
from foliant.llm.names import ratio
from foliant.session import cut

#: A word is trusted if it stands whole so often, at every size of the corpus, and no likelier word replaces it.
TRUST_COUNT = 3
#: Trusted words used to train ranker and joiner, and those they know, the most frequent; edge lines for the furniture.
TRAIN_WORDS, KNOWN_WORDS, TRAIN_LINES = 1_500, 20_000, 6_000
REPLACE, JOIN, FURNITURE = 0.5, 0.5, 0.5
#: A candidate must be so many times as frequent as the word it replaces.
RATIO = 5.0
#: Different tokens a task holds before it passes its counts on; it changes memory, never a count.
TALLY_TOKENS = 300_000
#: Furniture is looked for in so many lines at either end and on to the first of full width, that is, of so
#: much of the page's median width.
EDGE, FULL_WIDTH = 2, 0.7
#: Bits of a sieve per word, and at most.
SIEVE_BITS, SIEVE_MOST, SIEVE_PROBES = 12, 1 << 26, 4
SEED = 11

# Shapes that scanners take for each other, in both directions.
CONFUSED = (
    ("m", "rn"), ("u", "ii"), ("n", "ri"), ("d", "cl"), ("w", "vv"), ("l", "1"), ("i", "l"), ("i", "1"), ("o", "0"),
    ("s", "5"), ("e", "c"), ("h", "b"), ("t", "f"), ("y", "v"), ("g", "q"), ("g", "9"), ("b", "8"), ("z", "2"),
    ("a", "o"), ("n", "u"), ("i", "j"), ("k", "lc"), ("h", "li"), ("a", "@"), ("b", "6"), ("t", "+"), ("i", "!"), ("l", "|"),
    ("f", "£"), ("fi", "ﬁ"), ("fl", "ﬂ"),
)
_SHAPES = {(a, b) for a, b in CONFUSED} | {(b, a) for a, b in CONFUSED}
_ENDINGS = ("s", "es", "ed", "d", "ing", "ly", "er", "r", "n", "y", "al")
HYPHENS = "-¬‐­"
_PARTING = "\n\t\r\f\v-/¬‐\u00ad–—|\u00a0\u2003\u2009\u202f"
# A pound sign beside a letter may be a misread one and belongs to the word.
_EDGES = r"^(?:[^\p{L}\p{N}@+!£]|£(?!\p{L}))+|(?:[^\p{L}\p{N}@+£]|(?<!\p{L})£)+$"
_PY_SPLIT = re.compile(r"[\s\-/¬‐­–—|]+")
_PY_EDGES = re.compile(r"^(?:(?![@+!]|£[^\W\d_])[\W_])+|(?:(?![@+]|(?<=[^\W\d_])£)[\W_])+$")
_NUMBER = re.compile(r"^[\W_]*(?:(?:page|pg|p|p[a-z]g[a-z])\b[\W_]*)?([0-9lIoOSsiBbZzqg|]{1,4})(?:[\W_]*(?:of|/)[\W_]*[0-9lIoOSsB]{1,4})?[\W_]*$", re.I)
_HAS_DIGIT = re.compile(r"\d")
_MIXED_OK = re.compile(r"^(?:q[1-4]|h[12]|fy\d+|\d+(?:st|nd|rd|th)|iso\d*|[a-z]\d{1,2}|\d+[a-z])$")


def clean_word(w: str) -> str:
    """A word without punctuation at its ends, in lower case."""
    return _PY_EDGES.sub("", w).lower()


def grams(w: str) -> list[str]:
    """Padded character trigrams, once each."""
    p = f"##{w}##"
    return sorted({p[i : i + 3] for i in range(len(p) - 2)})


# ---------------------------------------------------------------- words


def difference(a: str, b: str) -> tuple[str, str, int, int]:
    """(part of a, part of b, common beginning, common end) once equal ends are taken off."""
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return a[i : len(a) - j], b[i : len(b) - j], i, j


def _shape_steps(a: str, b: str) -> tuple[int, int]:
    """(changes that confused shapes explain, other changes) between two differing middles.

    The cheapest way to the end from every pair of places, fewest other changes first; pieces of one
    or two letters are equal, a confused shape, or all that is left of both, letter by letter.
    """
    n, m = len(a), len(b)
    best = [[(0, 0)] * (m + 1) for _ in range(n + 1)]  # (other, shapes) from place i in a and j in b on
    for i in range(n, -1, -1):
        for j in range(m, -1, -1):
            if i == n and j == m:
                continue
            least = (0, 1) if (b[j:], a[i:]) in _SHAPES else (max(n - i, m - j), 0)
            for x in (1, 2):
                for y in (1, 2):
                    if i + x <= n and j + y <= m:
                        p, q = a[i : i + x], b[j : j + y]
                        if p == q or (q, p) in _SHAPES:
                            other, shapes = best[i + x][j + y]
                            least = min(least, (other, shapes + (p != q)))
            best[i][j] = least
    return best[0][0][1], best[0][0][0]


def pair_features(word: str, count: int, other: str, other_count: int, shared: int) -> list[float]:
    """Of a word and the trusted word that may be meant."""
    a, b, i, j = difference(word, other)
    shape, rest = _shape_steps(a, b)
    ending = float(j == 0 and (a in _ENDINGS or a == "") and (b in _ENDINGS or b == ""))
    odd = sum(not ch.isalpha() for ch in word)
    return [
        np.log((other_count + 1) / (count + 1)), np.log(count + 1.0), float(shape), float(rest), len(a), len(b),
        float(i), float(j), float(len(word)), ending, float(odd), shared / (len(word) + 2), float(i == 0),
    ]


def misread(word: str, rng: np.random.Generator) -> str:
    """A word with one confused shape, or unchanged where none of its shapes is confused."""
    spots = [(i, a, b) for a, b in sorted(_SHAPES) for i in range(len(word)) if word.startswith(a, i) and a.isalpha()]
    if not spots:
        return word
    i, a, b = spots[rng.integers(len(spots))]
    return word[:i] + b + word[i + len(a) :]


def train_ranker(trusted: dict[str, int]) -> Booster:
    """On trusted words misread on purpose (replace) and trusted words left alone (keep)."""
    rng = np.random.default_rng(SEED)
    words = sorted((w for w in trusted if w.isalpha()), key=lambda w: (-trusted[w], w))[:TRAIN_WORDS]
    index: dict[str, list[str]] = {}
    for w in words:
        for g in grams(w):
            index.setdefault(g, []).append(w)

    def near(w: str) -> list[tuple[str, int]]:
        hits = Counter(v for g in grams(w) for v in index.get(g, ()) if v != w and abs(len(v) - len(w)) <= 1)
        return [x for x in hits.most_common(6) if x[1] >= 2]

    x, y = [], []
    for w in words:
        for v, n in near(w):
            shape, rest = _shape_steps(*difference(w, v)[:2])
            if trusted[v] >= RATIO * trusted[w] and not (rest == 0 and trusted[v] > 20 * trusted[w]):
                x.append(pair_features(w, trusted[w], v, trusted[v], n))
                y.append(0)
        for _ in range(3):
            bad = misread(w, rng)
            if bad in trusted or len(bad) < 2:
                continue
            count = 1 + int(rng.poisson(0.003 * trusted[w] * rng.random()))
            for v, n in [(w, len(set(grams(bad)) & set(grams(w)))), *near(bad)]:
                x.append(pair_features(bad, count, v, trusted[v], n))
                y.append(int(v == w))
        if len(w) > 4:  # a new word that only inflects or resembles a known one stays
            new = w + "s" if not w.endswith("s") else w[:-1]
            if new not in trusted:
                x.append(pair_features(new, 2, w, trusted[w], len(set(grams(new)) & set(grams(w)))))
                y.append(0)
    return Booster().fit(np.array(x), np.array(y)) if x else Booster()


def word_counts(texts: list[DataFrame]) -> DataFrame:
    """(word, n, n_whole) over the column ``text`` of all tables.

    ``n`` counts words broken over lines as one word, ``n_whole`` only words that stand in one line.
    """
    broken = re.compile(r"(?<=[^\W\d_])[-¬‐\u00ad][ \t]*\r?\n[ \t]*(?=[^\W\d_A-Z])")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["w", "n"])
            seen.clear()
            return made

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(broken.sub("\u0001", text).split())
            if len(seen) > TALLY_TOKENS:
                yield out()
        yield out()

    every = texts[0].select("text")
    for t in texts[1:]:
        every = every.unionByName(t.select("text"))
    # Whole tokens are counted where they stand; what tells a word is worked out once for each of them.
    raw = every.mapInArrow(tally, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    plain = F.translate("w", _PARTING, " " * len(_PARTING))
    each = raw.select(F.explode(F.split(plain, " ")).alias("w"), "n")
    word = F.lower(F.regexp_replace(F.replace(F.col("w"), F.lit("\u0001"), F.lit("")), _EDGES, ""))
    return (
        each.select(word.alias("word"), F.contains("w", F.lit("\u0001")).alias("broken"), "n")
        .filter(r"word <> '' and word not rlike '^[0-9.,%]+$'")
        .groupBy("word")
        .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("broken"), 0).otherwise(F.col("n"))).alias("n_whole"))
    )


def lexicon_of(counts: DataFrame) -> DataFrame:
    """(word, n) of the words of Latin letters that stand whole often enough."""
    return counts.filter((F.col("n_whole") >= TRUST_COUNT) & F.col("word").rlike(r"^[a-z][a-z'’.]*$")).select("word", "n")


def best_known(lexicon: DataFrame) -> dict[str, int]:
    """At most KNOWN_WORDS of the most frequent words of a lexicon.

    Taken are all words of the highest eighths of octaves of frequency that together hold no more;
    so no task sends more than its share of them.
    """
    eighth = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    held, least = 0, None
    for r in sorted(lexicon.groupBy(eighth.alias("k")).agg(F.count("*").alias("n")).collect(), reverse=True):
        held += r["n"]
        if held > KNOWN_WORDS:
            break
        least = r["k"]
    if least is None:
        return {}
    return {r["word"]: r["n"] for r in lexicon.filter(eighth >= least).collect()}


class Sieve:
    """A set of words that may say yes to others, but never no to its own."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits
        self.mask = len(bits) * 64 - 1

    def __contains__(self, word: str) -> bool:
        h = xxhash.xxh64_intdigest(word.encode(), seed=42)
        step = (h >> 32) | 1
        for k in range(SIEVE_PROBES):
            at = ((h & 0xFFFFFFFF) + k * step) & self.mask
            if not int(self.bits[at >> 6]) >> (at & 63) & 1:
                return False
        return True


def sieve(words: DataFrame) -> Sieve:
    """Of the column ``word``; built where the words are, at most SIEVE_MOST bits reach the driver."""
    size = 64
    while size < min(SIEVE_MOST, SIEVE_BITS * words.count()):
        size *= 2
    h = F.xxhash64("word")
    step = F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    place = F.explode(F.array(*[(h.bitwiseAND(F.lit(0xFFFFFFFF)) + step * k).bitwiseAND(F.lit(size - 1)) for k in range(SIEVE_PROBES)]))
    bit = F.expr("shiftleft(1L, cast(at & 63 AS int))")
    rows = words.select(place.alias("at")).groupBy(F.shiftright("at", 6).alias("k")).agg(F.bit_or(bit).alias("bits")).collect()
    bits = np.zeros(size // 64, np.uint64)
    for r in rows:
        bits[r["k"]] = r["bits"] & 0xFFFFFFFFFFFFFFFF
    return Sieve(bits)


def corrections(counts: DataFrame, lexicon: DataFrame, ranker: Booster) -> DataFrame:
    """(word, replacement, probability) of the words that are misread; found for every word of the corpus.

    The inverted join is by trigram and length, the trusted side within one letter; trusted words
    are candidates and may be replaced themselves by much more frequent ones, then by what replaces
    their own replacement. Left out are words without a Latin letter and words with letters of another script.
    """
    shared = counts.sparkSession.sparkContext.broadcast(ranker)
    gram = lambda c: F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(c) + 2), lambda i: F.substring(F.concat(F.lit("##"), c, F.lit("##")), i, F.lit(3)))))
    words = counts.filter(F.col("word").rlike(r"\p{IsLatin}") & ~F.col("word").rlike(r"[\p{L}&&[^\p{IsLatin}]]") & (F.length("word") > 1))
    others = lexicon.filter(F.col("n") >= RATIO).select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    index = others.select("other", "other_n", F.length("other").alias("size"), gram(F.col("other")).alias("g"))
    probe = words.select("word", "n", gram(F.col("word")).alias("g"))
    probe = probe.select("word", "n", "g", F.explode(F.array(*[F.length("word") + k for k in (-1, 0, 1)])).alias("size"))
    pairs = (
        probe.join(index, ["g", "size"])
        .filter(F.col("other_n") >= F.lit(RATIO) * F.col("n"))
        .groupBy("word", "n", "other", "other_n")
        .agg(F.count("*").alias("shared"))
        .filter((F.col("word") != F.col("other")) & ((F.col("shared") >= 2) & (F.col("shared") * 3 >= F.length("word"))))
    )

    @F.pandas_udf("double")
    def rank(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for w, n, o, m, s in parts:
            x = np.array([pair_features(*r) for r in zip(w, n, o, m, s)])
            yield pd.Series(shared.value.probability(x))

    scored = pairs.withColumn("probability", rank("word", "n", "other", "other_n", "shared"))
    best = cut(
        scored.filter(F.col("probability") >= REPLACE)
        .groupBy("word")
        .agg(F.max_by(F.struct("other", "probability"), F.struct("probability", "other_n", "other")).alias("b"))
        .select("word", F.col("b.other").alias("replacement"), F.col("b.probability").alias("probability"))
    )
    again = best.select(F.col("word").alias("replacement"), F.col("replacement").alias("further"))
    return best.join(again, "replacement", "left").select("word", F.coalesce("further", "replacement").alias("replacement"), "probability")


# ---------------------------------------------------------------- lines


def page_number(line: str) -> int | None:
    """The number of a line that holds a page number alone, misread digits put right, else null."""
    m = _NUMBER.match(line)
    if not m or not any(ch.isdigit() for ch in m[1]) and not line.strip().lower().startswith(("p", "[", "(", "-")):
        return None
    digits = "".join({"l": "1", "I": "1", "i": "1", "|": "1", "o": "0", "O": "0", "S": "5", "s": "5", "B": "8", "b": "6",
                      "Z": "2", "z": "2", "q": "9", "g": "9"}.get(ch, ch) for ch in m[1])
    return int(digits)


def furniture_form(line: str) -> str:
    """Letters of a line alone, in upper case."""
    return "".join(ch for ch in line.upper() if ch.isalpha())


def edge_lines(pages: DataFrame) -> DataFrame:
    """The lines at either end of each page that may be furniture, with their form and number.

    They are the first and last EDGE lines that are not blank, and the lines after them up to the
    first of full width, where the body has begun.
    """

    @F.pandas_udf(
        "array<struct<line_no int, top int, bottom int, line string, form string, number int, native boolean, inner boolean>>"
    )
    def edges(texts: pd.Series, engines: pd.Series) -> pd.Series:
        out = []
        for text, engine in zip(texts, engines):
            rows = [(k, x) for k, x in enumerate((text or "").split("\n")) if x.strip()]
            widths = [len(x.strip()) for _, x in rows]
            full = FULL_WIDTH * float(np.median(widths)) if rows else 0.0
            n, take = len(rows), set()
            for order in (range(n), range(n - 1, -1, -1)):
                for at, p in enumerate(order):
                    take.add(p)
                    if at >= EDGE - 1 and widths[p] >= full:
                        break
            out.append(
                [{"line_no": k, "top": p, "bottom": n - 1 - p, "line": x, "form": furniture_form(x),
                  "number": page_number(x), "native": engine == "native", "inner": False}
                 for p, (k, x) in enumerate(rows) if p in take]
            )
        return pd.Series(out)

    return pages.select("document_id", "page_no", F.explode(edges("text", "engine")).alias("e")).select(
        "document_id", "page_no", "e.*"
    )


def edge_evidence(edges: DataFrame) -> DataFrame:
    """Edge lines with what the other pages of the report, and other reports, say about them.

    ``like`` is the ratio of a form to the most similar one that stands on several pages of the
    report; only different forms of nearly the same length are compared, once each.
    """
    edges = edges.withColumn("form", F.nullif("form", F.lit("")))
    pages = edges.groupBy("document_id").agg(F.count_distinct("page_no").alias("n_pages"))
    form = cut(
        edges.filter("form is not null")
        .groupBy("document_id", "form")
        .agg(
            F.count_distinct("page_no").alias("form_pages"),
            F.count_distinct(F.pmod("page_no", F.lit(2))).alias("sides"),
            F.count_distinct(F.least("top", F.lit(EDGE))).alias("places"),
        )
    )

    @F.pandas_udf("double")
    def resembles(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([ratio(x, y) for x, y in zip(a, b)], dtype="float64")

    often = form.filter("form_pages >= 2").select("document_id", F.col("form").alias("known"), F.length("form").alias("size"))
    once = form.filter("form_pages < 2 and length(form) > 3").select(
        "document_id", "form", F.explode(F.sequence(F.length("form") - 3, F.length("form") + 3)).alias("size")
    )
    near = once.join(often, ["document_id", "size"]).withColumn("like", resembles("form", "known"))
    near = near.groupBy("document_id", "form").agg(F.max("like").alias("like"))
    own = F.when((F.col("form_pages") >= 2) & (F.length("form") > 3), 1.0).otherwise(F.coalesce("like", F.lit(0.0)))
    form = form.join(near, ["document_id", "form"], "left").withColumn("like", own)
    corpus = form.groupBy("form").agg(
        F.count("*").alias("form_docs"), F.count_if((F.col("form_pages") >= 2)).alias("form_repeats")
    )
    step = (
        edges.filter("number is not null")
        .groupBy("document_id", (F.col("number") - F.col("page_no")).alias("step"))
        .agg(F.count_distinct("page_no").alias("step_pages"))
    )
    return (
        edges.withColumn("step", F.col("number") - F.col("page_no"))
        .join(pages, "document_id")
        .join(form, ["document_id", "form"], "left")
        .join(step, ["document_id", "step"], "left")
        .join(corpus, "form", "left")
    )


def line_features(r) -> list[float]:
    """Of an edge line with its evidence; a row or a named tuple."""
    line = r.line.strip()
    n = max(1, r.n_pages)
    letters = sum(ch.isalpha() for ch in line)
    digits = sum(ch.isdigit() for ch in line)
    words = line.split()
    none = lambda v: 0.0 if v is None or v != v else float(v)
    return [
        float(r.top), float(r.bottom), none(r.form_pages) / n, none(r.form_pages), none(r.step_pages) / n, none(r.step_pages),
        float(n), np.log1p(none(r.form_docs)), none(r.form_repeats) / max(1.0, none(r.form_docs)), none(r.like),
        sum(ch.isupper() for ch in line) / max(1, letters), letters / max(1, len(line)), digits / max(1, len(line)),
        float(len(words)), float(line.endswith((".", ",", ";"))), sum(w[:1].isupper() for w in words) / max(1, len(words)),
        float(r.number is not None and r.number == r.number), float("," in line or "%" in line), float(len(line)),
        float(bool(re.search(r"^\d+\s|\s\d+$", line))), float(sum(any(c.isdigit() for c in w) for w in words)),
        float(none(r.form_pages) >= 2 and r.sides == 1), float(none(r.form_pages) >= 2 and r.places == 1),
        float(any(w in ("limited", "ltd") or len(w) >= 6 and ratio(w, "limited") >= 0.85 for w in re.findall(r"\w+", line.lower()))),
    ]


def train_furniture(evidence: DataFrame) -> tuple[Booster, Booster]:
    """(header, number) classifiers from a bounded sample of lines that the evidence itself labels."""
    mark = F.xxhash64("document_id", "page_no", "line_no")
    # Only about twice as many as are needed, those under a bound on the hash, are sorted.
    bound = (1 << 64) * min(1.0, 2.0 * TRAIN_LINES / max(1, evidence.count())) - (1 << 63)
    some = evidence.filter(mark < F.lit(min(bound, (1 << 63) - 1)).cast("long"))
    rows = some.orderBy(mark, "document_id", "page_no", "line_no").limit(TRAIN_LINES).collect()
    hx, hy, nx, ny = [], [], [], []
    for r in rows:
        x = line_features(r)
        n = r["n_pages"]
        on = r["form_pages"] or 0
        # On many pages, or on every other page of a short report (headers of left and right pages).
        repeats = r["form"] and (on >= max(3, 0.3 * n) or on == 2 and n <= 5 and r["sides"] == 1 and r["places"] == 1)
        counts_on = r["number"] is not None and (r["step_pages"] or 0) >= max(2, 0.5 * n)
        weak = list(x)
        if repeats and n >= 2:
            hx.append(x), hy.append(1)
            weak[2:4], weak[-3:-1] = [1.0 / n, 1.0], [0.0, 0.0]  # the same line, were it not on other pages
            if x[8] > 0.7:
                hx.append(weak), hy.append(1)
            if r["form"]:  # one letter of it misread, which no other page and report shows
                once = list(weak)
                once[7:10] = [float(np.log1p(1)), 0.0, 1 - 1 / len(r["form"])]
                hx.append(once), hy.append(1)
            if x[-1]:  # nor in any other report
                alone = list(weak)
                alone[2:4], alone[6], alone[7:10] = [1.0, 1.0], 1.0, [float(np.log1p(1)), 0.0, 0.0]
                hx.append(alone), hy.append(1)
        elif r["native"] or (n >= 3 and (r["form_pages"] or 0) <= 1 and x[9] < 0.6 and x[8] < (0.5 if x[7] > 1.7 else 0.3)):
            hx.append(x), hy.append(0)
        if counts_on and n >= 2:
            nx.append(x), ny.append(1)
            weak = list(x)
            weak[4:6] = [1.0 / n, 1.0]
            nx.append(weak), ny.append(1)
        elif r["native"] or r["number"] is None:
            nx.append(x), ny.append(0)
    empty = np.zeros((0, 23))
    return (
        Booster().fit(np.array(hx) if hx else empty, np.array(hy)),
        Booster().fit(np.array(nx) if nx else empty, np.array(ny)),
    )


def furniture(pages: DataFrame) -> DataFrame:
    """(document_id, page_no, line_no, noise): running headers and footers, and page numbers alone."""
    evidence = cut(edge_evidence(edge_lines(pages)))
    models = pages.sparkSession.sparkContext.broadcast(train_furniture(evidence))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        header, number = models.value
        for b in batches:
            rows = list(b.itertuples())
            x = np.array([line_features(r) for r in rows]) if rows else np.zeros((0, 23))
            h, p = header.probability(x), number.probability(x)
            lone = np.array([r.number is not None and r.number == r.number for r in rows], bool)
            noise = np.where(lone & (p >= FURNITURE), "page_number", np.where(~lone & (h >= FURNITURE), "header", ""))
            yield b[["document_id", "page_no", "line_no"]].assign(noise=noise)

    use = evidence.select(
        "document_id", "page_no", "line_no", "line", "form", "top", "bottom", "n_pages", "form_pages", "step_pages",
        "form_docs", "form_repeats", "like", "number", "sides", "places",
    )
    return use.mapInPandas(judge, "document_id string, page_no int, line_no int, noise string").filter("noise <> ''")


# ---------------------------------------------------------------- joins


def join_features(left: str, right: str, mark: str, compound: int, trusted: dict[str, int]) -> list[float]:
    """Of the pieces of a word at a line end and the next line's beginning; ``mark`` is empty where the sign is lost."""
    a, b = clean_word(left), clean_word(right)
    rarer = min(trusted.get(a, 0), trusted.get(b, 0))
    return [
        float(mark not in ("-", "")), float(not mark), float(np.log((trusted.get(a + b, 0) + 1) / (rarer + 1))), float(np.log1p(trusted.get(a + b, 0))), float(np.log1p(trusted.get(a, 0))),
        float(np.log1p(trusted.get(b, 0))), float(len(a)), float(len(b)), float(right[:1].islower()),
        float(bool(a) and a.isalpha()), float(np.log1p(compound)),
    ]


def train_joiner(trusted: dict[str, int]) -> Booster:
    """On trusted words split on purpose (join) and pairs of whole words after a hyphen (leave).

    Without a sign a word is split likewise; left are words that only happen to be two others in a row.
    """
    rng = np.random.default_rng(SEED)
    words = sorted((w for w in trusted if w.isalpha()), key=lambda w: (-trusted[w], w))[:TRAIN_WORDS]
    common = words[:40]
    x, y = [], []
    for w in words:
        for _ in range(2):
            if len(w) >= 5:
                k = int(rng.integers(2, len(w) - 1))
                right = w[k:] if rng.random() < 0.9 else misread(w[k:], rng)
                x.append(join_features(w[:k], right, "-" if rng.random() < 0.7 else "¬", 0, trusted)), y.append(1)
                if trusted[w] >= RATIO * min(trusted.get(w[:k], 0), trusted.get(w[k:], 0)):
                    x.append(join_features(w[:k], w[k:], "", 0, trusted)), y.append(1)
        other = common[int(rng.integers(len(common)))]
        if w + other not in trusted:
            x.append(join_features(w, other, "-", 0, trusted)), y.append(0)
            x.append(join_features(w, other, "", 0, trusted)), y.append(0)
        for k in range(1, len(w)):
            if trusted[w] < RATIO * min(trusted.get(w[:k], 0), trusted.get(w[k:], 0)):
                x.append(join_features(w[:k], w[k:], "", 0, trusted)), y.append(0)
        x.append(join_features("", other, "-", 0, trusted)), y.append(0)
        piece = w[: max(2, len(w) // 2)]
        if piece not in trusted and piece + other not in trusted:  # a prefix such as pre- before a whole word
            x.append(join_features(piece, other, "-", 0, trusted)), y.append(0)
    return Booster().fit(np.array(x), np.array(y)) if x else Booster()


def unsigned(line: str) -> str:
    """A line without the hyphen at its end, if it has one."""
    line = line.rstrip()
    return line[:-1] if line[-1:] and line[-1] in HYPHENS else line


class Reader:
    """Seams, and the words that are to be replaced, of one page; ``sought`` and ``whole`` are sieves."""

    def __init__(self, sought: Sieve, whole: Sieve) -> None:
        self.sought, self.whole = sought, whole
        self.words: dict[str, tuple[tuple[str, str | None], ...]] = {}
        self.pieces: dict[str, tuple[tuple[str, str], tuple[str, str]]] = {}

    def ends(self, raw: str) -> tuple[tuple[str, str], tuple[str, str]]:
        """(last piece, first piece) of a token, each as written and as a word."""
        known = self.pieces.get(raw)
        if known is None:
            parts = _PY_SPLIT.split(raw)
            if len(self.pieces) > 200_000:
                self.pieces.clear()
            known = self.pieces[raw] = (parts[-1], clean_word(parts[-1])), (parts[0], clean_word(parts[0]))
        return known

    def wrong(self, raw: str) -> tuple[tuple[str, str | None], ...]:
        """(word, number it stands for or null) of the words of a token that may be misread."""
        known = self.words.get(raw)
        if known is None:
            parts = (clean_word(w) for w in _PY_SPLIT.split(raw))
            told = ((w, numeric_reading(w) if _HAS_DIGIT.search(w) else None) for w in parts if w)
            known = tuple((w, n) for w, n in told if n is not None or w in self.sought)
            if len(self.words) > 200_000:
                self.words.clear()
            self.words[raw] = known
        return known

    def seam(self, line: str, following: str) -> tuple[str, str, str] | None:
        """(piece before, piece after, sign) where a line ends in a hyphen after a letter or digit.

        The sign is empty where it is lost: line end and beginning may make a trusted word.
        """
        line, following = line.rstrip(), following.lstrip()
        if not line or not following:
            return None
        if line[-1].isalpha() and following[0].islower():
            (left, a), (right, b) = self.ends(line.rsplit(None, 1)[-1])[0], self.ends(following.split(None, 1)[0])[1]
            return (left, right, "") if a and b and a + b in self.whole else None
        if len(line) < 2 or line[-1] not in HYPHENS or not line[-2].isalnum():
            return None
        return _PY_SPLIT.split(line[:-1])[-1], _PY_SPLIT.split(following.strip())[0], line[-1]

    def seams(self, text: str, skip: set[int]) -> list[tuple[int, str, str, str]]:
        """(line, piece before, piece after, sign) of all places where a word may go on in the next line."""
        lines = text.split("\n")
        body = [k for k, x in enumerate(lines) if x.strip() and k not in skip]
        found = ((k, self.seam(lines[k], lines[after])) for k, after in zip(body, body[1:]))
        return [(k, *s) for k, s in found if s is not None]

    def page(self, text: str, skip: set[int], going: set[int]) -> list[tuple[int, int, int, str, str | None]]:
        """(line, line of the word's end, length of its beginning, word, number) of the words that may be misread."""
        lines = text.split("\n")
        body = [k for k, x in enumerate(lines) if x.strip() and k not in skip]
        words = []
        carried: tuple[int, str] | None = None
        for k in body:
            line = lines[k].strip()
            joins = k in going
            parts = (unsigned(line) if joins else line).split()
            if carried and parts:
                j, head = carried
                first, *rest = [w for w in _PY_SPLIT.split(parts[0]) if w] or [""]
                words += [(j, k, len(head), w, n) for w, n in self.wrong(head + first)]
                parts[0:1] = rest
            carried = None
            if joins and parts:
                *rest, last = [w for w in _PY_SPLIT.split(parts[-1]) if w] or [""]
                carried = (k, last.lstrip("(\"'“‘[").lower())
                parts[-1:] = rest
            for raw in parts:
                found = self.words.get(raw)
                if found is None:
                    found = self.wrong(raw)
                if found:
                    words += [(k, k, 0, w, n) for w, n in found]
        return words


def joined_lines(full: DataFrame, reader_of, good: DataFrame, joiner: Booster) -> DataFrame:
    """(document_id, page_no, line_no) of lines whose last word goes on in the next line.

    Different seams are judged once each, with the counts of pieces and whole from the lexicon ``good``.
    """
    shared = full.sparkSession.sparkContext.broadcast(joiner)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = reader_of()
        for b in batches:
            rows = [
                (d, p, k, a, z, m, clean_word(a), clean_word(z))
                for d, p, text, skip in zip(b["document_id"], b["page_no"], b["text"], b["skip"])
                for k, a, z, m in reader.seams(text, set(skip) if skip is not None else set())
            ]
            yield pd.DataFrame(rows, columns=["document_id", "page_no", "line_no", "before", "after", "mark", "a", "b"])

    seen = cut(
        full.mapInPandas(
            scan, "document_id string, page_no int, line_no int, before string, after string, mark string, a string, b string"
        )
    )
    piece = ["before", "after", "mark"]
    known = lambda c, n: good.select(F.col("word").alias(c), F.col("n").alias(n))
    told = (
        seen.select(*piece, "a", "b", F.concat("a", "b").alias("ab"))
        .distinct()
        .join(known("ab", "n_ab"), "ab", "left")
        .join(known("a", "n_a"), "a", "left")
        .join(known("b", "n_b"), "b", "left")
        .fillna(0, ["n_ab", "n_a", "n_b"])
    )

    @F.pandas_udf("double")
    def judge(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for before, after, mark, n_a, n_b, n_ab in parts:
            x = [
                join_features(p, q, m, 0, {clean_word(p): u, clean_word(q): v, clean_word(p) + clean_word(q): w})
                for p, q, m, u, v, w in zip(before, after, mark, n_a, n_b, n_ab)
            ]
            yield pd.Series(shared.value.probability(np.array(x)), dtype="float64")

    lost = (F.col("mark") == "") & (F.col("n_ab") <= F.least("n_a", "n_b"))
    joined = told.filter(~lost).withColumn("p", judge(*piece, "n_a", "n_b", "n_ab")).filter(F.col("p") >= JOIN).select(*piece)
    return seen.join(joined, piece, "left_semi").select("document_id", "page_no", "line_no")


def numeric_reading(word: str) -> str | None:
    """The number that a word of digits and digit-like letters stands for, else null."""
    if not any(ch.isdigit() for ch in word) or not any(ch.isalpha() for ch in word) or _MIXED_OK.match(word):
        if not (word.startswith(("l", "o", "i", "s")) and re.fullmatch(r"[lois][\d.,]+", word)):
            return None
    out = word.translate(str.maketrans("loisbzgq", "10156299"))
    return out if re.fullmatch(r"[\d.,%]+", out) else None


def analyse(pages: DataFrame, reference: list[DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(lines, words): noise of lines (document_id, page_no, line_no, noise) and the misread words
    (document_id, page_no, line_no, word, replacement).

    ``pages`` has document_id, page_no, text, engine; ``reference`` tables with a column ``text``
    add to the word statistics only. Repeated rows count once; null and empty texts have no noise.
    Every word of every page is judged, and every line at its ends (``edge_lines``). A misread word
    over two lines belongs to the line that holds the wrong letters. Broadcast are models and sieves.
    """
    spark = pages.sparkSession
    own = cut(
        pages.filter("text is not null and document_id is not null and page_no is not null")
        .groupBy("document_id", "page_no", "text")
        .agg(F.max("engine").alias("engine"))
    )
    counts = cut(word_counts([own.select("text"), *[t.select("text") for t in reference or []]]))
    lexicon = lexicon_of(counts)
    fixes = cut(corrections(counts, lexicon, train_ranker(best_known(lexicon))))
    good = cut(lexicon.join(fixes, "word", "left_anti"))
    sieves = spark.sparkContext.broadcast((sieve(fixes), sieve(good)))
    marks = cut(furniture(own))
    skips = marks.groupBy("document_id", "page_no").agg(F.collect_set("line_no").alias("skip"))
    page = ["document_id", "page_no"]
    full = own.join(skips, page, "left").select(*page, "text", "skip")
    going = cut(joined_lines(full, lambda: Reader(*sieves.value), good, train_joiner(best_known(good))))
    full = full.join(going.groupBy(*page).agg(F.collect_set("line_no").alias("going")), page, "left")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(*sieves.value)
        lines = lambda x: set(x) if x is not None else set()
        for b in batches:
            rows = [
                (d, p, *w)
                for d, p, text, skip, goes in zip(b["document_id"], b["page_no"], b["text"], b["skip"], b["going"])
                for w in reader.page(text, lines(skip), lines(goes))
            ]
            yield pd.DataFrame(rows, columns=[*page, "line_no", "end_line", "head", "word", "number"])

    seen = full.mapInPandas(read, "document_id string, page_no int, line_no int, end_line int, head int, word string, number string")
    found = seen.join(fixes.select("word", "replacement"), "word", "left")
    found = found.withColumn("replacement", F.coalesce("replacement", "number")).filter("replacement is not null")
    in_head = F.substring("word", F.lit(1), F.col("head")) != F.substring("replacement", F.lit(1), F.col("head"))
    words = cut(
        found.withColumn("line_no", F.when((F.col("head") == 0) | in_head, F.col("line_no")).otherwise(F.col("end_line")))
        .select(*page, "line_no", "word", "replacement")
    )
    lines = (
        marks.unionByName(going.withColumn("noise", F.lit("hyphen")))
        .unionByName(words.select(*page, "line_no", F.lit("misread").alias("noise")))
        .distinct()
    )
    return lines, words


def repaired(text: str, drop: set[int], going: set[int], fixes: dict[str, str], width: int | None = None) -> str:
    """Paragraphs of a page: furniture dropped, broken words joined, misread words replaced.

    A blank line, an indented line and a line of less than half of the page's width that ends a
    sentence part paragraphs.
    """
    lines = text.split("\n")
    width = max((len(x) for x in lines), default=0) if width is None else width
    out: list[str] = []
    now = ""

    def fixed(w: str) -> str:
        bare = _PY_EDGES.sub("", w)
        new = fixes.get(bare.lower())
        if new is None or not bare:
            return w
        new = new.upper() if bare.isupper() and len(bare) > 1 else new[:1].upper() + new[1:] if bare[:1].isupper() else new
        return w.replace(bare, new)

    for k, raw in enumerate(lines):
        if k in drop:
            continue
        line = raw.strip()
        if not line or raw[:2].isspace():
            if now:
                out.append(now)
            now = ""
        if not line:
            continue
        if k in going:
            line = unsigned(line) + "\u0000"
        now = now[:-1] + line if now.endswith("\u0000") else f"{now} {line}" if now else line
        if len(line) < width / 2 and line.endswith((".", "!", "?")):
            out.append(now)
            now = ""
    if now:
        out.append(now.rstrip("\u0000"))
    return "\n\n".join(" ".join(fixed(w) for w in p.split()) for p in out)


def repaired_blocks(text: str | None, blocks: list, drop: set[int], going: set[int], fixes: dict[str, str]) -> list:
    """The blocks of a page with their texts repaired like the page's own; null blocks and texts stay null.

    Lines of blocks are matched to equal lines of the page, whatever the order of the blocks; lines
    that the page lacks have no marks, but their words are replaced. A word that goes on in another
    block is joined in the block that begins it. A block of furniture alone has the empty text.
    """
    page = (text or "").split("\n")
    at: dict[str, list[int]] = {}
    for k in reversed(range(len(page))):
        at.setdefault(page[k].strip(), []).append(k)
    parts = [None if b is None or b["text"] is None else b["text"].split("\n") for b in blocks]
    place: dict[int, tuple[int, int]] = {}
    for i, lines in enumerate(parts):
        for j, x in enumerate(lines or ()):
            if x.strip() and at.get(x.strip()):
                place[at[x.strip()].pop()] = (i, j)
    body = [k for k, x in enumerate(page) if x.strip() and k not in drop]
    marks = {i: set() for i in range(len(parts))}
    for k, after in zip(body, body[1:]):
        if k in going and k in place:
            i, j = place[k]
            if after in place and place[after][0] != i:
                m, n = place[after]
                first, *rest = parts[m][n].strip().split(None, 1)
                parts[i][j] = unsigned(parts[i][j]) + first
                parts[m][n] = rest[0] if rest else ""
            else:
                marks[i].add(j)
    dropped = {i: {place[k][1] for k in drop if k in place and place[k][0] == i} for i in range(len(parts))}
    width = max((len(x) for x in page), default=0)
    out = []
    for i, (b, lines) in enumerate(zip(blocks, parts)):
        new = None if lines is None else repaired("\n".join(lines), dropped[i], marks[i], fixes, width)
        out.append(None if b is None else {**(b if isinstance(b, dict) else b.asDict()), "text": new})
    return out


def repair(pages: DataFrame, reference: list[DataFrame] | None = None) -> DataFrame:
    """(document_id, page_no, paragraphs): the text of each page as continuous readable paragraphs.

    Null texts give null, empty ones the empty string. If ``pages`` has blocks, so has the result:
    the same blocks with their texts repaired; of repeated rows one that has blocks counts.
    """
    lines, words = (cut(x) for x in analyse(pages, reference))
    key = ["document_id", "page_no"]
    none = F.lit(None).cast("string")
    marks = lines.filter("noise <> 'misread'").select(*key, "noise", "line_no", none.alias("word"), none.alias("replacement"))
    marks = marks.unionByName(words.select(*key, F.lit("misread").alias("noise"), "line_no", "word", "replacement"))
    at = lambda c: F.collect_set(F.when(c, F.col("line_no")))
    fix = F.collect_set(F.when(F.col("noise") == "misread", F.struct("word", "replacement")))
    marks = marks.groupBy(*key).agg(
        at(F.col("noise").isin("header", "page_number")).alias("drop"), at(F.col("noise") == "hyphen").alias("going"), fix.alias("fixes")
    )

    @F.pandas_udf("string")
    def mend(text: pd.Series, d: pd.Series, g: pd.Series, f: pd.Series) -> pd.Series:
        some = lambda v: v if v is not None else ()
        return pd.Series(
            [
                None if t is None else repaired(t, set(some(a)), set(some(b)), {x["word"]: x["replacement"] for x in some(c)})
                for t, a, b, c in zip(text, d, g, f)
            ]
        )

    if "blocks" not in pages.columns:
        own = pages.select(*key, "text").distinct()
    else:
        own = pages.groupBy(*key, "text").agg(F.max("blocks").alias("blocks"))
    marked = own.join(marks, key, "left")
    out = [*key, mend("text", "drop", "going", "fixes").alias("paragraphs")]
    if "blocks" in pages.columns:
        kind = pages.schema["blocks"].dataType

        @F.udf(kind, useArrow=True)
        def mend_blocks(text, blocks, d, g, f):
            if blocks is None:
                return None
            return repaired_blocks(text, blocks, set(d or ()), set(g or ()), {x["word"]: x["replacement"] for x in f or ()})

        out.append(mend_blocks("text", "blocks", "drop", "going", "fixes").alias("blocks"))
    return marked.select(*out)
