"""Variant spellings of names typed by people (problem 3).

Suffix blocking: names are indexed by the suffixes of their tokens. A suffix that too many names
share is refined by the beginning of another token, again if need be, then by a third token, and
only then is the plain suffix given up. Names equal but for the order of their tokens and the gaps
between them share a key of their own, whatever the length of the tokens. Pairs that share a key
are compared token by token with the longest-common-subsequence ratio.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.session import cut

MIN_SUFFIX = 4
#: Names in a block before its key is refined.
MAX_BLOCK = 24
#: Letters of another token by which a block is refined, step by step; at last of a third token, or of the other end.
REFINE, LAST, OWN = (1, 3, 5), 3, 2
HEAD = 5
#: Ratios, likenesses and tokens a task remembers; it changes speed, never a result.
MEMO = 400_000
#: Tokens that follow so many different houses tell a line of business, not a house.
COMMON_HOUSES = 2
ACCEPT = 0.78
#: Least ratio at which a token stands for a listed one.
COMMON_LIKE, HOUSE_LIKE = 0.75, 0.81
#: Of equally good candidates one is taken if it holds this share of the sure links to them.
PRIOR_SHARE = 0.8

# Marks of legal form and address that say nothing about who is meant.
LEGAL = frozenset(
    "limited ltd lim limted co company pvt private plc inc corp corporation and the of".split()
)
_OCR = str.maketrans("015@$", "olsas")
_ADDRESS = regex.compile(r"^\s*(m/s\.?|messrs\.?|m\.s\.)\s+", regex.I)
_TOKEN = regex.compile(r"[\p{L}\p{N}@$]+")
_TOWN = regex.compile(r"\(([^()]*)\)")


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(b):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(b)) - 1
    row = full
    for ch in a:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(b) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """2 * LCS / (sum of lengths)."""
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def is_legal(token: str) -> bool:
    return token in LEGAL or (len(token) >= 6 and ratio(token, "limited") >= 0.85)


def tokens(name: str | None) -> list[str]:
    """Lower-case tokens of a name, without accents, address and legal form; digits read as letters stand for them."""
    text = unicodedata.normalize("NFKD", name or "")
    text = "".join(ch for ch in text if not unicodedata.combining(ch))
    text = regex.sub(r"(?<=\p{L})[-'’](?=\p{L})", "", _ADDRESS.sub("", text)).lower()
    out = []
    for t in _TOKEN.findall(text):
        letters = sum(ch.isalpha() for ch in t)
        if letters < len(t) and letters >= 3 * (len(t) - letters):
            t = t.translate(_OCR)
        if not is_legal(t):
            out.append(t)
    return out


def towns(name: str | None) -> list[str]:
    """Tokens that a listed name has in brackets."""
    return [t for part in _TOWN.findall(name or "") for t in tokens(part)]


@lru_cache(200_000)
def short_for(a: str, b: str) -> bool:
    """a abbreviates b: same first letter, letters of b in order, clearly shorter."""
    if len(a) < 2 or len(a) > len(b) - 2 or a[0] != b[0]:
        return False
    rest = iter(b)
    return all(ch in rest for ch in a)


def first_keys(words: list[str], common: frozenset[str] = frozenset(), typed: bool = False) -> list[tuple[str, int, bool]]:
    """(key, place, whether it can be refined) of a name.

    ``=`` keys are the whole name, its tokens sorted or run together (place 0, never refined). Of the
    token at place i + 1: its suffixes, of which only the shortest is refined since their blocks nest,
    or the token itself (``.``) if it is shorter than a suffix. A house's token without its last
    letters (``^``, place -1 - i) is a key too, for typing errors in these; a typed token may be a
    letter longer or shorter than the listed one.
    """
    out = {("=" + " ".join(sorted(words)), 0, False), ("=" + "".join(words), 0, False)}
    for i, w in enumerate(words):
        if len(w) < MIN_SUFFIX:
            out.add(("." + w, i + 1, True))
        out |= {(w[k:], i + 1, k == len(w) - MIN_SUFFIX) for k in range(len(w) - MIN_SUFFIX + 1)}
        if len(w) > HEAD and w not in common:
            out |= {("^" + w[: max(HEAD, len(w) - HEAD + k)], -1 - i, True) for k in ((-1, 0, 1) if typed else (0,))}
    return sorted(out)


def refined_keys(words: list[str], bases: list[str]) -> list[tuple[int, str, str]]:
    """(level, key, key of the level before) of a name under its keys in crowded blocks.

    Levels 1 to 3 add the beginning of another token, one letter, three, five; level 4 adds the
    letters at the token's other end; the last the beginning of a third token, to level 3 or 4, or
    the whole other one if there is none. A single token stands for the other one itself.
    """
    out = set()
    for base in bases:
        for i, w in enumerate(words):
            if not (w.startswith(base[1:]) if base[0] == "^" else w == base[1:] if base[0] == "." else w.endswith(base)):
                continue
            others = words[:i] + words[i + 1 :] or [w]
            for j, v in enumerate(others):
                key = base
                for level, n in enumerate(REFINE, 1):
                    key, before = f"{base}|{v[:n]}", key
                    out.add((level, key, before))
                thirds = ["+" + u[:LAST] for k, u in enumerate(others) if k != j]
                own = f"{key}|{w[-OWN:] if base[0] == '^' else w[:OWN]}"
                out.add((len(REFINE) + 1, own, key))
                out |= {(len(REFINE) + 2, f"{key}|{x}", key) for x in thirds}
                out |= {(len(REFINE) + 2, f"{own}|{x}", own) for x in thirds or ["=" + v]}
    return sorted(out)


class Comparer:
    """Scores a typed name against a listed one, given the common tokens."""

    def __init__(self, common: frozenset[str]) -> None:
        self.common = common
        self.memo: dict[str, tuple[str, float]] = {}
        self.ratios: dict[tuple[str, str], float] = {}
        self.letters: dict[str, int] = {}

    def _letters(self, t: str) -> int:
        known = self.letters.get(t)
        if known is None:
            if len(self.letters) > MEMO:
                self.letters.clear()
            known = 0
            for ch in t:
                known |= 1 << (ord(ch) & 63)
            self.letters[t] = known
        return known

    def near(self, a: str, b: str, least: float) -> float:
        """The ratio of two tokens if it is at least ``least``, else 0; unlike ones are told by length and letters."""
        if a == b:
            return 1.0
        both = len(a) + len(b)
        x, y = self._letters(a), self._letters(b)
        if 2 * min(len(a) - (x & ~y).bit_count(), len(b) - (y & ~x).bit_count()) < least * both:
            return 0.0
        known = self.ratios.get((a, b))
        if known is None:
            if len(self.ratios) > MEMO:
                self.ratios.clear()
            known = self.ratios[a, b] = 2 * lcs(a, b) / both
        return known if known >= least else 0.0

    def closest(self, t: str) -> tuple[str, float]:
        """The common token that a token is, abbreviates or resembles most, and how much."""
        known = self.memo.get(t)
        if known is None:
            if t in self.common:
                known = t, 1.0
            else:
                known = max(((ratio(t, w), w) for w in self.common), default=(0.0, ""))[::-1]
            if len(self.memo) > MEMO:
                self.memo.clear()
            self.memo[t] = known
        return known

    def is_common(self, t: str) -> bool:
        word, s = self.closest(t)
        return s >= 0.8 and len(t) >= 5 or s == 1.0 or len(t) >= 3 and any(short_for(t, w) for w in self.common)

    def like(self, a: str, b: str) -> float:
        """How far a typed token stands for the common token b."""
        if a == b:
            return 1.0
        if a in self.common:
            return 0.0
        if short_for(a, b):
            return 0.96
        word, s = self.closest(a)
        return s if word == b else 0.0

    def score(self, typed: list[str], listed: list[str], optional: list[str]) -> float:
        """1 for the same words, 0 for another house or line of business; ACCEPT and more is a match."""
        if not typed or not listed:
            return 0.0
        if sorted(typed) == sorted(listed) or "".join(typed) == "".join(listed):
            return 1.0
        house = [b for b in listed if b not in self.common and b not in optional]
        if not house:  # named by lines of business alone: the first token stands for the house
            house = [b for b in listed if b not in optional][:1] or listed[:1]
        left = self._without_house(typed, house)
        if left is None:
            parted = self._parted(typed, listed)
            left = self._without_house(parted, house) if parted != typed else None
            if left is None:
                return 0.0
        rest, total = left
        weight, missing, bare = sum(map(len, house)), 0.0, len(house) == len(listed)
        for b in listed:
            if b in house:
                continue
            best, at = 0.0, -1
            for i, a in enumerate(rest):
                s = self.like(a, b) if b in self.common else self.near(a, b, COMMON_LIKE)
                if s > best:
                    best, at = s, i
            if best < COMMON_LIKE:
                missing += 0.04 if b in optional else 0.12
                bare = bare or b not in optional
                continue
            rest = rest[:at] + rest[at + 1 :]
            total, weight = total + best * len(b), weight + len(b)
        for a in rest:
            if self.is_common(a):
                return 0.0
            # Beside a bare house another word is another line of business; else it may be a place.
            missing += 0.03 if len(a) < 3 else 0.3 if bare else 0.1
        return max(0.0, total / weight - missing)

    def _without_house(self, typed: list[str], house: list[str]) -> tuple[list[str], float] | None:
        """(typed tokens left, likeness by length) once every token of the house is found, else null."""
        rest, total = list(typed), 0.0
        for b in house:
            best, at, n = HOUSE_LIKE, -1, len(b)
            for i, a in enumerate(rest):
                s = self.near(a, b, best)
                if s:
                    best, at, wide = s, i, 1
                if i + 1 < len(rest) and len(a) < n and abs(len(a) + len(rest[i + 1]) - n) <= 2:
                    s = self.near(a + rest[i + 1], b, best)
                    if s > best or at < 0 and s >= best:
                        best, at, wide = s, i, 2
            if at < 0:
                return None
            rest[at : at + wide] = []
            total += best * n
        return rest, total

    def _parted(self, typed: list[str], listed: list[str]) -> list[str]:
        """Typed tokens, those that run two listed ones together cut apart."""
        out = []
        for a in typed:
            cut_at = None
            if len(a) >= 8:
                for b, c in zip(listed, listed[1:]):
                    if abs(len(a) - len(b) - len(c)) <= 2 and self.near(a, b + c, 0.88):
                        cut_at = max(range(1, len(a)), key=lambda k: ratio(a[:k], b) + ratio(a[k:], c))
            out += [a] if cut_at is None else [a[:cut_at], a[cut_at:]]
        return out


def _words(df: DataFrame, name: str = "name") -> DataFrame:
    """``df`` with words and towns, arrays of tokens."""

    @F.pandas_udf("words array<string>, towns array<string>")
    def split(names: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"words": [tokens(x) for x in names], "towns": [towns(x) for x in names]})

    out = df.withColumn("__w", split(F.col(name)))
    return out.withColumn("words", F.col("__w.words")).withColumn("towns", F.col("__w.towns")).drop("__w")


def _first(df: DataFrame, id_col: str, common: frozenset[str], typed: bool = False) -> DataFrame:
    """(id, key, size, place, base) of names with ``words``; keys are hashed, ``base`` is the text of those that can be refined."""
    shared = df.sparkSession.sparkContext.broadcast(common)

    @F.pandas_udf("array<struct<key string, place int, base string>>")
    def make(words: pd.Series) -> pd.Series:
        return pd.Series(
            [[{"key": k, "place": p, "base": k if more else None} for k, p, more in first_keys(list(w), shared.value, typed)] for w in words]
        )

    each = df.select(id_col, F.explode(make("words")).alias("k"))
    return each.select(id_col, F.xxhash64("k.key").alias("key"), F.length("k.key").alias("size"), "k.place", "k.base")


def _refined(df: DataFrame, first: DataFrame, crowded: DataFrame, id_col: str) -> DataFrame:
    """(id, level, key, parent) of the names under their crowded keys; keys are hashed."""

    @F.pandas_udf("array<struct<level int, key string, parent string>>")
    def make(words: pd.Series, bases: pd.Series) -> pd.Series:
        return pd.Series(
            [[{"level": a, "key": k, "parent": p} for a, k, p in refined_keys(list(w), list(x))] for w, x in zip(words, bases)]
        )

    own = first.filter("base is not null").join(crowded, "key", "left_semi").groupBy(id_col).agg(F.collect_set("base").alias("bases"))
    each = df.select(id_col, "words").join(own, id_col).select(id_col, F.explode(make("words", "bases")).alias("k"))
    return each.select(id_col, "k.level", F.xxhash64("k.key").alias("key"), F.xxhash64("k.parent").alias("parent"))


def issuers(companies: DataFrame) -> DataFrame:
    """(company_id, issuer): the ordinary listing of an issuer that has two, else the id itself."""
    own = companies.filter("company_id is not null").groupBy("company_id").agg(
        F.max((F.col("series_type") == "ordinary").cast("int")).alias("ordinary"),
        F.max("alternate_isins").alias("alternate"),
    )
    link = own.select("company_id", F.explode(F.split("alternate", r"\|")).alias("other")).withColumn("other", F.trim("other"))
    both = link.unionByName(link.select(F.col("other").alias("company_id"), F.col("company_id").alias("other")))
    ranked = (
        both.join(own.select(F.col("company_id").alias("other"), F.col("ordinary").alias("o")), "other")
        .join(own.select("company_id", "ordinary"), "company_id")
        .groupBy("company_id", "ordinary")
        .agg(F.max_by("other", F.struct("o", F.col("other"))).alias("other"), F.max("o").alias("o"))
        .select("company_id", F.when((F.col("o") == 1) & (F.coalesce("ordinary", F.lit(0)) == 0), F.col("other")).alias("main"))
    )
    return own.join(ranked, "company_id", "left").select("company_id", F.coalesce("main", "company_id").alias("issuer"))


def listed_names(companies: DataFrame) -> DataFrame:
    """(issuer, name, words, towns): present and former names and short forms, once each."""
    who = issuers(companies)
    raw = companies.select(
        "company_id", F.explode(F.split(F.concat_ws("|", "canonical_name", "aliases"), r"\|")).alias("name")
    ).filter("trim(name) <> ''")
    return _words(raw.join(who, "company_id").select("issuer", F.trim("name").alias("name")).distinct()).filter("size(words) > 0")


def common_tokens(names: DataFrame) -> frozenset[str]:
    """Tokens outside brackets that tell a line of business; how many names bear them does not matter.

    A line of business follows at least COMMON_HOUSES different first tokens, more than the different
    tokens that follow itself, and is rarely first. A house is first, or follows few houses and is
    followed by its lines of business.
    """
    core = F.array_except("words", "towns")
    each = names.select(core.alias("core")).filter("size(core) > 1")
    each = each.select(F.posexplode("core").alias("at", "t"), "core")
    after = F.col("at") > 0
    told = each.groupBy("t").agg(
        F.count_distinct(F.when(after, F.get("core", F.lit(0)))).alias("houses"),
        F.count_distinct(F.get("core", F.col("at") + 1)).alias("followers"),
        F.avg(after.cast("int")).alias("later"),
    )
    told = told.filter((F.col("houses") >= COMMON_HOUSES) & (F.col("houses") > F.col("followers")) & (F.col("later") > 0.5))
    return frozenset(r["t"] for r in told.select("t").collect())


def short_forms(companies: DataFrame, names: DataFrame, common: frozenset[str]) -> DataFrame:
    """(form, issuer, score): one-word forms of a company.

    Exchange symbols score .99; symbols made up as listed ones are (beginning of the house, code of
    the business, as learnt from the listed symbols) .9; initials .8; beginnings of the house .79.
    """
    who = issuers(companies)
    given = companies.join(who, "company_id").select("issuer", F.lower(F.trim("nse_symbol")).alias("form"), "canonical_name")
    given = given.filter("form <> ''")
    word = F.array(*[F.lit(w) for w in sorted(common)]).cast("array<string>")
    full = names.filter("size(words) > 1").select(
        "issuer", "name", F.array_except("words", F.array_union(word, F.col("towns"))).alias("house"),
        F.array_join(F.array_intersect("words", word), " ").alias("business"), "words",
    )
    head = F.substring(F.get("house", F.lit(0)), 1, 4)
    codes = (
        given.join(full, "issuer")
        .filter((F.substring("form", 1, 4) == head) & (F.length("form") > 4) & F.col("form").rlike("^[a-z]+$"))
        .groupBy("business", F.expr("substring(form, 5)").alias("code"))
        .count()
        .groupBy("business")
        .agg(F.max_by("code", F.struct("count", "code")).alias("code"))
    )
    made = full.join(codes, "business").select(F.concat(head, "code").alias("form"), "issuer", F.lit(0.9).alias("score"))
    initials = full.filter("size(words) >= 3").select(
        F.array_join(F.transform("words", lambda w: F.substring(w, 1, 1)), "").alias("form"), "issuer", F.lit(0.8).alias("score")
    )
    first = F.get("house", F.lit(0))
    starts = full.filter(F.length(first) >= 6).select(
        F.explode(F.transform(F.sequence(F.lit(4), F.length(first) - 2), lambda k: F.substring(first, F.lit(1), k))).alias("form"),
        "issuer",
        F.lit(0.79).alias("score"),
    )
    return (
        given.select("form", "issuer", F.lit(0.99).alias("score"))
        .unionByName(made)
        .unionByName(initials)
        .unionByName(starts)
        .filter("length(form) > 2")
        .groupBy("form", "issuer")
        .agg(F.max("score").alias("score"))
    )


def candidates(typed: DataFrame, names: DataFrame, common: frozenset[str]) -> DataFrame:
    """(typed_id, name_id) of pairs that share a block key, once each.

    A name is indexed under the shortest suffix of each token whose block is small; where the
    shortest suffix of all is shared by too many, under its refinements, each refined again while its
    block is large. A typed name looks under all its keys. Refined keys are made only for names in
    crowded blocks. The last refinement, names alike in three tokens, is kept whole.
    """
    keys = cut(_first(names, "name_id", common))
    crowded = cut(keys.filter("place <> 0").groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > MAX_BLOCK).select("key"))
    small = keys.filter("place <> 0").join(crowded, "key", "left_anti")
    index = small.groupBy("name_id", "place").agg(F.min_by("key", "size").alias("key")).select("name_id", "key")
    index = index.unionByName(keys.filter("place = 0").select("name_id", "key"))
    deeper = cut(_refined(names, keys, crowded, "name_id"))
    large = cut(deeper.filter(F.col("level") <= len(REFINE) + 1).groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > MAX_BLOCK).select("key"))
    held = deeper.join(large.withColumn("big", F.lit(True)), "key", "left")
    reached = held.join(large.select(F.col("key").alias("parent"), F.lit(True).alias("above")), "parent", "left")
    index = index.unionByName(
        reached.filter("(level = 1 or above) and big is null").select("name_id", "key")
    ).distinct()
    probe = cut(_first(typed, "typed_id", common, True))
    probe = probe.select("typed_id", "key").unionByName(_refined(typed, probe, crowded, "typed_id").select("typed_id", "key")).distinct()
    return probe.join(index, "key").select("typed_id", "name_id").distinct()


def link_names(typed: DataFrame, companies: DataFrame, id_col: str = "label_id", name_col: str = "company") -> DataFrame:
    """(id, company_id, score): the company that each typed name means; names that mean none have no row.

    Each different spelling is compared once, however many rows use it. Null and blank names and
    names without a letter have no row. Equally good candidates are decided by the sure links to
    them, if PRIOR_SHARE of these go to one of them, else none is taken. Repeated rows of a listed
    company count once; an issuer listed twice is meant by its ordinary listing.
    """
    spark = typed.sparkSession
    use = typed.select(id_col, F.trim(name_col).alias("name")).filter("name <> ''").distinct()
    # Keys are many times the names: the names are spread before they are made.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = cut(listed_names(companies).withColumn("name_id", F.xxhash64("issuer", "name")).repartition(tasks, "name_id"))
    common = common_tokens(names)
    spelling = use.select("name").distinct().withColumn("typed_id", F.xxhash64("name")).repartition(tasks, "typed_id")
    spelling = cut(_words(spelling).filter("size(words) > 0"))
    shared = spark.sparkContext.broadcast(common)

    @F.pandas_udf("double")
    def compare(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        judge = Comparer(shared.value)
        for typed_words, words, optional in parts:
            yield pd.Series(
                [judge.score(list(a), list(b), list(o)) for a, b, o in zip(typed_words, words, optional)], dtype="float64"
            )

    pairs = (
        candidates(spelling, names, common)
        .join(spelling.select("typed_id", F.col("words").alias("typed_words")), "typed_id")
        .join(names.select("name_id", "issuer", "words", "towns"), "name_id")
    )
    fuzzy = pairs.select("typed_id", "issuer", compare("typed_words", "words", "towns").alias("score"))
    one = spelling.filter("size(words) = 1").select("typed_id", F.lower(F.get("words", F.lit(0))).alias("form"))
    raw_form = F.lower(F.regexp_replace("name", r"^\s*(?i)(m/s\.?|messrs\.?)\s+|[\s.]+", ""))
    raw = spelling.select("typed_id", raw_form.alias("form"))
    brief = one.unionByName(raw).distinct().join(short_forms(companies, names, common), "form").select("typed_id", "issuer", "score")
    best = cut(
        fuzzy.unionByName(brief)
        .filter(F.col("score") >= ACCEPT)
        .groupBy("typed_id", "issuer")
        .agg(F.max("score").alias("score"))
        .withColumn("top", F.max("score").over(Window.partitionBy("typed_id")))
        .filter("score >= top - 0.005")
        .withColumn("n", F.count("*").over(Window.partitionBy("typed_id")))
    )
    uses = use.join(spelling.select("name", "typed_id"), "name")
    sure = best.filter("n = 1").join(uses, "typed_id").groupBy("issuer").agg(F.count("*").alias("links"))
    whole = Window.partitionBy("typed_id")
    tied = (
        best.filter("n > 1")
        .join(sure, "issuer", "left")
        .withColumn("links", F.coalesce("links", F.lit(0)))
        .withColumn("all", F.sum("links").over(whole))
        .filter(F.col("links") >= PRIOR_SHARE * (F.col("all") + 1))
    )
    chosen = best.filter("n = 1").select("typed_id", "issuer", "score").unionByName(tied.select("typed_id", "issuer", "score"))
    return uses.join(chosen, "typed_id").select(id_col, F.col("issuer").alias("company_id"), "score").distinct()
