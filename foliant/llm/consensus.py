"""Consensus of several annotators' labels (problem 2).

Competence-and-spamming mixture: annotator j tells the truth with probability theta_j, else draws a
label from a personal guess distribution xi_j. Expectation-maximisation gives the posterior of each
item's label, theta and xi. Annotators who copy each other are found by the errors they share and
count together as one voice.

Votes are gathered once into one array per item, which no item can make longer than there are
annotators; items with the same votes are one pattern with a count, and each round of
expectation-maximisation is one pass over the patterns with the model of all annotators at hand.
Beyond MODEL_ANNOTATORS annotators, where arrays would have no bound, the same rounds run as joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.session import cut

STATES = ("PRESENT", "ABSENT", "AMBIGUOUS")
#: Rounds end when no competence and no guess changes by more than TOLERANCE.
ROUNDS, TOLERANCE = 100, 1e-4
#: Up to so many annotators an item is one array and the model (about 60 bytes each) goes to every task.
MODEL_ANNOTATORS = 512
#: Up to so many patterns (at most MODEL_ANNOTATORS votes each) the driver itself goes over them.
DRIVER_VOTES = 2_000_000
#: A model of at most so many annotators (about 60 bytes each) is broadcast.
BROADCAST_ANNOTATORS = 200_000
#: Pseudo-counts: of truths and guesses of each annotator, and of each guessed label.
PRIOR_TRUE, PRIOR_GUESS, PRIOR_LABEL = 2.0, 1.0, 1.0
#: Two annotators depend on each other if, on items both got wrong by consensus, they share the
#: wrong label at least so often, over at least so many items.
SAME_ERROR, MIN_ERRORS = 0.85, 8


def standing_records(records: DataFrame) -> DataFrame:
    """One row per (document, annotator): the record sealed last.

    Repeated rows count once. Null seal times come before all others; records sealed at the same
    time are told apart by their hash. Rows without document or annotator are left out.
    """
    last = Window.partitionBy("document_id", "annotator_role").orderBy(
        F.col("sealed_at").desc_nulls_last(), F.col("record_sha256").desc_nulls_last()
    )
    return (
        records.filter("document_id is not null and annotator_role is not null")
        .withColumn("__n", F.row_number().over(last))
        .filter("__n = 1")
        .drop("__n")
    )


def votes_of(records: DataFrame, states: tuple[str, ...] = STATES) -> DataFrame:
    """(item, annotator, vote): the standing states, without case and outer blanks; others are no vote."""
    state = F.upper(F.regexp_replace("presence_state", r"^\s+|\s+$", ""))
    own = standing_records(records).select(
        F.col("document_id").alias("item"), F.col("annotator_role").alias("annotator"), state.alias("vote")
    )
    return own.filter(F.col("vote").isin(*states))


def _total(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


def _posterior(votes: DataFrame, model: DataFrame, prior: list[Column], n: int) -> DataFrame:
    """(item, p array): the posterior of each label under the model."""
    told = votes.join(model, "annotator")
    chance = [
        F.log(F.when(F.col("v") == k, F.col("theta")).otherwise(0.0) + (1 - F.col("theta")) * F.get("xi", F.col("v")))
        for k in range(n)
    ]
    sums = told.groupBy("item").agg(*[F.sum(F.col("w") * c).alias(f"l{k}") for k, c in enumerate(chance)])
    logs = [F.col(f"l{k}") + F.log(prior[k]) for k in range(n)]
    top = F.greatest(*logs)
    raw = sums.select("item", *[F.exp(x - top).alias(f"e{k}") for k, x in enumerate(logs)])
    total = _total([F.col(f"e{k}") for k in range(n)])
    return raw.select("item", F.array(*[F.col(f"e{k}") / total for k in range(n)]).alias("p"))


def _maximise(votes: DataFrame, post: DataFrame, model: DataFrame, n: int) -> DataFrame:
    """(annotator, theta, xi, n_votes, prior sums): one maximisation step, a partial sum per annotator."""
    told = votes.join(post, "item").join(model, "annotator")
    guess = F.get("xi", F.col("v"))
    truth = F.get("p", F.col("v")) * F.col("theta") / (F.col("theta") + (1 - F.col("theta")) * guess)
    lied = [F.sum(F.when(F.col("v") == k, F.col("w") * (1 - F.col("t"))).otherwise(0.0)).alias(f"g{k}") for k in range(n)]
    sums = (
        told.withColumn("t", truth)
        .groupBy("annotator")
        .agg(F.sum(F.col("w") * F.col("t")).alias("told"), F.sum("w").alias("n_votes"), *lied)
    )
    guesses = _total([F.col(f"g{k}") for k in range(n)])
    return sums.select(
        "annotator",
        ((F.col("told") + PRIOR_TRUE) / (F.col("n_votes") + PRIOR_TRUE + PRIOR_GUESS)).alias("theta"),
        F.array(*[(F.col(f"g{k}") + PRIOR_LABEL) / (guesses + n * PRIOR_LABEL) for k in range(n)]).alias("xi"),
        "n_votes",
    )


def fit(votes: DataFrame, n: int, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(posterior, model) by expectation-maximisation over (item, annotator, v, w), by joins.

    Each round is two joins and two partial sums; the model holds one row per annotator and is
    broadcast only if there are at most BROADCAST_ANNOTATORS of them, else joined by their key.
    """
    few = votes.agg(F.approx_count_distinct("annotator").alias("n")).first()["n"] <= BROADCAST_ANNOTATORS
    sized = F.broadcast if few else (lambda x: x)
    share = votes.groupBy("item").agg(F.array(*[F.avg((F.col("v") == k).cast("double")) for k in range(n)]).alias("p"))
    start = votes.select("annotator").distinct().select(
        "annotator", F.lit(0.7).alias("theta"), F.array(*[F.lit(1.0 / n)] * n).alias("xi")
    )
    post, model, prior = share, start, [F.lit(1.0 / n)] * n
    for k in range(rounds):
        old, model = model, sized(cut(_maximise(votes, post, model, n)))
        post = _posterior(votes, model, prior, n)
        if k % 5 == 4:
            post = cut(post)
            row = post.agg(*[F.sum(F.get("p", F.lit(i))).alias(f"s{i}") for i in range(n)], F.count("*").alias("n")).first()
            if row["n"]:
                prior = [F.lit((row[f"s{i}"] + 1) / (row["n"] + n)) for i in range(n)]
            was = old.select("annotator", F.col("theta").alias("t"), F.col("xi").alias("x"))
            moved = F.greatest(F.abs(F.col("theta") - F.col("t")), F.array_max(F.zip_with("xi", "x", lambda a, b: F.abs(a - b))))
            if (model.join(was, "annotator").agg(F.max(moved).alias("d")).first()["d"] or 0.0) <= TOLERANCE:
                break
    return cut(post), model


def shared_errors(votes: DataFrame, post: DataFrame) -> DataFrame:
    """(a, b, both_wrong, same_wrong) of pairs of annotators, over items whose consensus contradicts both.

    An item holds at most one vote of each annotator, so it yields at most that many pairs squared.
    """
    best = F.array_position("p", F.array_max("p")) - 1
    wrong = votes.join(post, "item").filter(F.col("v") != best).select("item", "annotator", "v")
    a = wrong.select("item", F.col("annotator").alias("a"), F.col("v").alias("va"))
    b = wrong.select("item", F.col("annotator").alias("b"), F.col("v").alias("vb"))
    return (
        a.join(b, "item")
        .filter("a < b")
        .groupBy("a", "b")
        .agg(F.count("*").alias("both_wrong"), F.sum((F.col("va") == F.col("vb")).cast("long")).alias("same_wrong"))
    )


def discount(votes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``votes`` with weights: 1 / (1 + number of dependent annotators with the same vote on the item)."""
    linked = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = votes.select("item", "v", F.col("annotator").alias("b"))
    extra = (
        votes.select("item", "v", F.col("annotator").alias("a"))
        .join(linked, "a")
        .join(other, ["item", "v", "b"])
        .groupBy("item", F.col("a").alias("annotator"))
        .agg(F.count("*").alias("m"))
    )
    return votes.join(extra, ["item", "annotator"], "left").select(
        "item", "annotator", "v", (1.0 / (1 + F.coalesce("m", F.lit(0)))).alias("w")
    )


# ---------------------------------------------------------------- patterns of votes


@dataclass(frozen=True)
class Patterns:
    """Votes of some items: entries ``start[i]`` to ``start[i + 1]`` of annotator and vote, ``times`` items alike."""

    start: np.ndarray
    annotator: np.ndarray
    vote: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, who: pa.Array, votes: pa.Array, times: np.ndarray | None = None) -> Patterns:
        sizes = np.diff(np.asarray(who.offsets))
        start = np.concatenate([[0], np.cumsum(sizes)])
        many = np.ones(len(sizes)) if times is None else times.astype(float)
        return cls(start, np.asarray(who.flatten()), np.asarray(votes.flatten()), many)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.times)), np.diff(self.start))


@dataclass(frozen=True)
class Model:
    """theta and xi of each annotator, the share of each label, and who depends on whom."""

    theta: np.ndarray
    xi: np.ndarray
    prior: np.ndarray
    linked: np.ndarray

    @classmethod
    def first(cls, people: int, n: int) -> Model:
        return cls(np.full(people, 0.7), np.full((people, n), 1.0 / n), np.full(n, 1.0 / n), np.zeros((people, people), bool))


def weights(x: Patterns, linked: np.ndarray, n: int) -> np.ndarray:
    """Of each vote: 1 / (1 + number of dependent annotators with the same vote on the item)."""
    if not linked.any():
        return np.ones(len(x.vote))
    extra, row = np.zeros(len(x.vote)), x.row
    for k in range(n):
        at = x.vote == k
        cast = np.zeros((len(x.times), len(linked)), np.float32)
        cast[row[at], x.annotator[at]] = 1
        extra[at] = (cast @ linked)[row[at], x.annotator[at]]
    return 1 / (1 + extra)


def posterior(x: Patterns, m: Model, w: np.ndarray) -> np.ndarray:
    """The posterior of each label of each pattern."""
    n = len(m.prior)
    truth = m.theta[:, None, None] * np.eye(n)
    chance = np.log(truth + ((1 - m.theta)[:, None] * m.xi)[:, :, None])  # annotator, vote, label
    told = w[:, None] * chance[x.annotator, x.vote]
    logs = np.log(m.prior) + np.add.reduceat(told, x.start[:-1], axis=0)
    e = np.exp(logs - logs.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def sums(x: Patterns, m: Model, first: bool) -> np.ndarray:
    """Per annotator: weight of truths, of all votes, of guesses by label; in a last row the sums of posteriors."""
    people, n = m.xi.shape
    w = weights(x, m.linked, n)
    if first:
        p = np.add.reduceat(np.eye(n)[x.vote], x.start[:-1], axis=0) / np.diff(x.start)[:, None]
    else:
        p = posterior(x, m, w)
    theta, guess = m.theta[x.annotator], m.xi[x.annotator, x.vote]
    true = p[x.row, x.vote] * theta / (theta + (1 - theta) * guess)
    much = w * x.times[x.row]
    out = np.zeros((people + 1, n + 2))
    out[:people, 0] = np.bincount(x.annotator, much * true, people)
    out[:people, 1] = np.bincount(x.annotator, much, people)
    for k in range(n):
        out[:people, 2 + k] = np.bincount(x.annotator, much * (1 - true) * (x.vote == k), people)
    out[people, 2:] = x.times @ p
    return out


def errors(x: Patterns, m: Model) -> np.ndarray:
    """(annotators, annotators, 2): items whose consensus contradicts both, and on which both say the same."""
    people, n = m.xi.shape
    p = posterior(x, m, weights(x, m.linked, n))
    row = x.row
    bad = x.vote != p.argmax(axis=1)[row]
    out = np.zeros((people, people, 2))
    for k in [*range(n), None]:
        at = bad if k is None else bad & (x.vote == k)
        cast = np.zeros((len(x.times), people))
        cast[row[at], x.annotator[at]] = 1
        out[:, :, 0 if k is None else 1] += (cast * x.times[:, None]).T @ cast
    return out


def _gathered(patterns: DataFrame, local: Patterns | None, work, model: Model) -> np.ndarray:
    """The sum of ``work`` (an array of numbers) over all patterns, on the driver or over all tasks."""
    if local is not None:
        return work(local, model)
    shape = work(Patterns(np.zeros(1, int), np.zeros(0, int), np.zeros(0, int), np.zeros(0)), model).shape
    shared = patterns.sparkSession.sparkContext.broadcast(model)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for b in batches:
            if b.num_rows:
                total += work(Patterns.of(b.column(0), b.column(1), np.asarray(b.column(2))), shared.value)
        flat = total.ravel()
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(flat[at])], names=["at", "x"])

    rows = patterns.select("who", "votes", "times").mapInArrow(part, "at long, x double").groupBy("at").agg(F.sum("x").alias("x"))
    out = np.zeros(int(np.prod(shape)))
    for r in rows.collect():
        out[r["at"]] = r["x"]
    return out.reshape(shape)


def fit_patterns(patterns: DataFrame, local: Patterns | None, start: Model, rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation, one pass over the patterns a round, until nothing moves."""
    model, n = start, len(start.prior)
    for k in range(rounds):
        s = _gathered(patterns, local, lambda x, m: sums(x, m, k == 0) if len(x.times) else np.zeros((len(m.theta) + 1, n + 2)), model)  # noqa: B023
        told, votes, lied, label = s[:-1, 0], s[:-1, 1], s[:-1, 2:], s[-1, 2:]
        theta = (told + PRIOR_TRUE) / (votes + PRIOR_TRUE + PRIOR_GUESS)
        xi = (lied + PRIOR_LABEL) / (lied.sum(axis=1, keepdims=True) + n * PRIOR_LABEL)
        moved = max(np.abs(theta - model.theta).max(initial=0), np.abs(xi - model.xi).max(initial=0))
        model = replace(model, theta=theta, xi=xi, prior=(label + 1) / (label.sum() + n))
        if k and moved <= TOLERANCE:
            break
    return model


def _by_patterns(base: DataFrame, states: tuple[str, ...], names: list[str]) -> tuple[DataFrame, DataFrame]:
    """``consensus`` for few annotators: one array of votes per item."""
    spark, n, people = base.sparkSession, len(states), len(names)
    code = spark.createDataFrame([(x, i) for i, x in enumerate(names)], "annotator string, a int")
    entry = F.array_sort(F.collect_list(F.struct("a", "v")))
    item = base.join(F.broadcast(code), "annotator").groupBy("item").agg(entry.alias("e"))
    item = cut(item.select("item", F.transform("e", lambda x: x["a"]).alias("who"), F.transform("e", lambda x: x["v"]).alias("votes")))
    patterns = cut(item.groupBy("who", "votes").agg(F.count("*").alias("times")))
    held = patterns.agg(F.sum(F.size("who")).alias("n")).first()["n"] or 0
    local = None
    if 0 < held <= DRIVER_VOTES:
        t = patterns.select("who", "votes", "times").toArrow().combine_chunks()
        local = Patterns.of(*[t.column(k).chunk(0) for k in (0, 1)], t.column(2).to_numpy())
    model = Model.first(people, n)
    if held:
        model = fit_patterns(patterns, local, model)
        none = np.zeros((people, people, 2))
        both, same = np.moveaxis(_gathered(patterns, local, lambda x, m: errors(x, m) if len(x.times) else none, model), 2, 0)
        linked = (both >= MIN_ERRORS) & (same >= SAME_ERROR * both) & ~np.eye(people, dtype=bool)
        if linked.any():
            model = fit_patterns(patterns, local, replace(Model.first(people, n), linked=linked))
    shared = spark.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            x = Patterns.of(b.column(1), b.column(2))
            p = posterior(x, m, weights(x, m.linked, n))
            count = np.stack([np.bincount(x.row, x.vote == k, len(x.times)) for k in range(n)], 1)
            votes = count.sum(axis=1)
            pairs = votes * (votes - 1)
            agreement = (count * (count - 1)).sum(axis=1) / np.maximum(pairs, 1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([states[k] for k in p.argmax(axis=1)]), pa.array(p.max(axis=1)),
                 pa.array(agreement, mask=pairs == 0), pa.array(votes.astype(np.int64)), pa.array((count > 0).sum(axis=1).astype(np.int64))],
                names=["item", "consensus", "confidence", "agreement", "n_votes", "n_states"],
            )

    kind = item.schema["item"].dataType.simpleString()
    items = item.mapInArrow(judge, f"item {kind}, consensus string, confidence double, agreement double, n_votes long, n_states long")
    known = [(x, float(model.theta[i]), [float(y) for y in model.xi[i]]) for i, x in enumerate(names)]
    voices = base.groupBy("annotator").agg(F.count("*").alias("n_votes"))
    told = spark.createDataFrame(known, "annotator string, competence double, guesses array<double>")
    return items, told.join(voices, "annotator")


def consensus(votes: DataFrame, states: tuple[str, ...] = STATES) -> tuple[DataFrame, DataFrame]:
    """(items, annotators) of (item, annotator, vote).

    items: item, consensus, confidence, agreement (share of equal pairs of votes, null for a single
    vote), n_votes, n_states. annotators: annotator, competence, guesses (array in order of
    ``states``), n_votes. Votes outside ``states`` and null keys are left out; a tie goes to the
    state that comes first in ``states``. Empty votes give empty results.
    """
    code = F.array_position(F.array(*[F.lit(s) for s in states]), F.col("vote")).cast("int") - 1
    base = cut(
        votes.filter(F.col("vote").isin(*states) & F.col("item").isNotNull() & F.col("annotator").isNotNull())
        .groupBy("item", F.col("annotator").cast("string").alias("annotator"))
        .agg(F.max("vote").alias("vote"))
        .select("item", "annotator", code.alias("v"), F.lit(1.0).alias("w"))
    )
    names = [r["annotator"] for r in base.select("annotator").distinct().limit(MODEL_ANNOTATORS + 1).collect()]
    if len(names) <= MODEL_ANNOTATORS:
        return _by_patterns(base, states, sorted(names))
    return _by_joins(base, states)


def _by_joins(base: DataFrame, states: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """``consensus`` for any number of annotators."""
    n = len(states)
    post, model = fit(base, n)
    dependent = cut(
        shared_errors(base, post).filter(
            (F.col("both_wrong") >= MIN_ERRORS) & (F.col("same_wrong") >= SAME_ERROR * F.col("both_wrong"))
        )
    )
    if not dependent.isEmpty():
        base = cut(discount(base, dependent))
        post, model = fit(base, n)
    counts = [F.sum((F.col("v") == k).cast("long")) for k in range(n)]
    pairs = F.col("n_votes") * (F.col("n_votes") - 1)
    tally = base.groupBy("item").agg(
        F.count("*").alias("n_votes"),
        F.count_distinct("v").alias("n_states"),
        _total([c * (c - 1) for c in counts]).alias("equal"),
    )
    names = F.array(*[F.lit(s) for s in states])
    items = post.join(tally, "item").select(
        "item",
        F.get(names, (F.array_position("p", F.array_max("p")) - 1).cast("int")).alias("consensus"),
        F.array_max("p").alias("confidence"),
        F.when(pairs > 0, F.col("equal") / pairs).alias("agreement"),
        "n_votes",
        "n_states",
    )
    voices = base.groupBy("annotator").agg(F.count("*").alias("n_votes"))
    people = model.drop("n_votes").join(voices, "annotator").select(
        "annotator", F.col("theta").alias("competence"), F.col("xi").alias("guesses"), "n_votes"
    )
    return items, people


def span_consensus(records: DataFrame, annotators: DataFrame, items: DataFrame) -> DataFrame:
    """(item, start_page, end_page, span_spread, flags): span and flags of the documents held PRESENT.

    Pages are medians weighted by competence over standing records that say PRESENT and name the
    page; a flag stands if annotators with more than half of the competence set it. Flags are
    sorted. Documents whose consensus is another state have null pages; null flags set none.
    """
    own = standing_records(records).select(
        F.col("document_id").alias("item"),
        F.col("annotator_role").alias("annotator"),
        F.upper(F.trim("presence_state")).alias("vote"),
        "primary_span",
        "flags",
    ).join(annotators.select("annotator", "competence"), "annotator")
    weight = F.greatest(F.lit(1), F.round(F.col("competence") * 100)).cast("int")
    present = (F.col("vote") == "PRESENT") & F.col("primary_span").isNotNull()
    start, end = (F.when(present, F.col(f"primary_span.{x}")) for x in ("start_page", "end_page"))
    spans = own.groupBy("item").agg(
        F.percentile(start, 0.5, weight).alias("start_page"),
        F.percentile(end, 0.5, weight).alias("end_page"),
        (F.max(start) - F.min(start)).alias("span_spread"),
        F.sum("competence").alias("all"),
    )
    raised = (
        own.select("item", "competence", F.explode(F.array_distinct("flags")).alias("flag"))
        .groupBy("item", "flag")
        .agg(F.sum("competence").alias("for"))
        .join(spans.select("item", "all"), "item")
        .filter(F.col("for") > F.col("all") / 2)
        .groupBy("item")
        .agg(F.array_sort(F.collect_set("flag")).alias("flags"))
    )
    held = F.col("consensus") == "PRESENT"
    return (
        items.join(spans.drop("all"), "item", "left")
        .join(raised, "item", "left")
        .select(
            "item",
            *[F.when(held, F.col(c)).alias(c) for c in ("start_page", "end_page", "span_spread")],
            F.coalesce("flags", F.array().cast("array<string>")).alias("flags"),
        )
    )


def disputed(items: DataFrame) -> DataFrame:
    """(document_id, presence_state) of the items whose standing votes differ."""
    return items.filter("n_states > 1").select(F.col("item").alias("document_id"), F.col("consensus").alias("presence_state"))
