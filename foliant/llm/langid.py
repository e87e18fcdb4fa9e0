"""Language of texts and of the lines of mixed texts (problem 1).

Averaged hashed subword embeddings under a linear softmax, trained by stochastic gradient descent
in numpy on a bounded sample of labelled lines. Labels are noisy, so models of the other folds
relabel each fold before the model proper is trained; a held-out part calibrates the confidence and
sets the level under which a line is rejected and follows its text instead.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.labels import LANGUAGES, label_language
from foliant.session import ship

#: At most so many labelled lines are used to fit the model, those of the smallest hashes.
TRAIN_LINES = 8_000
BUCKETS = 1 << 16
DIMENSION = 8
EPOCHS = 4
#: A model sees at least so many lines in all, so small samples are gone through more often.
LEAST_STEPS = 8_000
RATE = 0.5
GRAMS = (2, 3, 4)
#: A line is accepted from the lowest level at which held-out lines are wrong at most so often; no
#: level lies under one half, where the other languages together are likelier.
ACCEPT_ERROR, LEVELS = 0.005, np.linspace(0.5, 0.99, 50)
#: Folds for relabelling, how often it is done, and the confidence from which a new label is kept.
FOLDS, CLEANINGS, KEEP = 3, 2, 0.5
MEMO_WORDS = 300_000

_WORD = regex.compile(r"[\p{L}\p{M}]+")
_NO_LETTER = regex.compile(r"\P{L}+")
_LINE = regex.compile(r"\r?\n")


def lines_of(text: str | None) -> list[str]:
    """The lines of a text that are not blank; a byte order mark is blank."""
    return [x for x in _LINE.split(text or "") if x.strip("﻿").strip()]


def subwords(word: str) -> list[int]:
    """Buckets of a word, its character grams and the code block of its first letter."""
    marked = f"<{word}>"
    grams = {marked, f"block {ord(word[0]) >> 7}"} | {marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)}
    return [zlib.crc32(g.encode()) & (BUCKETS - 1) for g in sorted(grams)]


def _features(line: str, memo: dict[str, list[int]]) -> np.ndarray:
    out: list[int] = []
    for w in _WORD.findall(line.lower()):
        known = memo.get(w)
        if known is None:
            known = memo[w] = subwords(w)
        out += known
    return np.array(out, np.int64)


@dataclass
class Model:
    """Scores of each bucket for each language, with calibration."""

    scores: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    accept: float = 0.0


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _train(features: list[np.ndarray], labels: np.ndarray, seed: int, epochs: int = EPOCHS) -> Model:
    rng = np.random.default_rng(seed)
    k = len(LANGUAGES)
    table = (rng.uniform(-0.5, 0.5, (BUCKETS, DIMENSION)) / DIMENSION).astype(np.float32)
    # What repeats in a line is looked up once.
    own = [(u, n.astype(np.float32)) for u, n in (np.unique(f, return_counts=True) for f in features)]
    total = np.array([len(f) for f in features], np.float32)
    out, bias = np.zeros((k, DIMENSION), np.float32), np.zeros(k, np.float32)
    epochs = max(epochs, -(-LEAST_STEPS // max(1, len(features))))
    steps = epochs * len(features)
    done, size = 0, 16
    for _ in range(epochs):
        order = rng.permutation(len(features))
        for at in range(0, len(order), size):
            rows = order[at : at + size]
            flat, often = (np.concatenate([own[i][x] for i in rows]) for x in (0, 1))
            sizes, count = np.array([len(own[i][0]) for i in rows]), total[rows]
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            mean = np.add.reduceat(table[flat] * often[:, None], starts, axis=0) / count[:, None]
            grad = _softmax(mean @ out.T + bias)
            grad[np.arange(len(rows)), labels[rows]] -= 1
            rate = np.float32(RATE * (1 - done / steps))
            back = grad @ out / count[:, None]
            out -= rate * grad.T @ mean
            bias -= rate / 10 * grad.sum(axis=0)
            by_bucket = np.argsort(flat, kind="stable")
            flat = flat[by_bucket]
            first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
            step = (np.repeat(back, sizes, axis=0) * often[:, None])[by_bucket]
            table[flat[first]] -= rate * size * np.add.reduceat(step, first, axis=0)
            done += len(rows)
    return Model((table @ out.T).astype(np.float32), bias.astype(np.float32))


def _logits(model: Model, features: np.ndarray) -> np.ndarray:
    return model.scores[features].mean(axis=0) + model.bias


def fit(lines: list[str], labels: list[str], seed: int = 7) -> Model:
    """A model of labelled lines; one fifth is held out for calibration. Needs at least one line with letters."""
    memo: dict[str, list[int]] = {}
    kept = [(f, LANGUAGES.index(y)) for f, y in ((_features(x, memo), y) for x, y in zip(lines, labels)) if len(f)]
    if not kept:
        raise ValueError("no labelled line has letters")
    features, given = [f for f, _ in kept], np.array([y for _, y in kept])
    best, sure = given.copy(), np.ones(len(given))
    if len(given) >= 10 * FOLDS:
        fold = np.array([zlib.crc32(f.tobytes()) % FOLDS for f in features])
        for _ in range(CLEANINGS):
            old = best.copy()
            for k in range(FOLDS):
                rest, own = np.flatnonzero((fold != k) & (sure > KEEP)), np.flatnonzero(fold == k)
                other = _train([features[i] for i in rest], old[rest], seed + k, 1)
                p = np.stack([_softmax(_logits(other, features[i])) for i in own])
                best[own], sure[own] = p.argmax(axis=1), p.max(axis=1)
            if (best == old).all():
                break
    clean = np.flatnonzero(sure > KEEP)
    held = clean[clean % 5 == 0]
    train = clean[clean % 5 != 0] if len(clean) > 20 else clean
    model = _train([features[i] for i in train], best[train], seed + 1)
    if len(held) < 5:
        return model
    z, y = np.stack([_logits(model, features[i]) for i in held]), best[held]
    grid = np.geomspace(0.2, 4, 40)
    loss = [-np.log(_softmax(z / t)[np.arange(len(y)), y] + 1e-9).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(z / model.temperature)
    sure, right = p.max(axis=1), p.argmax(axis=1) == y
    kept = sure >= LEVELS[:, None]
    error = (kept & ~right).sum(axis=1) / np.maximum(1, kept.sum(axis=1))
    good = np.flatnonzero(error <= ACCEPT_ERROR)
    # Where no level keeps the error low enough, the level of the least error.
    model.accept = float(LEVELS[good[0] if len(good) else int(error.argmin())])
    return model


_FITTED: dict[int, Model] = {}


def fitted(lines: list[str], labels: list[str]) -> Model:
    """``fit``, once for the same lines and labels."""
    mark = zlib.crc32("\0".join(labels).encode(), zlib.crc32("\0".join(lines).encode()))
    if mark not in _FITTED:
        _FITTED.clear()
        _FITTED[mark] = fit(lines, labels)
    return _FITTED[mark]


def training_lines(df: DataFrame, text_col: str = "text", label: Column | None = None) -> tuple[list[str], list[str]]:
    """At most TRAIN_LINES different labelled lines with letters, of the smallest hashes, in that order.

    Repeated lines count once. A first pass estimates how many different lines there are; only
    about twice as many as are needed, those under a bound on the hash, are then told apart.
    """
    own = df.select(F.col(text_col).alias("t"), (label if label is not None else label_language(F.col("lang"))).alias("y"))
    each = (
        own.filter("y is not null and t is not null")
        .select("y", F.explode(F.split("t", "\r?\n")).alias("x"))
        .filter(F.col("x").rlike(r"\p{L}"))
        .select("x", "y", F.xxhash64("x").alias("h"))
    )
    different = each.agg(F.approx_count_distinct("h").alias("n")).first()["n"]
    bound = (1 << 64) * min(1.0, 2.0 * TRAIN_LINES / max(1, different)) - (1 << 63)
    rows = each.filter(F.col("h") < F.lit(min(bound, (1 << 63) - 1)).cast("long")).distinct().orderBy("h", "x", "y").limit(TRAIN_LINES).collect()
    return [r["x"] for r in rows], [r["y"] for r in rows]


class Judge:
    """Languages of lines and texts under a model; each word is scored once."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.place: dict[str, int] = {}
        self.known = np.zeros((1024, len(LANGUAGES) + 1))

    def _places(self, line: str) -> list[int]:
        """Rows of the words of a line in the table of known words."""
        words = _WORD.findall(line.lower())
        out = [self.place.get(w, -1) for w in words]
        if -1 in out:
            for k, w in enumerate(words):
                if out[k] < 0:
                    at = self.place.get(w, -1)
                    if at < 0:
                        at = self.place[w] = len(self.place)
                        if at == len(self.known):
                            self.known = np.concatenate([self.known, np.zeros_like(self.known)])
                        f = subwords(w)
                        self.known[at, :-1], self.known[at, -1] = self.model.scores[f].sum(axis=0, dtype=np.float64), len(f)
                    out[k] = at
        return out

    def lines(self, lines: list[str]) -> list[np.ndarray | None]:
        """The probabilities of the languages of each line; null without letters."""
        if len(self.place) >= MEMO_WORDS:
            self.place.clear()
        rows = [self._places(x) for x in lines]
        full = [k for k, r in enumerate(rows) if r]
        out: list[np.ndarray | None] = [None] * len(lines)
        if full:
            sizes = np.array([len(rows[k]) for k in full])
            flat = np.fromiter((i for k in full for i in rows[k]), np.int64, int(sizes.sum()))
            total = np.add.reduceat(self.known[flat], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0)
            p = _softmax((total[:, :-1] / total[:, -1:] + self.model.bias) / self.model.temperature)
            for k, x in zip(full, p):
                out[k] = x
        return out

    def line(self, line: str) -> np.ndarray | None:
        """The probability of each language; null without letters."""
        return self.lines([line])[0]

    def texts(self, texts: list[str | None]) -> list[tuple[int, float, list[tuple[int, float, int, bool]]]]:
        """``text`` of many texts at once."""
        own = [lines_of(t) for t in texts]
        told = iter(self.lines([x for lines in own for x in lines]))
        return [self._decide([(next(told), len(_NO_LETTER.sub("", x))) for x in lines]) for lines in own]

    def text(self, text: str | None) -> tuple[int, float, list[tuple[int, float, int, bool]]]:
        """(language, confidence, [(language, confidence, letters, rejected) of each line]); -1 without letters."""
        return self.texts([text])[0]

    def _decide(self, rows: list[tuple[np.ndarray | None, int]]) -> tuple[int, float, list[tuple[int, float, int, bool]]]:
        found = [(-1 if p is None else int(p.argmax()), 0.0 if p is None else float(p.max())) for p, _ in rows]
        weight = [0] * len(LANGUAGES)
        for accepted_only in (True, False):
            for (lang, sure), (_, letters) in zip(found, rows):
                if lang >= 0 and (sure >= self.model.accept or not accepted_only):
                    weight[lang] += letters
            if any(weight):
                break
        if not any(weight):
            return -1, 0.0, [(-1, 0.0, n, False) for _, n in rows]
        follow = weight.index(max(weight))
        out, sums, trust = [], [0] * len(LANGUAGES), [0.0] * len(LANGUAGES)
        for (lang, sure), (p, letters) in zip(found, rows):
            rejected = lang >= 0 and sure < self.model.accept
            if rejected:
                lang, sure = follow, float(p[follow])
            out.append((lang, sure, letters, rejected))
            if lang >= 0:
                sums[lang] += letters
                trust[lang] += letters * sure
        main = sums.index(max(sums))
        whole = trust[main] / sums[main]
        return main, whole, [(main, whole, n, r) if lang < 0 else (lang, sure, n, r) for lang, sure, n, r in out]


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang, confidence, lines array<struct<line_no, lang, confidence, n_letters, rejected>>) for each row.

    Lines are the non-blank lines from 0. ``lang`` is the language with most letters. Null, empty
    and blank texts and texts without letters have null ``lang``, confidence 0. Lines under the
    acceptance level are ``rejected``: they take the language of their text, with the probability
    that the model gives it; lines without letters take language and confidence of their text. Other columns are left out. Rows stay rows:
    repeated ids give repeated results. Only the model (4 numbers a bucket) is broadcast.
    """
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    source = df.select(id_col, text_col)
    id_type = source.schema[id_col].dataType.simpleString()
    schema = (
        f"`{id_col}` {id_type}, lang string, confidence double, "
        "lines array<struct<line_no: int, lang: string, confidence: double, n_letters: int, rejected: boolean>>"
    )

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = Judge(shared.value)
        for batch in batches:
            rows = []
            for key, (lang, sure, each) in zip(batch[id_col], judge.texts(batch[text_col].tolist())):
                name = LANGUAGES[lang] if lang >= 0 else None
                parts = [
                    {"line_no": k, "lang": LANGUAGES[x] if x >= 0 else None, "confidence": p, "n_letters": n, "rejected": r}
                    for k, (x, p, n, r) in enumerate(each)
                ]
                rows.append((key, name, sure, parts))
            yield pd.DataFrame(rows, columns=[id_col, "lang", "confidence", "lines"])

    return source.mapInPandas(work, schema)


def label_cases(documents: DataFrame, found: DataFrame, label: Column | None = None) -> DataFrame:
    """(doc_id, line_no, lang): wrong and missing labels (line_no -1) and the lines of mixed texts."""
    named = documents.select("doc_id", (label if label is not None else label_language(F.col("lang"))).alias("named"))
    own = found.filter("lang is not null").join(named.distinct(), "doc_id")
    case = "array<struct<line_no: int, lang: string>>"
    none = F.array().cast(case)
    whole = F.when(F.col("named").isNull() | (F.col("named") != F.col("lang")), F.array(F.struct(F.lit(-1).alias("line_no"), "lang"))).otherwise(none)
    several = F.size(F.array_distinct(F.transform("lines", lambda x: x["lang"]))) > 1
    mixed = F.when(several, F.transform("lines", lambda x: F.struct(x["line_no"].alias("line_no"), x["lang"].alias("lang")))).otherwise(none)
    # Both kinds come from one pass over the texts.
    return own.select("doc_id", F.explode(F.concat(whole, mixed)).alias("x")).select("doc_id", "x.line_no", "x.lang").distinct()
