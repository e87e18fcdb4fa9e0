"""Operators for training data: worked cases, brute force, round trips, held-out accuracy."""

import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from foliant.llm import boost, consensus, encode, langid, names, ocr, pack, queries, repetition, sample, splits
from foliant.llm.labels import label_language
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, data, same, name):
    df = queries.QUERIES[name](spark, data)
    if name in queries.ORACLES:
        same(df, queries.ORACLES[name], data)
    else:
        rows = df.collect()
        assert len({str(r) for r in rows}) == len(rows)


def test_columns(spark, data):
    want = {
        "p1_found": ["doc_id", "line_no", "lang"], "p2_found": ["document_id", "presence_state"], "p3_found": ["label_id", "company_id"],
        "p4_found": ["company_id_a", "company_id_b"], "p5_found": ["document_id"], "p6_found": ["document_id", "page_no", "line_no", "noise"],
        "p7_ids": ["doc_id", "ids"], "p9_found": ["doc_id"],
    }
    for name, cols in want.items():
        assert queries.QUERIES[name](spark, data).columns == cols


# ---------------------------------------------------------------- languages

LINES = {
    "en": ["the board approved the annual budget", "our plants ran at full capacity this year", "sales of the company rose sharply"],
    "hi": ["कंपनी ने इस वर्ष उत्पादन बढ़ाया है", "बिक्री विभाग ने नया काम किया है", "company ne is varsh utpadan badhaya hai"],
    "mr": ["कंपनीने या वर्षात उत्पादन वाढवले आहे", "विक्री विभागाने नवे काम केले आहे"],
    "gu": ["કંપનીએ આ વર્ષે ઉત્પાદન વધાર્યું છે", "વેચાણ વિભાગે નવું કામ કર્યું છે"],
}


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    pairs = [(" ".join(rng.sample(x.split(), len(x.split()))), y) for y, xs in LINES.items() for x in xs for _ in range(40)]
    rng.shuffle(pairs)
    noisy = [(x, rng.choice(list(LINES)) if rng.random() < 0.15 else y) for x, y in pairs]
    return langid.fit([x for x, _ in noisy], [y for _, y in noisy])


def test_language_accuracy_under_noise(model):
    judge = langid.Judge(model)
    right = [judge.line(x).argmax() == langid.LANGUAGES.index(y) for y, xs in LINES.items() for x in xs]
    assert np.mean(right) == 1


def test_language_cases(spark, model):
    rows = [
        (1, LINES["en"][0] + "\r\n\n" + LINES["hi"][0] + "\n" + LINES["hi"][1], "en"), (2, LINES["mr"][0], "hi"), (3, LINES["gu"][0], " Gujarati "),
        (4, None, "en"), (5, "", None), (6, " \n ﻿", "xx"), (7, LINES["hi"][2], "HI"), (8, "123\n456", "en"), (9, LINES["en"][1] * 300, None),
    ]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, lang string, confidence string")
    found = langid.identify(df, model)
    by = {r.doc_id: r for r in found.collect()}
    assert by[4].lang is by[5].lang is by[6].lang is by[8].lang is None and by[4].lines == []
    assert all(0 <= x.confidence <= 1 for r in by.values() for x in r.lines)
    got = {tuple(r) for r in langid.label_cases(df, found).collect()}
    assert got == {(1, -1, "hi"), (1, 0, "en"), (1, 1, "hi"), (1, 2, "hi"), (2, -1, "mr"), (9, -1, "en")}
    assert langid.identify(df.limit(0), model).count() == 0


def test_rejected_lines_keep_their_own_probability(model):
    from dataclasses import replace

    strict = langid.Judge(replace(model, accept=1.0 + 1e-9))
    text = "\n".join((LINES["en"][0], LINES["en"][1], LINES["gu"][0]))
    main, sure, rows = strict.text(text)
    p = strict.line(LINES["gu"][0])
    assert langid.LANGUAGES[main] == "en" and all(r[3] for r in rows)
    assert rows[2][0] == main and rows[2][1] == pytest.approx(float(p[main])) and rows[2][1] < 0.5 < float(p.max())


def test_training_lines_are_different(spark, monkeypatch):
    rows = [("same line here", "en")] * 500 + [(f"line number {chr(97 + k % 26)} {k}", "en") for k in range(300)] + [(None, "en"), ("no label", None)]
    df = spark.createDataFrame(rows, "text string, lang string")
    monkeypatch.setattr(langid, "TRAIN_LINES", 100)
    lines, labels = langid.training_lines(df)
    assert len(lines) == len(set(lines)) == 100 and set(labels) == {"en"}
    assert langid.training_lines(df.repartition(7)) == (lines, labels)


def test_labels(spark):
    df = spark.createDataFrame([(x,) for x in ("EN", "en-IN", " Hindi ", "mar", "mul", "", None, "und")], "x string")
    assert [r[0] for r in df.select(label_language(F.col("x"))).collect()] == ["en", "en", "hi", "mr", None, None, None, None]


# ---------------------------------------------------------------- consensus


def votes(spark, rows):
    return spark.createDataFrame(rows, "item string, annotator string, vote string")


def test_consensus_beats_majority(spark):
    rng = random.Random(2)
    states = consensus.STATES
    rows, truth = [], {}
    for i in range(120):
        t = truth[f"d{i}"] = rng.choice(states)
        rows += [(f"d{i}", a, t if rng.random() < 0.85 else rng.choice(states)) for a in ("good1", "good2", "good3", "good4")]
        rows.append((f"d{i}", "lazy", "PRESENT"))
        copied = rng.choice(states)
        rows += [(f"d{i}", a, copied if rng.random() < 0.95 else rng.choice(states)) for a in ("copy1", "copy2")]
    items, people = consensus.consensus(votes(spark, rows))
    got = {r.item: r.consensus for r in items.collect()}
    skill = {r.annotator: r.competence for r in people.collect()}
    assert np.mean([got[i] == truth[i] for i in truth]) > 0.9
    assert min(skill[f"good{k}"] for k in (1, 2, 3, 4)) > 0.7 > 0.4 > max(skill["lazy"], skill["copy1"], skill["copy2"])


@pytest.mark.parametrize("local", [0, 10**6])
def test_consensus_by_patterns_and_by_joins(spark, monkeypatch, local):
    rng = random.Random(4)
    rows = []
    for i in range(150):
        t = rng.choice(consensus.STATES)
        rows += [(f"d{i}", f"a{k}", t if rng.random() < 0.5 + 0.05 * k else rng.choice(consensus.STATES)) for k in range(7) if rng.random() < 0.8]
        rows.append((f"d{i}", "echo", rows[-1][2]))
    df = votes(spark, rows)
    monkeypatch.setattr(consensus, "DRIVER_VOTES", local)
    items, people = consensus.consensus(df)
    monkeypatch.setattr(consensus, "MODEL_ANNOTATORS", 3)
    other, others = consensus.consensus(df)
    a, b = ({r["item"]: r.consensus for r in x.collect()} for x in (items, other))
    assert a.keys() == b.keys() and np.mean([a[k] == b[k] for k in a]) > 0.97
    a, b = ({r.annotator: r.competence for r in x.collect()} for x in (people, others))
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 0.06


def test_consensus_edges(spark):
    rows = [("a", "x", "PRESENT"), ("a", "x", "PRESENT"), ("b", "y", "odd"), (None, "x", "ABSENT"), ("c", None, "ABSENT"), ("a", "y", "PRESENT")]
    items, people = consensus.consensus(votes(spark, rows))
    row = items.collect()
    assert [(r.item, r.consensus, r.n_votes, r.agreement) for r in row] == [("a", "PRESENT", 2, 1.0)]
    empty_items, empty_people = consensus.consensus(votes(spark, rows).limit(0))
    assert empty_items.count() == empty_people.count() == 0


def test_standing_records(spark):
    sql = """SELECT * FROM VALUES ('h1','d','A',' present ',timestamp'2024-01-01'), ('h2','d','A','absent',timestamp'2024-01-02'), ('h2','d','A','absent',timestamp'2024-01-02'),
        ('h3','d','B','SKIPPED',timestamp'2024-01-01'), ('h4','d','C',NULL,NULL) AS t(record_sha256, document_id, annotator_role, presence_state, sealed_at)"""
    got = [tuple(r) for r in consensus.votes_of(spark.sql(sql)).collect()]
    assert got == [("d", "A", "ABSENT")]


# ---------------------------------------------------------------- names

COMPANIES = [
    ("C1", "Kesvedan Motors Limited", "KESVMOT|Kesvedan", None, "ordinary"), ("C2", "Trinohul Finance Limited", "Oldname Castings Ltd", None, "ordinary"),
    ("C3", "Trinohul Motors Limited", None, None, "ordinary"), ("C4", "Velmbogon Textiles Limited", None, "C5", "ordinary"),
    ("C5", "Velmbogon Textiles Ltd", None, None, "dvr"), ("C6", "Quavashatex & Jivayug Motors Limited", None, None, "ordinary"), ("C6", "Quavashatex & Jivayug Motors Limited", None, None, "ordinary"),
    ("C7", "Mirripobhai Finance (Sorvapet) Limited", None, None, "ordinary"), ("C8", "Belkerihul Textiles Limited", None, None, "ordinary"), ("C9", "Gantikant Finance Ltd", None, None, "ordinary"),
]
TYPED = {
    1: ("Kesvedan Motors Ltd.", "C1"), 2: ("M/s. KESVEDAN MTRS (LTD)", "C1"), 3: ("Motors, Kesvedan", "C1"), 4: ("kesvmot", "C1"), 5: ("Kesvdean Motors", "C1"),
    6: ("Trinohul Fin. Limted", "C2"), 7: ("Oldname Castings", "C2"), 8: ("TrinohulMotors Limited", "C3"), 9: ("Velmbogon Textiles", "C4"), 10: ("Quavashatex and Jivayug Motors", "C6"),
    11: ("Kesvedan Castings Ltd", None), 12: ("Unheard Motors Ltd", None), 13: ("", None), 14: (None, None), 15: ("?", None), 16: ("Mirripo bhai Finance Ltd", "C7"), 17: ("Be1kerihul Textiles", "C8"),
    18: ("Kesvedan Motors Ltd.", "C1"), 19: ("Kesvedan " * 400, None),
}


def test_link_names(spark):
    companies = spark.createDataFrame(
        [(c, n, a, alt, s, None) for c, n, a, alt, s in COMPANIES],
        "company_id string, canonical_name string, aliases string, alternate_isins string, series_type string, nse_symbol string",
    )
    typed = spark.createDataFrame([(k, v[0], "x") for k, v in TYPED.items()], "label_id long, company string, company_id string")
    got = {r.label_id: r.company_id for r in names.link_names(typed, companies).collect()}
    want = {k: v[1] for k, v in TYPED.items() if v[1]}
    assert {k: got.get(k) for k in TYPED if k not in (19,)} == {k: want.get(k) for k in TYPED if k not in (19,)}
    assert names.link_names(typed.limit(0), companies).count() == 0 and names.link_names(typed, companies.limit(0)).count() == 0


def _companies(spark, rows):
    return spark.createDataFrame(
        [(c, n, None, None, "ordinary", None) for c, n in rows],
        "company_id string, canonical_name string, aliases string, alternate_isins string, series_type string, nse_symbol string",
    )


def test_short_and_exact_names(spark):
    """Names of short tokens have no symbol here: they are linked as written, run together and with another word mistyped."""
    rows = [("M", "MRF Limited"), ("L", "L&T Limited"), ("A", "ABB Power Limited"), ("B", "ABB Foods Limited"), ("C", "Kes Power Limited"), ("D", "Kes Foods Ltd")]
    typed = [(1, "MRF Limited"), (2, "L&T Limited"), (3, "L & T Ltd."), (4, "mrf"), (5, "ABB Powr Ltd"), (6, "M/s Abb Foods"), (7, "ABC Limited"), (8, "Foods ABB")]
    got = names.link_names(spark.createDataFrame(typed, "label_id long, company string"), _companies(spark, rows)).collect()
    assert {r.label_id: r.company_id for r in got} == {1: "M", 2: "L", 3: "L", 4: "M", 5: "A", 6: "B", 8: "B"}


def test_crowded_blocks_are_split_to_the_end(spark):
    """A third of the listed names share house and line of business; no block but that of like names stays large."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("bcdfghklmnprst") + rng.choice("aeiou") for _ in range(4))
    towns = sorted({word() for _ in range(400)})
    listed = [(k, ["vasnomapur", "power", t]) for k, t in enumerate(towns)] + [(1000 + k, [word(), "power"]) for k in range(600)]
    typed = [(5000 + k, ["vasnomapr", "power", t]) for k, t in enumerate(towns)]
    common = frozenset({"power"})
    left = spark.createDataFrame(typed, "typed_id long, words array<string>")
    got = {tuple(r) for r in names.candidates(left, spark.createDataFrame(listed, "name_id long, words array<string>"), common).collect()}
    assert {(5000 + k, k) for k in range(len(towns))} <= got
    assert len(got) < 30 * len(towns)


def test_large_house_keeps_variants(spark):
    """A house that bears many of the names is no line of business, whatever the number of names."""
    trade = ["Motors", "Finance", "Textiles", "Castings", "Foods"]
    rows = [(f"V{k}", f"Vasnomapur {t} Limited") for k, t in enumerate(trade)]
    rows += [(f"O{k}{t}", f"{house} {t} Limited") for k, house in enumerate(("Kesvedan", "Trinohul", "Belkerihul")) for t in trade[k : k + 3]]
    rows += [("B", "Steel Motors Limited")]
    companies = spark.createDataFrame(
        [(c, n, None, None, "ordinary", None) for c, n in rows],
        "company_id string, canonical_name string, aliases string, alternate_isins string, series_type string, nse_symbol string",
    )
    common = names.common_tokens(names.listed_names(companies))
    assert common == {t.lower() for t in trade}
    typed = [(1, "Vasnomapr Finance Ltd"), (2, "M/s Vasnompaur Motrs Limited"), (3, "Vasnomapur Finanse"), (4, "Vasnomapur Housing Ltd")]
    got = {r.label_id: r.company_id for r in names.link_names(spark.createDataFrame(typed, "label_id long, company string"), companies).collect()}
    assert got == {1: "V1", 2: "V0", 3: "V1"}
    assert names.Comparer(frozenset({"steel", "motors"})).score(["steel", "motrs"], ["steel", "motors"], []) >= names.ACCEPT


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=12), st.text("abc", max_size=12))
def test_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert names.lcs(a, b) == table[-1][-1]


def test_blocks_lose_no_match(spark):
    """Every pair that brute force accepts shares a block."""
    rng = random.Random(4)
    parts = ["kes", "ve", "dan", "tri", "no", "hul", "mir", "po", "bhai", "qua", "sha", "tex", "lo", "gam"]
    trade = ["motors", "finance", "textiles", "castings", "foods"]
    listed = [(i, ["".join(rng.sample(parts, 3)), rng.choice(trade)]) for i in range(150)]
    typed = []
    for i, (k, (house, t)) in enumerate(listed):
        at = rng.randrange(1, len(house))
        typed.append((1000 + i, [house[:at] + rng.choice("xyz") + house[at + 1 :], t]))
    common = frozenset(trade)
    judge = names.Comparer(common)
    want = {(a, b) for a, x in typed for b, y in listed if judge.score(x, y, []) >= 0.9}
    left = spark.createDataFrame(typed, "typed_id long, words array<string>")
    right = spark.createDataFrame(listed, "name_id long, words array<string>")
    got = {tuple(r) for r in names.candidates(left, right, common).collect()}
    assert len(want - got) <= 0.02 * len(want)


# ---------------------------------------------------------------- splits and samples


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 60), max_size=12))
def test_differencing(weights):
    rows, load = splits.difference(weights, 8)
    assert load.sum() == sum(w * n for w, n in weights.items())
    again = np.zeros(8, int)
    for w, parts in rows.items():
        starts = sorted(parts)
        assert starts[0][0] == 0 and sum(n for _, n, _ in parts) == weights[w]
        assert all(a + n == b for (a, n, _), (b, _, _) in zip(starts, starts[1:]))
        for _, n, k in parts:
            again[k] += n * w
    assert (again == load).all()


def test_grouped_split(spark):
    rng = random.Random(5)
    rows = [(f"D{i}", f"C{i % 90}", f"{i:064x}", None) for i in range(900)] + [(f"H{i}", "HOT", f"{i + 5000:064x}", None) for i in range(300)]
    rows += [("X1", "C1", "AB" * 32, None), ("X2", "C2", " " + "ab" * 32, "HTTP://h/x.pdf?a=1"), ("X3", "C3", "0" * 64, "https://H/X.pdf#p"), ("X4", None, None, "n/a"), (None, "C9", None, None), ("D0", "C0", None, None)]
    rng.shuffle(rows)
    records = spark.createDataFrame(rows, "document_id string, company_id string, sha256 string, source_locator string")
    companies = spark.createDataFrame([("C5", "C6| C7"), ("C8", None)], "company_id string, alternate_isins string")
    pairs = {tuple(r) for r in splits.related_pairs(records, companies).collect()}
    assert pairs == {("C1", "C2"), ("C1", "C3"), ("C2", "C3"), ("C5", "C6"), ("C5", "C7"), ("C6", "C7")}
    out = splits.grouped_split(records, companies, {"FIT": 2, "VALIDATION": 1, "HOLDOUT": 1})
    got = {r.document_id: r for r in out.repartition(3).collect()}
    assert len(got) == 1204 and None not in got
    by = Counter((r.component, r.split) for r in got.values())
    assert len({c for c, _ in by}) == len(by)
    share = Counter(r.split for r in got.values())
    assert abs(share["FIT"] / 1204 - 0.5) < 0.03
    again = {r.document_id: r.split for r in splits.grouped_split(records.repartition(7), companies, {"FIT": 2, "VALIDATION": 1, "HOLDOUT": 1}).collect()}
    assert again == {k: r.split for k, r in got.items()}


def test_sample_grows_only(spark):
    rows = [(f"R{i}", f"b{i % 4}") for i in range(400)] + [("R1", "b3"), (None, "b1"), ("Q", None)]
    df = spark.createDataFrame(rows, "id string, batch string")
    first = {r.id for r in sample.frozen_batch_sample(df, "id", "batch").filter("selected").collect()}
    more = df.unionByName(spark.createDataFrame([(f"N{i}", "b9") for i in range(50)], "id string, batch string")).repartition(9)
    later = sample.frozen_batch_sample(more, "id", "batch")
    assert first < {r.id for r in later.filter("selected").collect()}
    by = {r.batch: (r.batch_size, r.quota) for r in later.collect()}
    assert by["b9"] == (50, 3) and by[None] == (1, 1)
    assert sample.frozen_batch_sample(df.limit(0), "id", "batch").count() == 0


def test_sample_keeps_members_of_a_growing_month(spark):
    schema = "document_id string, ingested_at string"
    old = [(f"R{i}", "2024-03-05" if i % 2 else None) for i in range(40)]
    first = sample.document_sample(spark.createDataFrame(old, schema).withColumn("ingested_at", F.to_timestamp("ingested_at")))
    more = old + [(f"N{i}", "2024-03-20" if i % 2 else None) for i in range(300)] + [("R1", "2020-01-01")]
    records = spark.createDataFrame(more, schema).withColumn("ingested_at", F.to_timestamp("ingested_at"))
    kept = {tuple(r) for r in first.collect()}
    got = {tuple(r) for r in sample.document_sample(records, first).collect()}
    assert kept < got and len(got) == 340 and len({r[0] for r in got}) == 340
    assert {tuple(r) for r in sample.document_sample(records, sample.document_sample(records, first)).collect()} == got


def test_error_rate_of_every_linked_label(spark, data):
    rates = {r.label_id: r.per_mille for r in queries.p3_error_rate(spark, data).collect()}
    assert set(rates) == {r.label_id for r in queries.p3_found(spark, data).collect()} and min(rates.values()) >= 0


def test_digests(spark):
    d = "0c" + "c" * 62
    given_ = [d, f" {d.upper()}\n", f"sha256:{d}", f"0x{d}", "-".join(d[i : i + 8] for i in range(0, 64, 8)), d[:60], "pending", "", None, "0cd" + "0" * 61]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(given_)], "i int, x string")
    got = [r[0] for r in df.orderBy("i").select(sample.normal_digest(F.col("x"))).collect()]
    assert got == [d] * 5 + [None] * 4 + ["0cd" + "0" * 61]
    assert sample.rate_bound("1/20") == d and sample.rate_bound("1/2") == "7" + "f" * 63


# ---------------------------------------------------------------- scanned text


def test_booster_learns():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = (x[:, 0] > 0.2) & (x[:, 1] < 0.5)
    b = boost.Booster().fit(x[:2000], y[:2000])
    assert ((b.probability(x[2000:]) > 0.5) == y[2000:]).mean() > 0.97
    assert boost.Booster().fit(np.zeros((0, 5)), np.zeros(0)).probability(np.zeros((2, 5))).max() < 0.5


def pages(spark):
    subject = ["committee", "department", "management", "subsidiary", "laboratory", "organisation"]
    verb = ["reviewed", "completed", "modernised", "expanded", "renegotiated", "streamlined"]
    thing = ["quarterly forecasts", "insurance cover", "warehouse automation", "boiler efficiency", "receivables", "inventories"]
    tail = ["energy", "capital", "lenders", "auditors", "members", "factories", "exports", "prices", "wages", "contracts", "tankers", "revenue"]
    rng = random.Random(6)
    rows = []
    for d in range(30):
        for p in range(5):
            body = [f"The {rng.choice(subject)} {rng.choice(verb)} {rng.choice(thing)} this year with {' and '.join(rng.sample(tail, 3))}." for _ in range(8)]
            if d == 0:
                body[1], body[2] = "The comrnittee rev1ewed quarterly fore-", "casts this year."
                body[5] = "The subsidiary completed pre-"
                body[6] = "and post-merger audits this year."
            head, foot = f"Alpha Number {'ABCDEFGHIJ'[d % 10]} Limited", f"Page {p + 11}"
            rows.append((f"D{d:02}", p, "\n".join([head, "", *body, foot] if d % 5 else body if d else [head, "", *body, foot]), "tesseract" if d % 5 or not d else "native"))
    return spark.createDataFrame(rows, "document_id string, page_no int, text string, engine string")


def test_scanned_text(spark):
    df = pages(spark)
    lines, words = (x.collect() for x in ocr.analyse(df))
    own = {(r.line_no, r.noise) for r in lines if r.document_id == "D00" and r.page_no == 2}
    assert own == {(0, "header"), (3, "misread"), (3, "hyphen"), (10, "page_number")}
    assert {(r.word, r.replacement) for r in words} == {("comrnittee", "committee"), ("rev1ewed", "reviewed")}
    assert not [r for r in lines if r.document_id == "D05"]
    text = {(r.document_id, r.page_no): r.paragraphs for r in ocr.repair(df).collect()}["D00", 2]
    assert "The committee reviewed quarterly forecasts this year." in text and "pre- and post-merger" in text
    assert "Page" not in text and "Alpha" not in text


def amid(spark, *lines):
    """The pages and a page 9 of D01 that has these lines from line 3 on, between whole ones."""
    whole = ["The department expanded insurance cover this year with members and prices and wages."] * 3
    df = pages(spark)
    return df.unionByName(spark.createDataFrame([("D01", 9, "\n".join([*whole, *lines, *whole]), "tesseract")], df.schema))


def test_breaks_without_sign(spark):
    """A word broken over lines whose hyphen is lost is joined; two whole words are left."""
    df = amid(spark, "The committee reviewed forec", "asts this year with lenders and wag", "es and auditors. The management", "completed boiler effi", "ciency this year.")
    got = {r.line_no for r in ocr.analyse(df)[0].collect() if r.page_no == 9 and r.noise == "hyphen"}
    assert got == {3, 4, 6}
    text = {r.page_no: r.paragraphs for r in ocr.repair(df).collect() if r.document_id == "D01"}[9]
    assert "reviewed forecasts this year" in text and "and wages and auditors. The management completed boiler efficiency this" in text


def test_misread_outside_ascii(spark):
    """Signs and letters outside ASCII are misread letters too; other scripts are left alone."""
    df = amid(spark, "The committee reviewed quarterly £orecasts this year", "with £actories and boiler e£ficiency.", "Capital of £500 with कंपनी and members.")
    lines, words = (x.collect() for x in ocr.analyse(df))
    assert {r.line_no for r in lines if r.page_no == 9 and r.noise == "misread"} == {3, 4}
    got = {(r.word, r.replacement) for r in words if r.page_no == 9}
    assert got == {("£orecasts", "forecasts"), ("£actories", "factories"), ("e£ficiency", "efficiency")}
    assert [ocr.clean_word(w) for w in ("£500", "(roo£top),", "£rom", "£.")] == ["500", "roo£top", "£rom", ""]


def test_shape_steps_read_whole_words():
    assert ocr._shape_steps("abcdefghiclx", "abcdefghidx") == (1, 0)
    assert ocr._shape_steps("rn", "m") == (1, 0) and ocr._shape_steps("", "") == (0, 0) and ocr._shape_steps("xyz", "") == (0, 3)
    assert ocr._shape_steps("l1stof", "iistot") == (3, 0)


def test_sieve_never_denies_its_own(spark):
    words = [f"word{k}" for k in range(2000)] + ["कंपनी", "£rom"]
    s = ocr.sieve(spark.createDataFrame([(w,) for w in words], "word string"))
    assert all(w in s for w in words)
    assert sum(f"other{k}" in s for k in range(2000)) < 60
    assert "x" not in ocr.sieve(spark.createDataFrame([], "word string"))


def test_headers_of_three_lines_and_misread_ones(spark):
    """A header may be deeper than two lines, and one of its letters misread on one page."""
    rng = random.Random(2)
    word = ["quarterly", "forecasts", "insurance", "cover", "warehouse", "automation", "boiler", "efficiency", "receivables", "members"]
    rows = []
    for d in range(40):
        head = [f"{'ABCDEFGH'[d % 8]}lpha Foods Limited", "Annual Report", f"Review of {'North South East West'.split()[d % 4]}"]
        for p in range(6):
            body = [" ".join(rng.choice(word) for _ in range(9)).capitalize() + "." for _ in range(10)]
            top = [x.replace("Foods", "Foocls") if d == 5 and p == 3 else x for x in head]
            rows.append((f"D{d:02}", p, "\n".join([*top, *body] if d % 4 else body), "tesseract" if d % 4 else "native"))
    df = spark.createDataFrame(rows, "document_id string, page_no int, text string, engine string")
    got = {(r.document_id, r.page_no, r.line_no) for r in ocr.analyse(df)[0].filter("noise = 'header'").collect()}
    want = {(d, p, k) for d, p, _, e in rows if e == "tesseract" for k in range(3)}
    assert got == want


def test_blocks_repaired():
    text = "Alpha Limited\n\nThe cornmittee reviewed fore-\ncasts of boiler effi\n\nciency this year.\nPage 3"
    blocks = [{"y0": float(k), "text": x} for k, x in enumerate(("Page 3", "Alpha Limited", "The cornmittee reviewed fore-\ncasts of boiler effi", "ciency this year.", None, "lost cornmittee"))]
    got = ocr.repaired_blocks(text, [*blocks, None], {0, 6}, {2, 3}, {"cornmittee": "committee"})
    assert [b and b["text"] for b in got] == ["", "", "The committee reviewed forecasts of boiler efficiency", "this year.", None, "lost committee", None]
    assert [b["y0"] for b in got[:6]] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]


def test_scanned_text_edges(spark):
    df = spark.createDataFrame([("D", 0, None, None), ("D", 1, "", "native"), (None, 0, "x", "native"), ("E", 0, "word " * 20000, None), ("E", 0, "word " * 20000, None)], "document_id string, page_no int, text string, engine string")
    assert ocr.analyse(df)[0].count() == 0 and ocr.analyse(df.limit(0))[0].count() == 0
    assert {(r.document_id, r.page_no): (r.paragraphs or "")[:4] for r in ocr.repair(df).collect()}["E", 0] == "word"


def test_page_numbers():
    for line, n in (("Page 3 of 240", 3), ("- 14 -", 14), ("[5]", 5), ("pg. 21", 21), ("7 |", 7), ("( 23 )", 23), ("Page l2", 12)):
        assert ocr.page_number(line) == n
    for line in ("2,345", "Outlook", "Annual Report 2014", "", "per cent."):
        assert ocr.page_number(line) is None


# ---------------------------------------------------------------- tokens, containers, repetition


@pytest.fixture(scope="module")
def judge():
    tiktoken = pytest.importorskip("tiktoken")
    if not Path(encode.TOKENIZER_DIR).exists():
        pytest.skip("no vocabulary here")
    sys.path.insert(0, str(Path(encode.TOKENIZER_DIR).parent))
    import importlib

    pattern = importlib.import_module(Path(encode.TOKENIZER_DIR).name).PATTERN
    ranks = encode.load_ranks()
    return encode.Encoder(ranks), tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60) | st.text("ab \n'stre", max_size=80))
def test_encode_like_the_library(judge, text):
    assert judge[0].encode(text) == judge[1].encode_ordinary(text)


def test_encode_long_and_empty(spark, judge):
    long = "ab" * 60_000
    assert judge[0].encode(long) == judge[1].encode_ordinary(long)
    df = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, "<|endoftext|> हिन्दी", 9), (3, "<|endoftext|> हिन्दी", 9)], "doc_id long, text string, ids int")
    got = [(r.doc_id, list(r.ids)) for r in encode.encode_corpus(df).orderBy("doc_id").collect()]
    assert got[:2] == [(1, []), (2, [])] and got[2] == got[3] == (3, judge[1].encode_ordinary("<|endoftext|> हिन्दी"))
    assert encode.encode_corpus(df.limit(0)).count() == 0
    assert [r.n_tokens for r in encode.token_counts(df).orderBy("doc_id").collect()][:2] == [0, 0]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_plan_holds_every_item_once(hist):
    plan = pack.plan_containers(hist, 64)
    held = Counter()
    for load, n in plan:
        assert 0 < sum(s * k for s, k in load) <= 64
        for s, k in load:
            held[s] += k * n
    assert held == hist
    total = sum(s * n for s, n in hist.items())
    assert sum(n for _, n in plan) <= max(1, 2 * -(-total // 64))


@pytest.mark.parametrize("items", [2_000, 20_000, 200_000])
def test_linear_grouping_is_tight_at_every_size(items, monkeypatch):
    rng = np.random.default_rng(3)
    sizes = np.clip(np.exp(rng.normal(5.3, 1.1, items)), 1, 2048).astype(int)
    hist = dict(Counter(sizes.tolist()))
    used, solve = [], pack.configurations
    monkeypatch.setattr(pack, "configurations", lambda *a: used.append(len(a[0])) or solve(*a))
    containers = sum(n for _, n in pack.plan_containers(hist))
    assert used and max(used) <= pack.GROUPS
    assert containers <= 1.003 * (sum(s * n for s, n in hist.items()) / 2048) + 2


def test_pack_items(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice((0, 5, 300, 700, 1300, 2048, 2049, 9000, None))) for i in range(3000)] + [(5000 + i, 700) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens int")
    got = pack.pack_items(df).collect()
    load = Counter()
    for r in got:
        load[r.container_id] += r.n_tokens
    assert max(load.values()) <= 2048
    by = Counter()
    for r in got:
        by[r.doc_id] += r.n_tokens
        assert r.part_no == 0 or dict(rows)[r.doc_id] > 2048
    assert all(by[i] == (n or 0) for i, n in rows) and len(by) == len(rows)
    used = sum(n or 0 for _, n in rows)
    assert used / (2048 * len(load)) > 0.9
    assert sorted(map(tuple, pack.pack_items(df.repartition(9)).collect())) == sorted(map(tuple, got))
    assert pack.pack_items(df.limit(0)).count() == 0


def brute(text, run=8):
    words = repetition._DROP.sub("", text or "").lower().split()
    grams = Counter(tuple(words[i : i + run]) for i in range(len(words) - run + 1))
    inside = {j for i in range(len(words) - run + 1) if grams[tuple(words[i : i + run])] > 1 for j in range(i, i + run)}
    return len(words), len(inside)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("a b c d".split()), max_size=60), st.integers(1, 9))
def test_repeated_words(words, run):
    assert repetition.repeated_words(" ".join(words), run) == brute(" ".join(words), run)


def test_repetition_cases(spark):
    base = "one two three four five six seven eight nine ten "
    rows = [(1, base * 3, "en", "s"), (2, base, "en", "s"), (3, None, None, None), (4, "", "en", "s"), (5, "12, 34. " * 50, "en", "s"), (6, "a " * 30, None, "s"),
            (7, base.upper() + "!! " + base + "x y z u v w q r s t k l m n o p h i j g f e d c b aa bb cc dd", "en", "s"), (8, (base * 3).replace("one", "One,"), "en", None)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, source string, threshold double")
    assert sorted(r.doc_id for r in repetition.repetition_cases(df, F.col("lang")).collect()) == [1, 6, 7, 8]
    assert repetition.repetition_cases(df.limit(0), F.col("lang")).count() == 0
