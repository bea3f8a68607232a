"""Vector codes, toxicity scores and ranked search against brute force and held-out accuracy."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowgauge.llm import codebooks, lexical, toxicity

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_codes(rows, parts, entries, rounds, steps):
    """One vector after another, with plain integers."""
    kept = [(i, [math.floor(x * steps) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dim = len(kept[0][1])
    width = dim // parts
    cut = lambda v: [tuple(v[p * width : (p + 1) * width]) for p in range(parts)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v)[p] for _, v, _ in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda part, book: min(range(len(book)), key=lambda e: (far(part, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            groups: dict[int, list] = {}
            for _, v, _ in kept:
                groups.setdefault(nearest(cut(v)[p], books[p]), []).append(cut(v)[p])
            for e, members in groups.items():
                books[p][e] = tuple(sum(c) // len(members) for c in zip(*members, strict=True))
    out = []
    for i, v, label in kept:
        code = [nearest(part, book) for part, book in zip(cut(v), books, strict=True)]
        out.append((i, code, sum(far(part, book[e]) for part, book, e in zip(cut(v), books, code, strict=True)), label))
    total = Counter()
    for *_, error, label in out:
        total[label] += error
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted(((i, code, error, total[label]) for i, code, error, label in out), key=repr), digest


VECTORS = "vec_id long, embedding array<float>, label int, error int, code string"


def vectors(n=300, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i * 2, [float(np.float32(x)) for x in rng.standard_normal(dim) * 0.2], int(rng.integers(0, 3)) if i % 5 else None) for i in range(n)]
    rows += [rows[3], rows[3], (None, rows[4][1], 1), (1, None, 1), (3, [None] * dim, 1), (5, [float("nan")] * dim, 1), (7, [float("inf")] * dim, 1)]
    return rows + [(9, [0.5] * dim, 0)] * (n // 2)  # a group of copies with a third of the rows


def test_codes_match_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS).repartition(5)
    codes, books = codebooks.encode(df, parts=4, entries=8, rounds=3)
    got = sorted(((r.vec_id, r.code, r.error, r.label_error) for r in codebooks.with_label_error(codes).collect()), key=repr)
    assert (got, books.sha256()) == brute_codes(rows, 4, 8, 3, 4096)


def test_codes_of_odd_tables(spark):
    none, books = codebooks.encode(spark.createDataFrame([(1, None, 2, 1, "x")], VECTORS))
    assert none.count() == 0 and books.entries == ((),) * 8
    rows = [(1, [1.0] * 8, 1, 0, ""), (2, [2.0] * 8, 1, 0, ""), (3, [1.0], 1, 0, ""), (4, [], None, 0, ""), (5, [1e30] * 8, 1, 0, "")]
    codes, books = codebooks.encode(spark.createDataFrame(rows, VECTORS))
    got = {r.vec_id: r for r in codebooks.with_label_error(codes).collect()}
    assert got.keys() == {1, 2, 3, 4, 5} and got[3].code is None and got[4].error is None
    assert got[1].error == got[2].error == got[5].error == 0 and got[5].code == [2] * 8
    assert len(books.entries[0]) == 3 and books.entries[0][2] == (codebooks.LARGEST,)


def test_part_distances_are_those_of_the_integers():
    rng = np.random.default_rng(2)
    x, entries = rng.integers(-9, 9, (50, 3)), [tuple(e) for e in rng.integers(-9, 9, (4, 3)).tolist()]
    values, codes = zip(*(np.unique(c, return_inverse=True) for c in x.T), strict=True)
    got = codebooks.part_distances(list(values), np.stack(codes, axis=1), tuple(entries), 0)
    assert (got == ((x[:, None] - np.array(entries)[None]) ** 2).sum(axis=2)).all()


def labelled(n=900, seed=3):
    rng = random.Random(seed)
    words, bad = [f"word{i}" for i in range(300)], ["grok", "zed", "vile"]
    docs, labels = [], []
    for i in range(n):
        text, toxic = rng.choices(words, k=rng.randint(3, 80)), i % 8 == 0
        for _ in range(rng.randint(2, 4) if toxic else 0):
            text.insert(rng.randint(0, len(text)), rng.choice(bad).upper() if i % 3 else rng.choice(bad))
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(text), "en", i, 1.0))
        if i % 10:
            labels.append((i, int(toxic)))
    docs += [(5000, None, None, 0, 1.0), (5001, "", None, 0, 1.0), (5002, " ?! \x00", None, 0, 1.0), (None, "grok zed vile", None, 0, 1.0), (8, docs[8][1], "en", 8, 1.0)]
    return docs, [*labels, (None, 1), (5001, None), (777777, 1), (16, 0), (16, 1)]


def test_scores_find_toxic_texts_of_the_fold_left_out(spark):
    docs, labels = labelled()
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, h long, score double").repartition(4)
    ls = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(df, ls.filter(~toxicity.held_out(F.col("doc_id"))))
    out = toxicity.score(df, model)
    assert out.columns == df.columns and out.count() == len(docs)
    truth = {i: i % 8 == 0 for i in range(900)}
    got = {r.doc_id: r.score for r in toxicity.score(df.filter(toxicity.held_out(F.col("doc_id"))), model).collect() if r.doc_id in truth}
    assert len(got) > 200 and sum((s >= 0.7) == truth[i] for i, s in got.items()) > 0.97 * len(got)
    odd = {r.doc_id: r.score for r in out.filter("doc_id >= 5000 OR doc_id IS NULL").collect()}
    assert odd[5000] == odd[5001] == odd[5002] < 0.7 <= odd[None]
    assert len(model.at) < 2000 and (model.weight != 0).all()  # sparse
    again = toxicity.train(df.repartition(7), ls.filter(~toxicity.held_out(F.col("doc_id"))).repartition(2))
    assert (again.at == model.at).all() and (again.weight == model.weight).all() and again.bias == model.bias


def test_scores_without_labels(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int")) is None
    assert [r.score for r in toxicity.score(docs, None).collect()] == [0.0]


def test_features_are_words_neighbours_and_skips():
    texts = ["Ab, cd ef ab", "", "x" * 3_000_000, "a b " * 600_000, "é1"]
    found = list(toxicity.features(pa.array([t.encode() for t in texts], pa.binary())))
    assert [len(f) for f in found] == [3 + 3 + 2, 0, 1, 2 + 2 + 2, 1]
    assert (found[0] == list(toxicity.features(pa.array([b"AB cd--EF\tab"], pa.binary())))[0]).all()


def test_ftrl_steps_match_the_formula():
    rates = toxicity.Rates(alpha=0.5, beta=1.0, l1=0.1, l2=0.2)
    z, n, w = np.zeros(toxicity.BIAS + 1), np.zeros(toxicity.BIAS + 1), {}
    zs, ns = Counter(), Counter()
    for found, y in (([3, 5], 1), ([5], 0), ([3], 1), ([3, 5], 1)):
        rates.learn(z, n, np.array(found), y)
        for i in (*found, toxicity.BIAS):
            l1, l2 = (0, 0) if i == toxicity.BIAS else (rates.l1, rates.l2)
            w[i] = 0.0 if abs(zs[i]) <= l1 else -(zs[i] - math.copysign(l1, zs[i])) / ((rates.beta + math.sqrt(ns[i])) / rates.alpha + l2)
        g = 1 / (1 + math.exp(-sum(w[i] for i in (*found, toxicity.BIAS)))) - y
        for i in (*found, toxicity.BIAS):
            zs[i] += g - (math.sqrt(ns[i] + g * g) - math.sqrt(ns[i])) / rates.alpha * w[i]
            ns[i] += g * g
    assert np.allclose([z[i] for i in zs], list(zs.values())) and np.allclose([n[i] for i in ns], list(ns.values()))


def brute_rank(docs, items, k):
    held = [(d, Counter(TERM.findall(re.sub("[A-Z]", lambda c: c.group().lower(), t or "")))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        asked = set(TERM.findall(re.sub("[A-Z]", lambda c: c.group().lower(), text or "")))
        scores = []
        for d, c in held:
            m = 10 + 90 * c.total() * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def texts(n=700, seed=5):
    rng = random.Random(seed)
    words = [f"t{i}" for i in range(60)] + [f"Rare{i}" for i in range(400)] + ["é", "日本", "E"]
    weights = [400 / (i + 1) for i in range(60)] + [0.5] * 400 + [3, 3, 9]
    docs = [(i * 3, rng.choice([" ", ", ", "\n"]).join(rng.choices(words, weights, k=rng.randint(1, 60)))) for i in range(n)]
    docs += [docs[5], docs[5], (None, docs[6][1]), (9001, None), (9002, ""), (9003, "?! \t"), (9004, "t1 Rare7 " * 5000)]
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 25)))) for i in range(25)]
    return docs, [*items, items[0], (3, "t0"), (100, None), (101, "absent"), (None, "Rare1 t2")]


@pytest.mark.parametrize(("segment", "block"), [(8192, 1 << 20), (100, 300)])
def test_search_matches_brute_force(spark, monkeypatch, segment, block):
    monkeypatch.setattr(lexical, "SEGMENT", segment)
    docs, items = texts()
    # More columns, one of them named like a column of the result.
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, score int").repartition(3)
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int")
    got = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.rank(df, asked, k=7, block_bytes=block).collect()), key=repr)
    assert got == brute_rank(docs, items, 7)


def test_search_skips_ranges_and_keeps_ties():
    rng = np.random.default_rng(6)
    n = 4000
    ids, lengths = rng.permutation(n).astype(np.int64), rng.integers(1, 200, n)
    postings = {0: np.arange(n), 1: np.sort(rng.choice(n, n // 2, False)), 2: np.sort(rng.choice(n, 9, False)), 3: np.arange(0, n, 7)}
    tf = {t: rng.integers(1, 4, len(d)) for t, d in postings.items()}
    term, df = np.arange(4), np.array([len(postings[t]) for t in range(4)])
    build = lambda: lexical.Segment(ids, lengths, term, df, np.concatenate([*postings.values()]), np.concatenate([*tf.values()]), n, int(lengths.sum()))
    query = [(0, 1), (1, 300), (2, 5000), (3, 900)]
    total = np.zeros(n, np.int64)
    for t, w in query:
        m = 10 + 90 * lengths[postings[t]] * n // int(lengths.sum())
        total[postings[t]] += w * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
    want = sorted(zip((-total).tolist(), ids.tolist(), strict=True))[:10]
    for short in (0.0, 1 / 16, 1.0):
        scores, found = build().search(query, 10, (np.zeros(0, np.int64), np.zeros(0, np.int64)), short)
        assert list(zip((-scores).tolist(), found.tolist(), strict=True)) == want


def test_search_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.rank(none, items).count() == 0
    assert lexical.rank(one, items.limit(0)).count() == 0
    # One document: N = df = 1, so the weight is floor(1000 * ln(4 / 3)); tf = 1 of 2 terms, m = 100.
    assert [tuple(r) for r in lexical.rank(one, items).collect()] == [(1, 1, 1, 287 * (10**9 // 1800))]
