"""Operators of the training-data subpackage against brute force, on hand-made rows with the awkward cases in them."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from flowgauge.llm import chat, embeddings, hamming, language, mixing, packing, simhash, substrings, suffixes, urls
from flowgauge.llm.queries import RULES, tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, a long, pos long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed: int = 3, n: int = 60) -> list[tuple]:
    """Random texts over a few words, with copies, near copies, shared passages, repeats inside a text, and odd texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["é", "ß", "日本", "naïve"]
    passage = " ".join(rng.choices(words, k=50))
    texts: list[str | None] = [None, "", "   \n\t ", "x", "lone word", " ".join(["same"] * 70), "ab" * 400, passage]
    while len(texts) < n:
        kind, text = rng.random(), rng.choices(words, k=rng.randint(1, 120))
        if kind < 0.2 and texts[-1]:
            texts.append(rng.choice([t for t in texts if t]))
        elif kind < 0.4 and texts[-1]:
            near = rng.choice([t for t in texts if t]).split(" ")
            near[rng.randrange(len(near))] = "edit"
            texts.append(" ".join(near))
        elif kind < 0.6:
            at = rng.randint(0, len(text))
            texts.append(" ".join(text[:at]) + "\n" + passage + " " + " ".join(text[at:]))
        else:
            texts.append(rng.choice([" ", "  ", "\n"]).join(text))
    langs = ["en", "fr", None]
    return [(i * 3, t, langs[i % 3], [None, "b", "a", "hot", "hot"][i % 5], len(t or ""), i, 7) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3)


def brute_words(rows, window):
    seen, out = set(), {}
    for d, t in sorted(rows):
        w = WORD.findall(t or "")
        gone = set()
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            gone |= set(range(s, s + window)) if k in seen else set()
            seen.add(k)
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def brute_bytes(rows, length):
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            k = b[s : s + length]
            if k in seen:
                gone[s : s + length] = [True] * length
            seen.add(k)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("window", [5, 20])
def test_substrings_match_brute_force(docs, window):
    want = brute_words([(r[0], r[1]) for r in corpus()], window)
    got = {r.doc_id: r for r in substrings.remove_repeats(docs, window=window, phrase=min(6, window - 1)).collect()}
    assert {d: (r.n_words, r.n_removed, r.kept) for d, r in got.items()} == want
    texts = {r[0]: WORD.findall(r[1] or "") for r in corpus()}
    for d, r in got.items():
        # A parse: factors in order that do not overlap; one shorter than a window goes on where another ends.
        ends = [0, *(f.start + f.length for f in r.factors)]
        assert all(f.start >= end for f, end in zip(r.factors, ends[:-1], strict=True)) and r.n_removed == sum(f.length for f in r.factors)
        assert all(f.length >= window or f.start == end for f, end in zip(r.factors, ends[:-1], strict=True))
        for f in r.factors:
            assert texts[d][f.start : f.start + f.length] == texts[f.source_doc][f.source_start : f.source_start + f.length]
            assert (f.source_doc, f.source_start) < (d, f.start)


def test_substrings_keep_other_columns(docs):
    out = substrings.without_repeats(docs, window=20)
    assert out.columns == docs.columns
    want = brute_words([(r[0], r[1]) for r in corpus()], 20)
    before = {r[0]: r for r in corpus()}
    for r in out.collect():
        assert r.text == (None if before[r.doc_id][1] is None else want[r.doc_id][2])
        assert (r.lang, r.source, r.a, r.pos) == (*before[r.doc_id][2:4], *before[r.doc_id][5:])


@pytest.mark.parametrize(("length", "phrase"), [(100, 32), (20, 8)])
def test_suffixes_match_brute_force(docs, length, phrase):
    want = brute_bytes([(r[0], r[1]) for r in corpus()], length)
    got = suffixes.remove_repeats(docs, length=length, phrase=phrase).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == want
    assert all(sum(s.length for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans for r in got)


def test_suffixes_compare_across_many_buckets(spark, docs):
    got = suffixes.remove_repeats(docs, length=20, phrase=8, suffixes_each=10).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == brute_bytes([(r[0], r[1]) for r in corpus()], 20)


def test_repeated_and_null_ids(spark):
    text = " ".join(f"t{i}" for i in range(40))
    rows = spark.createDataFrame([(1, text), (1, text), (1, text + " more"), (None, text)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in substrings.remove_repeats(rows).collect())
    assert got == [(-1, 40, 0), (1, 40, 40), (1, 40, 40), (1, 41, 40)]
    assert sorted(r.n_removed > 0 for r in suffixes.remove_repeats(rows).collect()) == [False, True, True, True]


def test_many_rows_without_an_id_are_told_apart(spark):
    shared = " ".join(f"s{i}" for i in range(30))
    rows = spark.createDataFrame([(None, f"x{i} {shared} y{i}") for i in range(300)], "doc_id long, text string")
    got = [r.n_removed for r in substrings.remove_repeats(rows).collect()]
    assert sorted(got) == [0] + [30] * 299


def test_parse_is_greedy_and_does_not_overlap():
    # Two sources overlap; the later one reaches further. The third goes on after a gap.
    matches = np.array([[0, 30, 1, 0, 100], [20, 50, 2, 0, 7], [25, 45, 3, 0, 0], [60, 80, 1, 0, 400], [61, 81, 1, 0, 401]])
    assert substrings.parsed(matches, 20) == [(0, 30, 1, 0, 100), (30, 20, 2, 0, 17), (60, 21, 1, 0, 400)]
    assert substrings.parsed(matches[:0], 20) == []


def test_one_document_of_each_group_stays(spark):
    near = " ".join(f"w{i}" for i in range(200))
    rows = [
        (None, "one text of its own", 1), (None, "quite another text here", 2), (None, "the third of these texts", 3),
        (1, "first text with id one", 4), (1, "other words under the same number", 5),
        (9, near, 6), (3, near, 7), (None, near, 8), (5, "repeated row", 9), (5, "repeated row", 9), (6, "repeated row", 10), (None, None, 11), (8, "", 12),
    ]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, k1 int")).collect()
    assert kept[0].asDict().keys() == {"doc_id", "text", "k1"}
    assert sorted(r.k1 for r in kept) == [1, 2, 3, 4, 5, 7, 9, 12]


def test_heavy_keys_are_dealt_over_salts(spark):
    from pyspark.sql import functions as F

    from flowgauge.llm.common import spread_join, stored

    rows = spark.range(5000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), "id")
    facts = stored(rows.groupBy("k").agg(F.count("*").alias("n")))
    joined = spread_join(rows, facts, ["k"], "n")
    assert joined.count() == 5000 and joined.filter("n <> if(k = 7, 3333, 1)").count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "_salt" in spread_join(rows, facts, ["k"], "n")._jdf.queryExecution().toString()
        sizes = spread_join(rows, facts, ["k"], "n").groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 0.6 * 5000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_multikey_order_and_classes():
    rows = np.random.default_rng(1).integers(0, 3, (500, 21)).astype(np.uint8)
    o = suffixes.Ordered(rows)
    assert [rows[i].tobytes() for i in o.order] == sorted(r.tobytes() for r in rows)
    classes = o.classes(4)
    assert len(set(zip(classes.tolist(), [r[:4].tobytes() for r in rows], strict=True))) == len(set(classes.tolist()))


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    long = " ".join(f"word{i} déjà" for i in range(1500))
    odd = [(1000, long), (1001, "a  b"), (1002, " lead"), (1003, "trail "), (1004, "x\n y   z\x85 q　 r"), (None, "no id"), (1001, "a  b")]
    both = docs.select("doc_id", "text", "pos").unionByName(spark.createDataFrame(odd, "doc_id long, text string"), allowMissingColumns=True)
    size = 256

    def key(d):
        return -1 if d is None else d

    rows = packing.pack(both, tokenizer_path(), size=size).collect()
    want = sorted((key(d), [*tok.encode(t or "", add_special_tokens=False).ids, 0]) for d, t in [(r[0], r[1]) for r in corpus()] + odd if d != 1001)
    by_doc: dict = {}
    for r in sorted(rows, key=lambda r: (key(r.doc_id), r.start)):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        if r.doc_id != 1001:
            assert r.start == len(by_doc.setdefault(key(r.doc_id), []))
            by_doc[key(r.doc_id)] += ids
    assert sorted(by_doc.items()) == want
    assert sum(r.length for r in rows if r.doc_id == 1001) == 2 * len([*tok.encode("a  b", add_special_tokens=False).ids, 0])
    windows: dict = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == windows.get(r.sequence_id, 0)
        windows[r.sequence_id] = r.offset + r.length
    assert all(n <= size and (n == size or n & (n - 1) == 0) for n in windows.values())


def test_packer_takes_the_least_sum_of_squares():
    rng, p = random.Random(5), packing.Packer(32, 0, unit=1)
    for _ in range(600):
        n, size, levels = rng.randint(1, 31), p.size, p.levels.copy()
        costs = {}
        for h in [0, *(h for h in range(1, size - n + 1) if levels[h])]:
            after = levels.copy()
            after[h] -= h > 0
            after[h + n] += h + n < size
            costs[h] = int((after[1:size] ** 2).sum())
        assert p.place(n) == max(h for h, c in costs.items() if c == min(costs.values()))
        list(p.add((0, 0, bytes(4 * n), n)))


@pytest.mark.parametrize("unit", [1, 32])
def test_most_tokens_are_placed_by_the_sum_of_squares(unit):
    rng, p, rows = random.Random(6), packing.Packer(1024, 0, unit), []
    for i in range(3000):
        n = rng.randint(1, 1023)
        rows += p.add((i, 0, bytes(4 * n), n))
    total = sum(p.filled(w) for level in [p.nearly, *p.windows] for w in level) + sum(r[2] for r in rows)
    rows += p.rest()
    assert sum(r[2] for r in rows) == total == sum(len(r[3]) // 4 for r in rows)
    assert p.placed - p.moved > 0.8 * total  # stay where the sum of squares put them
    held: dict = {}
    for _, _, n, _, _, sequence, offset in rows:
        assert offset == held.get(sequence, 0)
        held[sequence] = offset + n
    assert sum(n != 1024 for n in held.values()) <= 10


def test_names_of_other_columns_do_not_matter(spark):
    from pyspark.sql import functions as F

    rows = [(i, f"some words here number {i} and more", "en", "s", 1, 2, 3, 4, 5) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _size int, _p int, row int, size int, copies int")
    taken = mixing.mixed_rows(df)
    assert taken.columns == df.columns and taken.count() > 0
    got = language.identify(df, language.train(df)).first()
    assert (got._p, got.row, got.lang_pred) == (2, 3, "en")
    assert substrings.without_repeats(df, window=20).filter(F.col("_size") == 1).count() == 30


def test_simhash_groups_match_brute_force(docs):
    def bits(text):
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        hs = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    rows = {r[0]: bits(r[1]) for r in corpus()}
    group = {d: d for d in rows}
    for _ in rows:
        for a in rows:
            for b in rows:
                if (rows[a] ^ rows[b]).bit_count() <= 4:
                    group[a] = group[b] = min(group[a], group[b])
    got = simhash.near_duplicates(docs, shingle=4, distance=4).collect()
    assert {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in got} == {d: (rows[d], group[d]) for d in rows}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(group.values()))


def test_simhash_links_hot_buckets_in_chunks(spark):
    rng = random.Random(2)
    base = rng.getrandbits(63)
    prints = sorted({base} | {base ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for _ in range(300)})
    got = simhash.near_groups(spark.createDataFrame([(p,) for p in prints], "fp long"), 4, chunk=16).collect()
    assert {r.fp for r in got} == set(prints)
    assert len({r.component for r in got}) == 1


def test_mixing_targets_and_limits(docs):
    size = {r[0]: len(WORD.findall(r[1] or "")) for r in corpus()}
    source = {r[0]: r[3] for r in corpus()}
    got = {r.doc_id: r for r in mixing.mix(docs, per_bucket=8).collect()}
    assert set(got) == set(size)
    sizes: dict = {}
    for d, s in source.items():
        sizes[s] = sizes.get(s, 0) + size[d]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, total, free = {}, 1.5 * sum(sizes.values()), set(order)
    while free:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        target |= {s: 2 * sizes[s] for s in over} or {s: weight[s] * level for s in free}
        free -= over or free
    taken = dict.fromkeys(order, 0)
    for d, r in got.items():
        assert (r.size, r.source_size) == (size[d], sizes[source[d]])
        assert r.target == pytest.approx(target[source[d]])
        assert r.copies in (0, 1, 2)
        taken[source[d]] += r.copies * r.size
    assert all(abs(taken[s] - target[s]) <= max(size.values()) / 2 + 1e-6 for s in order)
    again = {r.doc_id: r.copies for r in mixing.mix(docs.repartition(5), per_bucket=8).collect()}
    assert again == {d: r.copies for d, r in got.items()}
    rows = mixing.mixed_rows(docs, per_bucket=8)
    assert rows.columns == docs.columns
    counts: dict = {}
    for r in rows.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {d: c for d, c in again.items() if c}


def test_chats_round_trip(spark):
    rows = [
        (1, 1, "assistant", "b <|im_end|> <\\| <\\\\| <|x"), (1, 0, "user", "<|im_start|>user\nhi"), (2, 0, "assistant", "first"), (2, 1, "user", None),
        (3, 0, None, "who"), (None, 0, "user", "no id"), (4, 0, "odd\nrole <|", "t"), (5, 0, "user", "tie"), (5, 0, "user", "tie"), (5, None, "system", "s"),
        (6, 0, "user", "q"), (6, 1, "assistant", "ends with <"), (6, 2, "user", "q"), (6, 3, "assistant", "\\| starts so"),
    ]
    df = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, formatted long")
    from pyspark.sql import functions as F

    out = chat.format_chats(df).select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.learned_texts(F.col("segments")).alias("learned"))
    got = {r.conv_id: r for r in out.collect()}
    for c in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c))
        assert [(t.role, t.text) for t in got[c].turns] == [(t[2], t[3]) for t in turns]
        assert got[c].learned == [t[3] for t in turns if t[2] == "assistant"]
        assert got[c].formatted.count("<|im_start|>") == len(turns)
        assert "".join(s.text for s in got[c].segments) == got[c].formatted
    assert (got[1].state, got[1].first_bad_turn) == ("assistant", None)
    assert (got[2].state, got[2].first_bad_turn) == ("broken", 0)
    assert (got[5].state, got[5].first_bad_turn) == ("broken", 2)


def test_url_verdicts(spark):
    given = {
        "http://WWW.example.com/en/x": ("www.example.com/en/", "allow"), "https://a.example.com/en/1?q=/fr/": ("example.com/en/", "block"),
        "http://x.net/es/": ("net/es/", "block"), "http://x.net/eso": (None, "allow"), "http://com": (None, "allow"), "http://b.com/": ("com/", "allow"),
        "http://notexample.com/en/": ("com/", "allow"), "no scheme/en/": (None, "allow"), "": (None, "allow"), "http://y.net?x=/fr/": (None, "allow"),
        "http://y.net/fr/#top": ("net/fr/", "block"), "http://zcom/": (None, "allow"),
    }
    rows = [(i, u, 5) for i, u in enumerate(given)] + [(99, None, 5), (0, next(iter(given)), 5)]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, host long"), RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.rule, r.verdict) == (given[rows[r.page_id][1]] if r.page_id < 99 else (None, "allow"))


def test_cascade_is_exact_with_poor_filters(spark):
    listed = spark.createDataFrame([(f"k{i}",) for i in range(0, 3000, 7)], "key string")
    universe = spark.createDataFrame([(f"k{i}",) for i in range(3000)], "key string")
    cascade = urls.build_cascade(listed, universe, rate=0.4)
    assert len(cascade.levels) > 2
    from pyspark.sql import functions as F

    got = {r.key: r.l for r in universe.select("key", cascade.listed(F.col("key")).alias("l")).collect()}
    assert got == {f"k{i}": i % 7 == 0 for i in range(3000)}


def test_cascade_follows_the_list_without_a_limit(spark):
    from pyspark.sql import functions as F

    # Far more listed keys than one bitmap of 32768 bits can hold: several bitmaps make up a level.
    key = F.concat(F.lit("host"), F.col("id")).alias("key")
    listed, universe = spark.range(0, 200_000, 2).select(key), spark.range(300_000).select(key)
    cascade = urls.build_cascade(listed, universe)
    wrong = spark.range(300_000).withColumn("key", key).filter(cascade.listed(F.col("key")) != ((F.col("id") < 200_000) & (F.col("id") % 2 == 0)))
    assert cascade.levels[0].n_bits > 4 * 32768
    assert wrong.count() == 0


def test_cascade_does_not_grow_with_the_universe(spark):
    from pyspark.sql import functions as F

    listed = spark.range(100).select(F.concat(F.lit("a"), F.col("id")).alias("key"))
    bits = []
    for n in (10_000, 160_000):
        universe = spark.range(n).select(F.concat(F.lit("b"), F.col("id")).alias("key"))
        cascade = urls.build_cascade(listed, universe)
        bits.append(sum(level.n_bits for level in cascade.levels))
        assert universe.filter(cascade.listed(F.col("key"))).isEmpty()
        assert listed.filter(~cascade.listed(F.col("key"))).isEmpty()
    assert bits[1] < 2 * bits[0]  # four halvings more for a universe sixteen times as large


def test_cascade_of_nothing(spark):
    from pyspark.sql import functions as F

    none, some = spark.createDataFrame([], "key string"), spark.createDataFrame([("a",)], "key string")
    assert some.filter(urls.build_cascade(none, some).listed(F.col("key"))).isEmpty()
    assert some.filter(urls.build_cascade(some, none).listed(F.col("key"))).count() == 1


def brute_vectors(rows, least=0.95):
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)]
    links = {i: set() for i, _ in rows}
    for i, a in good:
        for j, b in good:
            if i != j and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                links[i].add(j)
    component = {i: i for i in links}
    for _ in links:
        for i in links:
            component[i] = min([component[i], *(component[j] for j in links[i])])
    return {i: (len(links[i]), component[i]) for i in links}


@pytest.mark.parametrize("leaf_rows", [4096, 12])
def test_vectors_match_brute_force(spark, leaf_rows):
    rng = np.random.default_rng(4)
    rows: list = [(1, None), (2, [0.0] * 16), (3, [float("nan")] + [1.0] * 15), (4, [None] + [1.0] * 15), (5, [1.0, 2.0]), (6, [2.0, 4.0]), (7, [])]
    for i in range(10, 90):
        v = rng.standard_normal(16)
        rows.append((i, v.tolist()))
        for k in range(rng.integers(0, 4)):
            rows.append((i + 100 * (k + 1), (v * rng.uniform(0.5, 2) + rng.standard_normal(16) * 0.12 * k).tolist()))
    # A dense group, links close to the limit, and equal vectors.
    center = rng.standard_normal(16)
    rows += [(600 + i, (center + rng.standard_normal(16) * 0.2).tolist()) for i in range(60)] + [(700 + i, rows[40][1]) for i in range(30)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, v long")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(df, leaf_rows=leaf_rows).collect()}
    assert got == brute_vectors(rows)


def test_vectors_with_null_and_repeated_ids(spark):
    rows = [(None, [1.0, 0.0]), (None, [1.0, 0.01]), (7, [1.0, 0.0]), (7, [0.0, 1.0]), (7, None), (None, None)]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [(None, 2, 7), (None, 2, 7), (7, 2, 7), (7, 0, 7), (7, 0, 7), (None, 0, None)]))


def test_trees_grow_with_the_vectors_and_lose_no_pair():
    rng = np.random.default_rng(9)
    compared = []
    for n in (1000, 4000):
        q = embeddings.in_bytes(embeddings.rotated(rng.standard_normal((n, 64))))[0][:, :8]
        radius2 = embeddings.reach(64, 8, 0.95)[0]
        tree = embeddings.fit_tree(q.astype(np.int64), 1.0, n // 8, radius2)
        seen, met = [0], set()
        for _, rows, guest in embeddings.route(tree, q, np.arange(n), np.zeros((n, 8)), np.zeros(n, bool), radius2):
            for a, b in embeddings.meetings(q[rows], ~guest, np.zeros(len(rows), bool), radius2, seen):
                pairs = [tuple(sorted(p)) for p in zip(rows[a].tolist(), rows[b].tolist(), strict=True)]
                assert len(met) + len(pairs) == len(met := met | set(pairs))  # each pair meets once in a block
        far = ((q[:, None].astype(int) - q[None].astype(int)) ** 2).sum(axis=2) if n == 1000 else None
        if far is not None:
            assert met == {(i, j) for i, j in zip(*np.nonzero(far <= radius2), strict=True) if i < j}
        compared.append(seen[0] / n / n)
    assert compared[1] < compared[0]


def test_nearest_codes_match_brute_force(spark):
    rng = random.Random(6)
    codes = [(i, rng.getrandbits(16)) for i in range(200)] + [(i, 77) for i in range(200, 230)]
    index = spark.createDataFrame([*codes, (None, 5), (999, None)], "id long, code long")
    queries = index.filter("id % 20 = 0").withColumnRenamed("id", "query_id")
    got = sorted((r.query_id, r["rank"], r.id, r.distance) for r in hamming.nearest(index, queries, k=5, bits=16, segments=2).collect())
    want = []
    for q, c in codes:
        if q % 20 == 0:
            near = sorted(((c ^ d).bit_count(), i) for i, d in codes if i != q)[:5]
            want += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    assert got == sorted(want)


def test_language(spark):
    vocabulary = {"en": "the of and house tree this with", "de": "der die und haus baum nicht mit", "fr": "le la et maison arbre avec été", "es": "el la y casa árbol con niño"}
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(vocabulary[k].split(), k=30)), k, 1) for i in range(300) for k in [list(vocabulary)[i % 4]]]
    rows += [(1000, None, "en", 1), (1001, "12 34 !", "en", 1), (1002, "", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    from pyspark.sql import functions as F

    model = language.train(df.filter(~language.held_out(F.col("doc_id"))))
    out = language.identify(df, model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = out.collect()
    held = [r for r in got if r.doc_id < 1000]
    assert sum(r.lang_pred == r.lang for r in held) > 0.97 * len(held)
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id >= 1000)
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in language.identify(df, None).collect()} == {"und"}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    assert packing.pack(docs, tokenizer_path()).count() == 0
    assert substrings.remove_repeats(docs).count() == 0
    assert suffixes.remove_repeats(docs).count() == 0
    assert simhash.near_duplicates(docs).count() == 0
    assert mixing.mix(docs).count() == 0
    assert language.train(docs) is None
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), RULES).count() == 0
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    none = spark.createDataFrame([], "id long, code long")
    assert hamming.nearest(none, none.withColumnRenamed("id", "query_id")).count() == 0


def test_pipeline_stages_take_effect(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame(corpus(), DOCS).drop("a", "pos").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    before = {r[0]: r for r in corpus()}
    (_, identify), (_, near), (_, cut), (_, mix), (_, pack) = corpus_pipeline.STAGES
    one = identify(spark, docs, str(tmp_path))
    assert {r.doc_id for r in one.collect()} == {d for d, r in before.items() if r[1] and re.search(r"[^\W\d_]", r[1])}
    two = near(spark, one, str(tmp_path))
    three = cut(spark, two, str(tmp_path))
    left = {r.doc_id: r.text for r in two.collect()}
    want = brute_words(list(left.items()), 20)
    assert {r.doc_id: r.text for r in three.collect()} == {d: w[2] for d, w in want.items()}
    four = mix(spark, three, str(tmp_path))
    assert one.columns == two.columns == three.columns == four.columns == docs.columns
    ids = pack(spark, four, str(tmp_path)).groupBy("doc_id").sum("length").collect()
    assert {r.doc_id for r in ids} == {r.doc_id for r in four.collect()}
    # Run as a whole: the pieces are the ids of the same texts, gapless.
    whole = corpus_pipeline.run(spark, str(tmp_path)).groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r.doc_id for r in whole} == {r.doc_id for r in four.collect()}
    assert all(r["sum(length)"] % r["max(doc_tokens)"] == 0 for r in whole)


def test_pipeline_with_null_and_repeated_ids(spark, tmp_path):
    import corpus_pipeline

    texts = [(None, "one text without an id"), (None, "another text without one"), (4, "shared number first"), (4, "shared number second text"), (5, "left alone here")]
    rows = [(i, t, "en", "s", len(t), 1) for i, t in texts]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp int").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
        assert sorted(((r.doc_id or -1), r.text) for r in docs.collect()) == sorted(((i or -1), t) for i, t in texts)


def test_language_sample_is_bounded_in_all(spark, monkeypatch):
    learned = []
    monkeypatch.setattr(language, "train_svm", lambda x, y: learned.append(len(y)) or np.zeros(x.shape[1] + 1))
    docs = spark.createDataFrame([(i, f"word {i} of text", f"x{i % 3}") for i in range(90)], "doc_id long, text string, lang string")
    language.train(docs, per_language=20, most_rows=30)
    assert learned == [20, 20, 20]  # three families of ten rows each, two by two
    learned.clear()
    language.train(docs, per_language=7, most_rows=30)
    assert learned == [14, 14, 14]
    learned.clear()
    language.train(docs, most_rows=1)
    assert learned == [2, 2, 2]


def test_language_sample_reaches_the_driver_packed(spark, monkeypatch):
    """The sample's vectors have 8192 buckets of four bytes, most of them empty: the driver gets a fraction of that, and learns the same."""
    from pyspark.sql.classic.dataframe import DataFrame

    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["der", "und", "haus"] if i % 2 else ["the", "and", "house"], k=40)), "de" if i % 2 else "en") for i in range(60)]
    got, collect = [], DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toArrow", lambda df: got.append(collect(df)) or got[-1])
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert got[0].num_rows == 60 and got[0].nbytes < 60 * language.BUCKETS * 4 / 10
    assert [model.predict(t)[0] for t in (b"the house and the house", b"das haus und der hund")] == ["en", "de"]
