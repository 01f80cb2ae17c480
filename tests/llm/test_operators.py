"""Operators against plain versions, and on nulls, empty and repeated rows, and empty tables."""

import collections
import hashlib
import itertools
import math
import os
import re

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from siteloom.llm import chat, common, embeddings, minhash, mixing, passages, pii, quality, queries, segmenting, sharding, toxicity

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] + str(rng.integers(40)) for i in rng.integers(len(WORDS), size=n))


def docs_of(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "en", "s", None, "clash", 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, cid string, label int, n int")


# chat


def test_chat_round_trip(spark):
    said = ["\\### Assistant: </turn> ok", "<turn user>", "\\l\\b<|image|>", "", None, "ünï\n"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(zip(itertools.cycle(["user", "assistant"]), said))] + [(None, None, None, None), (2, 0, "a>b<", "x"), (2, 0, "a>b<", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("parts", chat.text_part(F.col("text")))
    made = {r.conv_id: r for r in chat.format_chat(df).select("*", chat.parse_turns(F.col("formatted")).alias("t"), chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert [(t.role, t.body) for t in made[1].t] == [(r, t or "") for _, _, r, t in rows[:6]]
    assert made[1].loss == "".join(t or "" for _, _, r, t in rows[:6] if r == "assistant")
    assert [(t.role, t.body) for t in made[2].t] == [("a>b<", "x")] * 2 and [(t.role, t.body) for t in made[None].t] == [("", "")]
    assert chat.format_chat(df.limit(0)).count() == 0


def test_chat_parts(spark):
    parts = [("text", "look <|image|> at", None, None, None, None, None), ("image", None, "a.png", 28, 15, None, None), ("audio", None, "b.wav", None, None, 1.5, None), ("document", None, "c.pdf", None, None, None, 3), ("film", None, "d", None, None, None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    r = chat.format_chat(df).first()
    assert r.formatted == "<turn user>look \\l|image|> at<|image|><|audio|><|document|></turn>\n"
    assert [(a.kind, a.ref, a.tokens) for a in r.attachments] == [("image", "a.png", 4), ("audio", "b.wav", 38), ("document", "c.pdf", 768), ("film", "d", 0)]
    assert r.n_tokens == 3 + 4 + 38 + 768


# sharding


def test_shards_are_even_and_whole(spark):
    texts = [prose(1 + i % 50, i) for i in range(400)] + [None, "", "x" * 3000] + ["same"] * 30
    df = docs_of(spark, texts)
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 16
    rows = sharding.shard(df, {"bytes": size, "doc": F.col("doc_id"), "none": F.col("n_chars")}, size, F.col("doc_id"), 7).collect()
    assert sorted(r.key for r in rows) == list(range(len(texts)))
    by = {s: [r for r in rows if r.shard == s] for s in range(7)}
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    sums = [sum(r.weight for r in own) for own in by.values()]
    assert max(sums) - min(sums) <= 2 * 3016
    assert sharding.shard(df.limit(0), {"doc": F.col("doc_id")}, size, F.col("doc_id"), 7).count() == 0


def plain_tree(rows, shards, whole):
    """Shards of (dimensions, key, weight) rows: cut at the weighted median of the widest dimension, ties by key."""
    if shards == 1 or not rows:
        return {r: 0 for r in rows}
    extent = [(max(x) - min(x)) / max(1, w) for x, w in zip(zip(*(r[0] for r in rows)), whole)]
    d = extent.index(max(extent)) if max(extent) > 0 else None
    place = lambda r: (r[0][d] if d is not None else r[1], r[1])
    total, below, left, n = sum(r[2] for r in rows), 0, [], shards // 2
    target = total * n // shards
    for at in sorted(set(map(place, rows))):
        w = sum(r[2] for r in rows if place(r) == at)
        if below + w > target:
            if target - below > below + w - target:
                left.append(at)
            break
        below += w
        left.append(at)
    a, b = [r for r in rows if place(r) in left], [r for r in rows if place(r) not in left]
    return plain_tree(a, n, whole) | {r: s + n for r, s in plain_tree(b, shards - n, whole).items()}


@pytest.mark.parametrize("ranges", [4, 1024])
def test_shards_against_a_plain_tree(spark, monkeypatch, ranges):
    monkeypatch.setattr(sharding, "RANGES", ranges)
    rng = np.random.default_rng(11)
    rows = [((int(rng.integers(5)), int(rng.integers(1000)), 7), i, int(rng.integers(1, 60))) for i in range(120)]
    df = spark.createDataFrame([(*d, k, w) for d, k, w in rows], "a long, b long, c long, k long, w long")
    got = {r.key: r.shard for r in sharding.shard(df, {x: F.col(x) for x in "abc"}, F.col("w"), F.col("k"), 11).collect()}
    whole = [max(x) - min(x) for x in zip(*(r[0] for r in rows))]
    assert got == {r[1]: s for r, s in plain_tree(rows, 11, whole).items()}


def test_shards_of_null_and_repeated_rows(spark):
    rows = [(1, 5, "a"), (1, 5, "b"), (1, 5, "a"), (None, None, None), (None, 3, "c"), (2, 4, None)]
    df = spark.createDataFrame(rows, "k long, w long, t string")
    made = sharding.shard(df, {"w": F.col("w")}, F.col("w"), F.col("k"), 3, {"t": F.col("t")}).collect()
    assert sorted(((r.key, r.weight, r.t) for r in made), key=str) == sorted(rows, key=str)
    assert len({r.shard for r in made if r.key == 1}) == 1
    for s in {r.shard for r in made}:
        assert sorted(r.slot for r in made if r.shard == s) == list(range(sum(r.shard == s for r in made)))


# toxicity


def brute_segments(s):
    """Best segment first, then the same to its left and right."""
    best = max(((sum(s[i:j]), -i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=(0,))
    if best[0] <= 0:
        return []
    i, j = -best[1], min(j for i in [-best[1]] for j in range(i + 1, len(s) + 1) if sum(s[i:j]) == best[0])
    shift = lambda found, by: [(a + by, b + by, x) for a, b, x in found]
    return brute_segments(s[:i]) + [(i, j, best[0])] + shift(brute_segments(s[j:]), j)


def test_segments_against_recursion():
    rng = np.random.default_rng(1)
    for _ in range(200):
        s = rng.choice([-7.13, -3.01, -1.0, 2.07, 4.031, 5.3], size=rng.integers(0, 14)) + rng.normal(size=1) * 1e-3
        got = toxicity.segments(np.array(s, float))
        want = brute_segments(list(map(float, s)))
        assert sum(x for *_, x in got) == pytest.approx(sum(x for *_, x in want))
        assert max((x for *_, x in got), default=0) == pytest.approx(max((x for *_, x in want), default=0))


def test_toxicity_held_out(spark):
    bad = ["vile", "rotten", "filth"]
    texts = [prose(60, i) + ("".join(f" {bad[(i + k) % 3]} you" for k in range(5)) if i % 3 == 0 else "") for i in range(240)] + ["", None]
    df = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(160)] + [(5, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels, F.pmod("doc_id", F.lit(2)))
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    assert all((got[i] >= 0.7) == (i % 3 == 0) for i in range(160, 240)) and got[240] < 0.7 and got[241] < 0.7
    assert toxicity.score(df.limit(0), model).count() == 0
    none = toxicity.fit(df, labels.limit(0), F.lit(0))
    assert all(r.score < 0.01 for r in toxicity.score(df, none).collect())


# near duplicates


def shingle_set(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return set(zip(w, w[1:])) if len(w) > 1 else ({tuple(w)} if w else set())


def joined(ids, linked):
    of = {i: i for i in ids}
    for a, b in itertools.combinations(sorted(ids), 2):
        if linked(a, b) and of[a] != of[b]:
            low, high = sorted((of[a], of[b]))
            of = {i: low if c == high else c for i, c in of.items()}
    return of


def test_minhash_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    texts = []
    for g in range(12):
        own = prose(int(rng.integers(3, 120)), 100 + g).split()
        for _ in range(1 + 6 * (g % 4)):
            w = list(own)
            for p in rng.integers(len(w), size=rng.integers(0, max(1, len(w) // 12) + 1)):
                w[p] = f"new{rng.integers(10**6)}"
            texts.append(" ".join(w))
    texts += [texts[0].upper(), texts[0], "one", "ONE", "", None, "  \t", "a b", "b a"]
    sets = dict(enumerate(map(shingle_set, texts)))
    want = joined(sets, lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    got = {r.doc_id: r for r in minhash.near_duplicates(docs_of(spark, texts)).collect()}
    assert {i: r.component_id for i, r in got.items()} == want and {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (r.component_id == i) for i, r in got.items())
    assert minhash.near_duplicates(docs_of(spark, ["x"]).limit(0)).count() == 0


@pytest.mark.parametrize("rounds", [0, 2])
def test_long_lists_go_in_blocks_and_by_hubs(spark, monkeypatch, rounds):
    for name, value in {"ROUNDS": rounds, "LONG": 4, "BLOCK": 4, "WHOLE": 4, "HUBS": 2, "TILE": 3, "COLUMNS": 16}.items():
        monkeypatch.setattr(minhash, name, value)
    own, rng, texts = prose(80, 5).split(), np.random.default_rng(3), []
    for i in range(24):
        w = list(own)
        for p in rng.integers(80, size=i % 8):
            w[p] = f"new{rng.integers(10**6)}"
        texts.append(" ".join(w))
    sets = dict(enumerate(map(shingle_set, texts)))
    want = joined(sets, lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(spark, texts)).collect()} == want


def test_groups_give_no_pair_twice():
    """Groups with the same rows, as the lists of a group of near copies or the blocks of a list, give one forest."""
    batch = minhash.pa.RecordBatch.from_pydict({"v": [g for g in range(40) for _ in range(30)], "i": [0] * 1200, "j": [0] * 1200, "cid": [(7 * g + k) % 50 for g in range(40) for k in range(30)]})
    star = lambda held: [(min(held), x) for x in held if x != min(held)]
    run = minhash._grouped(("cid",), lambda cid: cid, star)
    pairs = [p for b in run(iter([batch.slice(k, 100) for k in range(0, 1200, 100)])) for p in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert len(pairs) == 49 and set(joined(range(50), lambda a, b: (a, b) in set(pairs)).values()) == {0}


def changed(text, places):
    return " ".join("other" if i in places else w for i, w in enumerate(text.split()))


def test_stage_takes_five_words(spark):
    a, b = prose(60, 50), prose(60, 51)
    df = docs_of(spark, [a, changed(a, {20, 40}), b, changed(b, {30}), "four words in it", "four words in IT", "four words in"])
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()) == [0, 1, 2, 4, 6]


def test_stage_decides_by_row(spark):
    a, b, c, d, e = (prose(60, 60 + i) for i in range(5))
    near = lambda t: changed(t, {30})
    texts = [(None, a), (None, b), (None, near(b)), (3, c), (3, c), (5, d), (7, near(d)), (7, e), (None, near(c)), (None, None), (9, ""), (9, "")]
    df = docs_of(spark, [t for _, t in texts], ids=[i for i, _ in texts])
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()), key=str)
    of_b = [x for x in got if x in ((None, b), (None, near(b)))]
    assert len(of_b) == 1
    assert got == sorted([(None, a), *of_b, (3, c), (5, d), (7, e), (None, None), (9, ""), (9, "")], key=str)
    assert corpus_pipeline.drop_near_duplicates(spark, df.limit(0), "").count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (4, 4), (None, 7), (9, 8), (8, 3)] + [(100, 100 + i) for i in range(1, 40)]
    got = {r.id: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 1, 9: 1, 4: 4, 5: 4} | {100 + i: 100 for i in range(40)}


# quality


def test_quality_base(spark):
    loop = " ".join(f"w{i}" for i in range(9))
    texts = ["", None, "a b\tc", f"{loop} {loop} x", "l\nl\n \n \nm # $", prose(200, 1), "x " * 60, "é b | <"]
    ws = quality.words(F.col("text"))
    got = {r.doc_id: r for r in docs_of(spark, texts).select("doc_id", *(c.alias(k) for k, c in quality.base(F.coalesce("text", F.lit("")), ws).items())).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        win = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        cover = {p for k, x in enumerate(win) if win.count(x) > 1 for p in range(k, k + 8)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words) == want


def test_quality_keeps_clean(spark, monkeypatch):
    junk = lambda i: " ".join(f"zz{(i * k) % 97}###" for k in range(80))
    clean = lambda i: " ".join(np.random.default_rng(i).choice(WORDS, 80))
    df = docs_of(spark, [clean(i) for i in range(60)] + [junk(i) for i in range(3, 23)])
    model = quality.weights(df, df.where("doc_id < 40"))
    got = {r.doc_id: r for r in quality.judge(df, model).collect()}
    assert all(got[i].kept for i in range(60)) and not any(got[i].kept for i in range(60, 80))
    assert quality.judge(df.limit(0), model).count() == 0
    monkeypatch.setattr(quality, "BROADCAST", 0)
    assert {r.doc_id: r for r in quality.judge(df, model).collect()} == got
    none = quality.weights(df, df.limit(0))
    assert all(r.llr == 0 and r.kept == (not r.base_failed) for r in quality.judge(df, none).collect())


def test_quality_against_plain_counts(spark):
    """The ratios and the verdict from counts made in plain Python."""
    df = docs_of(spark, [prose(60, i) for i in range(90)] + [None, "", "one"])
    model = quality.weights(df, df.where("doc_id < 45"))
    own = {r.doc_id: r.g for r in quality.grams(df, "text", model.buckets, "doc_id").groupBy("doc_id").agg(F.collect_list("bucket").alias("g")).collect()}
    told = {r.doc_id: (own.get(r.doc_id, []), r.h) for r in df.select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(quality.HELD)) == 0).alias("h")).collect()}
    counted = {i: own for i, (own, _) in told.items()}
    every, some = (collections.Counter(g for i, own in counted.items() for g in own if i in of) for of in (told, {i for i, (_, h) in told.items() if i < 45 and not h}))
    raw, own = sum(every.values()), sum(some.values())
    ratio = {g: round(1e6 * (math.log((some[g] / own + 0.25 * n / raw) / 1.25) - math.log(n / raw))) for g, n in every.items()}
    llr = {i: sum(ratio[g] for g in gs) / 1e6 / len(gs) if gs else 0.0 for i, gs in counted.items()}
    tail, median = np.quantile([llr[i] for i, (_, h) in told.items() if i < 45 and h], [quality.LOST, 0.5])
    least = tail - quality.MARGIN * (median - tail)
    for r in quality.judge(df, model).collect():
        assert r.llr == pytest.approx(llr[r.doc_id], abs=1e-6) and r.kept == (not r.base_failed and llr[r.doc_id] >= least - 1e-12)


@pytest.mark.parametrize("n", [120, 1200])
def test_quality_is_alike_at_every_size(spark, n):
    """A vocabulary that grows with the corpus: junk stays out and clean texts stay, however many n-grams there are."""
    rng = np.random.default_rng(n)
    text = lambda kind, i: " ".join(f"{kind}{k}" for k in rng.integers(12 * n, size=120))
    df = docs_of(spark, [text("clean" if i % 2 else "junk", i) for i in range(n)])
    got = {r.doc_id: r for r in quality.judge(df, quality.weights(df, df.where("doc_id % 4 = 1"))).collect()}
    junk, held = ([got[i] for i in range(n) if i % 4 in k] for k in ((0, 2), (3,)))
    assert not any(r.kept for r in junk) and sum(r.kept for r in held) > 0.9 * len(held)


def test_quality_learns_from_every_labelled_row(spark):
    """Ratios and limit of 54,000 trusted and 54,000 rejected rows, from counts over all of them."""
    word = lambda i: F.concat(F.when(F.col("doc_id") < 60_000, "w").otherwise("x"), F.pmod(F.xxhash64("doc_id", i), F.lit(60)))
    df = spark.range(114_000).withColumnRenamed("id", "doc_id").withColumn("text", F.array_join(F.transform(F.sequence(F.lit(1), F.lit(20)), word), " ")).cache()
    trusted, rejected = df.where("doc_id < 54000"), df.where("doc_id >= 60000")
    model = quality.weights(df, trusted, rejected=rejected)
    held = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(quality.HELD)) == 0
    every, some = ({r["bucket"]: r["count"] for r in quality.grams(x, "text", model.buckets, "doc_id").groupBy("bucket").count().collect()} for x in (df, trusted.where(~held)))
    raw, own = sum(every.values()), sum(some.values())
    want = {g: round(1e6 * (math.log((some.get(g, 0) / own + 0.25 * n / raw) / 1.25) - math.log(n / raw))) for g, n in every.items()}
    assert {r.bucket: r.ratio for r in model.ratios.collect()} == pytest.approx(want, abs=1)
    made = quality.judge(df, model, scores=model.scores)
    good, bad = ([r.llr for r in made.join(x, "doc_id").select("llr").collect()] for x in (trusted.where(held), rejected))
    tail, noise = np.quantile(good, quality.LOST), np.quantile(bad, quality.NOISE)
    assert model.least == pytest.approx(tail - max(0, tail - noise) / 2, abs=1e-12)
    some = df.where("doc_id % 997 = 0")
    assert {r.doc_id: r for r in made.where("doc_id % 997 = 0").collect()} == {r.doc_id: r for r in quality.judge(some, model).collect()}


@pytest.mark.parametrize("few", [3, 50_000])
def test_percentiles_are_exact(spark, monkeypatch, few):
    monkeypatch.setattr(quality, "FEW", few)
    rng = np.random.default_rng(6)
    values = [*rng.normal(size=90).tolist(), *[0.25] * 40, *(0.5 + 1e-9 * rng.random(30)).tolist(), -3.0]
    rows, shares = spark.createDataFrame([(x,) for x in values], "x double"), [0.0, 0.005, 0.3, 0.5, 0.77, 0.95, 1.0]
    assert quality.percentiles(rows, "x", shares) == pytest.approx(np.quantile(values, shares).tolist(), abs=1e-15)
    assert quality.percentiles(rows.limit(0), "x", [0.5]) == [None]


# passages


def plain_passages(rows):
    """What is left of (id, text) rows, in order of rows: removed bytes, runs and a digest."""
    seen, made = set(), []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - 99):
            if b[k : k + 100] in seen:
                gone[k : k + 100] = [True] * 100
            seen.add(b[k : k + 100])
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        made.append((i, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return made


def passage_texts():
    rng = np.random.default_rng(4)
    noise = lambda n: "".join(chr(97 + int(x)) for x in rng.integers(26, size=n))
    shared, long = noise(160), noise(700)
    texts = [noise(300) + shared + noise(50), shared, noise(40) + shared[10:140] + noise(200), long, long, long[:350] + "é" + long[350:], noise(99), "", None, "ab" * 150, "z" * 260, noise(120) + long[100:230] + noise(10) + long[100:230], shared[:99] + "!"]
    return texts + [noise(30) + shared + noise(30) for _ in range(30)]


@pytest.mark.parametrize("group", [2048, 4])
def test_passages_against_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(passages, "GROUP", group)
    texts = passage_texts()
    df = docs_of(spark, texts)
    assert sorted(map(tuple, passages.remove_repeats(df).collect())) == plain_passages(enumerate(texts))
    assert passages.remove_repeats(df.limit(0)).count() == 0


def test_passages_of_repeated_and_null_ids(spark):
    texts = passage_texts()
    ids = [None if i % 5 == 2 else i // 3 for i in range(len(texts))]
    rows = [*zip(ids, texts), *zip(ids[:6], texts[:6]), (None, texts[-1]), (3, texts[3])]
    code = {r.t: r.c for r in spark.createDataFrame([(t or "",) for t in set(texts)], "t string").select("t", F.xxhash64("t").alias("c")).collect()}
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, code[r[1] or ""]))
    df = docs_of(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    assert sorted(map(tuple, passages.remove_repeats(df).collect()), key=str) == sorted(plain_passages(rows), key=str)


def test_suffixes_are_sorted():
    rng = np.random.default_rng(5)
    strings = [bytes(rng.integers(97, 99, size=rng.integers(0, 9)).astype(np.uint8)) for _ in range(300)]
    group = np.sort(rng.integers(0, 12, size=300))
    size = np.array(list(map(len, strings)))
    order = passages.Suffixes(b"".join(strings), np.cumsum(size) - size, size).sorted(group)
    assert [(group[i], strings[i], i) for i in order] == sorted((group[i], strings[i], i) for i in range(300))


# mixing


def test_raking_reaches_targets(spark):
    rng = np.random.default_rng(7)
    cells = [(a, b, int(rng.integers(1, 100))) for a in "xyz" for b in "pqrs" if (a, b) != ("x", "p")]
    df = spark.createDataFrame(cells, "a string, b string, tokens long")
    ta = spark.createDataFrame([("x", 0.5), ("y", 0.3), ("z", 0.2), ("gone", 0.4)], "a string, target double")
    tb = spark.createDataFrame([(b, 0.25) for b in "pqrs"], "b string, target double")
    w = {(r.a, r.b): r.weight for r in mixing.rake(df, {"a": ta, "b": tb}).collect()}
    whole = sum(t for *_, t in cells)
    m = np.array([[next((t for x, y, t in cells if (x, y) == (a, b)), 0) for b in "pqrs"] for a in "xyz"], float)
    for _ in range(300):
        m *= (np.array([0.5, 0.3, 0.2]) * whole / m.sum(1))[:, None]
        m *= np.array([0.25] * 4) * whole / m.sum(0)
    assert all(w[a, b] == pytest.approx(m["xyz".index(a), "pqrs".index(b)], rel=1e-4) for a, b, _ in cells)


def test_mixing_defaults(spark):
    df = docs_of(spark, [prose(30, i) for i in range(300)] + ["", None])
    mix = lambda d: mixing.mix(d, {"source": F.col("source"), "lang": F.col("n_chars"), "topic": mixing.topic(F.col("text"))}, F.col("doc_id"), F.size(common.words(F.col("text"))))
    got = mix(df).collect()
    assert len(got) == 302 and 0.3 < sum(r.sampled for r in got) / 302 < 0.7 and all(0 <= r.probability <= 1 for r in got)
    assert {r.doc_id for r in mix(df).where("sampled").collect()} == {r.doc_id for r in got if r.sampled}
    assert mix(df.limit(0)).count() == 0
    clash = df.withColumns({"weight": F.lit(3), "tokens": F.lit("x"), "dim_topic": F.lit(1), "sampled": F.lit(9)})
    key = lambda r: (r.doc_id, r.tokens, r.dim_topic, round(r.weight, 9), r.sampled)
    assert sorted(map(key, mix(clash).collect())) == sorted(map(key, got))


def test_mixing_reads_texts_once(spark):
    """What counts the cells is stored, so the draw splits no text again; rows are those of the general form."""
    made = queries.op7_mixing(spark, DATA)
    assert "crc32" not in made._jdf.queryExecution().optimizedPlan().toString()
    want = queries.mixed(common.table(spark, DATA, "documents"))
    key = lambda r: (r.doc_id, r.tokens, r.dim_source, r.dim_lang, r.dim_topic, round(r.weight, 6), round(r.probability, 6), r.sampled)
    assert sorted(map(key, made.collect())) == sorted(map(key, want.collect()))


def test_certain_documents_are_made_up_for(spark):
    """Where a cell can't weigh enough, the others of its values take the rest, so the drawn marginals are the targets."""
    cells = spark.createDataFrame([("x", "p", 10), ("x", "q", 90), ("y", "p", 300), ("y", "q", 600)], "a string, b string, tokens long")
    target = lambda k, **shares: spark.createDataFrame(list(shares.items()), f"{k} string, target double")
    goals = {"a": target("a", x=0.18, y=0.82), "b": target("b", p=0.5, q=0.5)}
    w = {(r.a, r.b): (r.weight, r.tokens) for r in mixing.rake(cells, goals, 2.0).collect()}
    assert all(v <= 2 * t + 1e-6 for v, t in w.values()) and w["x", "p"][0] == pytest.approx(20, rel=1e-3)
    assert w["x", "p"][0] + w["x", "q"][0] == pytest.approx(180, rel=1e-4) and w["x", "p"][0] + w["y", "p"][0] == pytest.approx(500, rel=1e-4)


def test_driver_plans_one_sweep_at_most(spark, monkeypatch):
    """What the driver plans in raking doesn't grow with the sweeps; arrays and windows give the same weights."""
    rng = np.random.default_rng(3)
    rows = [(a, b, c, int(rng.integers(1, 200))) for a in [*"uvwxyz", None] for b in range(5) for c in "pq" if rng.random() < 0.8]
    cells = spark.createDataFrame(rows, "a string, b int, c string, tokens long")
    target = lambda k, kind, shares: spark.createDataFrame(list(shares.items()), f"{k} {kind}, target double")
    goals = {"a": target("a", "string", dict(zip("uvwxy", [0.3, 0.1, 0.2, 0.2, 0.1])) | {"gone": 0.1}), "b": target("b", "int", {b: 0.2 for b in range(5)}), "c": target("c", "string", {"p": 0.7, "q": 0.3})}
    plans = []

    def cut(df, plain=mixing.cut):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain(df)

    monkeypatch.setattr(mixing, "cut", cut)
    found = {}
    for most in (mixing.CELLS, 0):
        monkeypatch.setattr(mixing, "CELLS", most)
        for cap in (None, 3.0):
            found[most, cap] = {r[:3]: r.weight for r in mixing.rake(cells, goals, cap).collect()}
            assert len(found[most, cap]) == len(rows) and all((w > 0) == (a not in ("z", None)) for (a, _, _), w in found[most, cap].items())
        if most:
            queries.mixed(common.table(spark, DATA, "documents"))
    arrays, windows = [[found[most, cap] for cap in (None, 3.0)] for most in (1 << 18, 0)]
    assert all(x == pytest.approx(y, rel=1e-9) for x, y in zip(arrays, windows)) and arrays[0] != pytest.approx(arrays[1], rel=1e-3)
    nodes = [len(re.findall(r"Window \[|Join |Aggregate ", p)) for p in plans]
    assert len(plans) > 10 and max(nodes) <= 15, nodes
    # Nothing to rake to: no weight, by either way.
    for most in (1 << 18, 0):
        monkeypatch.setattr(mixing, "CELLS", most)
        assert {r.weight for r in mixing.rake(cells, goals | {"c": target("c", "string", {"gone": 1.0})}).collect()} == {0.0}


# personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    def luhn(s):
        return sum((int(c) * (1 + i % 2)) // 10 + (int(c) * (1 + i % 2)) % 10 for i, c in enumerate(reversed(s))) % 10 == 0
    def ok(kind, v):
        g = re.sub("[^0-9]", "", v)
        return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in v.split(".")), "card": lambda: 14 <= len(g) <= 19 and luhn(g), "phone": lambda: 10 <= len(g) <= 15}[kind]()
    found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if ok(kind, m[0])]
    return [f"{kind}:{s}:{e}" for s, _, e, kind in sorted(found)]


def test_base_spans(spark):
    texts = ["mail a@b.c%d@e.f. x@y", "a@a@a.b.c", "é 1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4", "4111 1111 1111 1111, 4111111111111112", "+1 (555) 010-9999. +1", "", None, "card 4" + "1" * 5000, "a@" + "b." * 4000 + "c", "x" * 20000, "1." * 5000, "+" * 300, "call 555-123-4567 now", "tel (555) 123-4567"]
    got = {r.doc_id: r for r in pii.find(docs_of(spark, texts)).select("doc_id", pii.listed(F.col("base")).alias("b"), pii.listed(F.col("spans")).alias("s"), pii.masked(F.col("text"), F.col("spans")).alias("m")).collect()}
    for i, t in enumerate(texts):
        assert got[i].b == ",".join(plain_spans(t)), i
        assert set(plain_spans(t)) <= set(got[i].s.split(","))
    assert got[0].m.startswith("mail [EMAIL][EMAIL]") and got[6].m == ""
    assert pii.find(docs_of(spark, ["x"]).limit(0)).count() == 0


def test_labelers_are_weighed():
    counts = {(1, 1, 1, 1): 60, (1, 1, 0, 1): 30, (0, -1, 0, -1): 80, (0, 1, 1, 1): 10, (0, -1, 0, 1): 20}
    post = pii._em(counts)
    assert post[1, 1, 1, 1] > 0.95 and post[0, -1, 0, -1] < 0.05 and post[0, 1, 1, 1] > post[0, -1, 0, 1]


# embeddings


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(40, 16))
    x = np.concatenate([x, x[:15] + rng.normal(size=(15, 16)) * 0.05, x[:3] * 2, x[:2]])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(100, None), (101, [0.0] * 16), (102, [float("nan")] * 16), (103, []), (104, [None] + [1.0] * 15), (105, [float("inf")] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    close = u @ u.T >= 0.95
    want = joined(range(len(x)), lambda a, b: close[a, b])
    got = {r.vec_id: r for r in embeddings.near_duplicates(df).collect()}
    found, all_ = sum(r.n_links for r in got.values()), int(close.sum()) - len(x)
    assert all_ * 0.9 <= found <= all_
    assert sum(got[i].component_id == c for i, c in want.items()) >= 0.95 * len(x)
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(100, 106))
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_of_many_lengths_and_sizes(spark):
    """Planted pairs at the limit and a little above are found at the recall asked for, whatever the length."""
    rng = np.random.default_rng(18)
    rows, want = [], set()
    for size, n in ((48, 3000), (16, 300), (3, 1)):
        x = rng.normal(size=(n, size))
        x /= np.linalg.norm(x, axis=1)[:, None]
        noise = rng.normal(size=x.shape)
        noise -= (noise * x).sum(1)[:, None] * x
        noise /= np.linalg.norm(noise, axis=1)[:, None]
        c = rng.uniform(0.9501, 0.98, size=(n, 1))
        scale = 10.0 ** rng.integers(-200, 200, size=(n, 1))
        for a, b in zip(x, (c * x + np.sqrt(1 - c * c) * noise) * scale, strict=True):
            want.add((len(rows), len(rows) + 1))
            rows += [(len(rows), a.tolist()), (len(rows) + 1, b.tolist())]
    got = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)).collect()}
    found = sum(got[a].n_links > 0 and got[b].component_id == got[a].component_id for a, b in want)
    assert found >= 0.98 * len(want) and got[len(rows) - 1].component_id == len(rows) - 2
    repeated = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [2.0, 4.0]), (4, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in embeddings.near_duplicates(repeated).collect()), key=str) == [(1, 2, 1), (1, 2, 1), (4, 0, 4), (None, 2, 1)]


def test_traversal_is_nearest_first():
    rng = np.random.default_rng(9)
    a, b = rng.random(7), rng.random(5)
    sums = (a[:, None] + b).ravel()
    assert embeddings.traversal(a, b, 35) == sums.argsort().tolist()


# segmentations


@pytest.fixture(scope="module")
def vocabulary():
    return segmenting.default_vocabulary()


def all_segmentations(v, chunk):
    if not chunk:
        return [((), 0.0)]
    out = []
    for n in range(1, len(chunk) + 1):
        if (i := v.ids.get(chunk[:n])) is not None:
            out += [((i, *rest), v.score[i] + s) for rest, s in all_segmentations(v, chunk[n:])]
    return out


def test_samples_follow_the_distribution(vocabulary):
    v = segmenting.vocabulary(vocabulary)
    every = dict(all_segmentations(v, "▁then"))
    z = sum(map(math.exp, every.values()))
    sampler, n, first, inclusion = segmenting.Sampler(vocabulary, 3, 0), 4000, {}, {}
    for found in sampler.sample(["then"] * n, list(range(n))):
        ids = [tuple(f[0].tolist()) for f in found]
        assert len(set(ids)) == 3 and [f[2] for f in found] == sorted((f[2] for f in found), reverse=True)
        first[ids[0]] = first.get(ids[0], 0) + 1
        for f, i in zip(found, ids):
            assert f[1] == pytest.approx(every[i] - math.log(z), abs=1e-9)
            inclusion[i] = inclusion.get(i, 0.0) + 1 / f[3]
    for ids, s in every.items():
        p = math.exp(s) / z
        assert abs(first.get(ids, 0) / n - p) < 4 * math.sqrt(p * (1 - p) / n) + 1e-3
        if p > 0.05:  # weighting by the inclusion score estimates each total of 1 without bias
            assert inclusion[ids] / n == pytest.approx(1, abs=0.15)


def test_encode_round_trip(spark, vocabulary):
    texts = ["Hello  world\n\tnew", "", None, "日本語 🙂 text", " lead", "a" * 3000, prose(100, 3), prose(100, 3), "▁x", "\x00\x01"]
    rows = segmenting.encode(docs_of(spark, texts, ids=[0, 1, 2, 3, 4, 5, 6, 6, 8, 9])).collect()
    for r in rows:
        if r.doc_id != 8:  # the mark of a space itself reads back as a space
            assert r.round_trip, r
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(tuple(r.ids))
    assert len(set(by[6])) == 2 and len(by[6]) == 4 and len(by[1]) == 1
    assert segmenting.encode(docs_of(spark, ["x"]).limit(0)).count() == 0


def test_own_spaces_and_long_chunks(vocabulary):
    """A text's own U+2581 and a chunk of a million characters come back."""
    texts = ["\u2581a \u2581 b\u2581", "ab" * 500_000, "\u2581", " ", "é\U0001f600\n\t x"]
    sampler = segmenting.Sampler(vocabulary, 2, 0)
    for t in texts:
        (found,) = sampler.sample([t], [1])
        assert found and all(segmenting.decode(f[0].tolist(), sampler.lattices.v) == t for f in found)


def test_a_text_of_any_length(vocabulary, monkeypatch):
    texts = [" ".join(f"{prose(3, i)}\n日本語{i} 🙂" for i in range(60)), "then", "one two " * 40 + prose(30, 7), "a" * 300]
    want = segmenting.Sampler(vocabulary, 4, 0).sample(texts, [1, 2, 3, 4])
    monkeypatch.setattr(segmenting, "REMEMBERED", 40)
    sampler = segmenting.Sampler(vocabulary, 4, 0)
    got = sampler.sample(texts, [1, 2, 3, 4])
    for text, a, b in zip(texts, want, got, strict=True):
        assert [x[0].tolist() for x in a] == [x[0].tolist() for x in b] and len(b) == 4
        assert [v for x in a for v in x[1:]] == pytest.approx([v for x in b for v in x[1:]], abs=1e-6)
        assert all(segmenting.decode(x[0].tolist(), sampler.lattices.v) == text for x in b)


def test_a_batch_is_made_at_once(vocabulary, monkeypatch):
    """Characters that are no piece become bytes once a batch, not in each segmentation, with the outcome of texts alone."""
    texts = ["a\nb 日本語🙂 c", "", "\n\n", "▁x  y", " lead\t", "\x00\x01", *(f"{prose(20, i)}\n🙂{i}" for i in range(26))]
    sampler, keys, calls, plain = segmenting.Sampler(vocabulary, 2, 0), list(range(len(texts))), [], segmenting.Vocabulary.in_bytes
    v = sampler.lattices.v
    monkeypatch.setattr(segmenting.Vocabulary, "in_bytes", lambda self, codes: calls.append(len(codes)) or plain(self, codes))
    got = sampler.sample(texts, keys)
    assert len(calls) == 2  # of the lattices and of all segmentations
    for steps in (segmenting.STEPS_AT_ONCE, 7):
        monkeypatch.setattr(segmenting, "STEPS_AT_ONCE", steps)
        for t, key, found in zip(texts, keys, got, strict=True):
            (alone,) = segmenting.Sampler(vocabulary, 2, 0).sample([t], [key])
            assert [(f[0].tolist(), *f[2:]) for f in found] == [(f[0].tolist(), *f[2:]) for f in alone]
            assert segmenting.round_trips([f[0] for f in found], [t.encode()] * len(found), v) == [True] * len(found)
            assert segmenting.round_trips([f[0] for f in found], [t.encode() + b"x"] * len(found), v) == [False] * len(found)


# queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_give_what_sql_gives(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    df = queries.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, df.select(*cols).collect()), key=str) == sorted(want, key=str)


def test_pipeline_keeps_what_its_stages_keep(spark):
    """The stages one after the other, each on all that the one before kept."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, docs, DATA).collect(), docs.schema)
        texts, before = {r.doc_id: r.text for r in kept.collect()}, {r.doc_id: r.text for r in docs.collect()}
        assert set(texts) <= set(before) and len(texts) > (0 if name == "mixing" else 0.6 * len(before))
        if name == "near_duplicates":
            of = lambda t: {tuple(w[k : k + 5]) for w in [minhash.split_words(t)] for k in range(max(1, len(w) - 4))} if minhash.split_words(t) else set()
            sets = {i: of(t) for i, t in before.items()}
            linked = joined(sets, lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
            assert set(texts) == {i for i, c in linked.items() if i == c}
        elif name != "personal_data":
            assert all(before[i] == t for i, t in texts.items())
        else:
            spans = {r.doc_id: r.spans for r in pii.find(docs).collect()}
            assert all((texts[i] == before[i]) == (not spans[i]) for i in texts)
        docs = kept
    assert {r.doc_id for r in corpus_pipeline.segment(spark, docs, DATA).collect()} == {r.doc_id for r in docs.collect()}
