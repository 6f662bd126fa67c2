"""Operators that compare or place rows, against brute force."""

import json
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlab.llm import chat_format, common, decontamination, embedding_dedup, minhash_dedup, sharding

SF = "/root/testdata/sf0.001"


def groups_of(nodes, links):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    return {x: find(x) for x in nodes}


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(1000 + i, 1001 + i) for i in range(150)] + [(5000, 6000 + i) for i in range(50)]
    df = spark.createDataFrame(links, "a long, b long")
    nodes = {x for p in links if p[0] != p[1] for x in p}
    assert {r.node: r.component for r in common.components(df).collect()} == groups_of(nodes, [p for p in links if p[0] != p[1]])
    assert common.components(df.limit(0)).count() == 0


# -- 1 -----------------------------------------------------------------------------------

def test_tool_calls(spark):
    calls = [
        ("c", 1, "a", None, "add", '{"x": 1, "y": 2.5}'), ("c", 2, "b", "a", "add", '{"y": {"b":1,"a":[2, 1]}, "x": "1"}'), ("c", 3, "d", "b", "add", '{"x": 1, "z": null}'),
        ("c", 0, "e", "d", "add", "not json"), ("c", 1, "a", None, "add", '{"x": 9}'), ("c", 5, "p", "q", "add", "[1]"), ("c", 6, "q", "p", "none", "{}"),
        ("c", 7, "r", "gone", "add", ""), ("c", 8, None, None, "add", "{}"), ("other", 1, "a", None, None, None),
    ]
    results = [("c", 2, "a", 'said "hi"\n'), ("c", 1, "a", "first"), ("c", 9, "zz", "nobody"), ("c", 4, "b", None)]
    calls = spark.createDataFrame(calls, "conv_id string, turn long, call_id string, parent_id string, name string, arguments string")
    results = spark.createDataFrame(results, "conv_id string, turn long, call_id string, content string")
    schemas = spark.sql("SELECT 'add' AS name, array(struct('x' AS name, 'integer' AS type, true AS required), struct('y' AS name, 'number' AS type, false AS required)) AS params")
    got = {(r.conv_id, r.call_id): r for r in chat_format.link_calls(calls, results, schemas).collect()}
    assert {k[1]: (v.depth, v.position) for k, v in got.items() if k[0] == "c"} == {
        "a": (0, 0), "b": (1, 1), "d": (2, 2), "e": (3, 3), "p": (None, 4), "q": (None, 5), "r": (None, 6)}
    assert got["c", "a"].errors == "" and got["c", "a"].repeats == 2 and got["c", "a"].answered
    assert got["c", "a"].record == '{"arguments":{"x":1,"y":2.5},"id":"a","name":"add","result":"first"}'
    assert got["c", "b"].errors == "type x, type y" and got["c", "b"].answered
    assert got["c", "b"].record == '{"arguments":{"x":"1","y":{"a":[2,1],"b":1}},"id":"b","name":"add","result":null}'
    assert got["c", "d"].errors == "unknown z" and got["c", "e"].errors == got["c", "r"].errors == "not JSON"
    assert got["c", "p"].errors == "not an object" and got["c", "q"].errors == "unknown tool"
    assert got["other", "a"].record == '{"arguments":null,"id":"a","name":null,"result":null}'
    assert [r.call_id for r in chat_format.unclaimed(calls, results).collect()] == ["zz"]
    assert chat_format.link_calls(calls.limit(0), results, schemas).count() == 0
    for r in got.values():
        parsed = json.loads(r.record)
        assert list(parsed) == sorted(parsed)


def test_long_chain_of_calls(spark):
    calls = spark.range(3000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.format_string("%05d", F.pmod(F.col("id") * 7919, F.lit(3000))).alias("call_id"),
                                     F.when(F.col("id") > 0, F.format_string("%05d", F.pmod((F.col("id") - 1) * 7919, F.lit(3000)))).alias("parent_id"), F.lit("t").alias("name"), F.lit("{}").alias("arguments"))
    out = chat_format.link_calls(calls, calls.select("conv_id", "turn", "call_id", F.lit("r").alias("content")).limit(0), chat_format.schemas(spark)).collect()
    assert all(r.depth == r.turn == r.position for r in out) and len(out) == 3000


# -- 3 -----------------------------------------------------------------------------------

def shingle_counts(text, size=5):
    words = re.findall(common.WORD_CLASS, (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return Counter()
    return Counter(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def probability_jaccard(x, y):
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in set(x) | set(y)) for i in set(x) & set(y))


def test_near_duplicates_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    base = max(docs.values(), key=lambda t: (len(t) < 700, len(t) if len(t) < 700 else 0)).split(" ")
    for k in range(90):  # a group of near copies, some of them far from each other and from the most frequent one
        words = list(base)
        for at in rng.integers(0, len(words), 1 + k % 7):
            words[at] = f"w{k}x{at}"
        docs[10_000 + k] = " ".join(words)
    docs[10_100] = docs[10_000]
    docs |= {20_000: None, 20_001: "", 20_002: "...", 20_003: "one two", 20_004: "One, two!", 20_005: "a b c d e f " * 4000, 20_006: "a b c d e f " * 3999}
    df = spark.createDataFrame([(i, t, "x") for i, t in docs.items()], "doc_id long, text string, component string")
    counts = {i: shingle_counts(t) for i, t in docs.items()}
    holders = defaultdict(set)
    for i, c in counts.items():
        for s in c:
            holders[s].add(i)
    links = set()
    for i, c in counts.items():
        for j in {j for s in c for j in holders[s] if j < i}:
            if len(set(c) & set(counts[j])) > 0.4 * min(len(c), len(counts[j])) and probability_jaccard(c, counts[j]) >= 0.8:
                links.add((j, i))
    want = groups_of(docs, links)
    got = {r.doc_id: (r.class_id, r.kept) for r in minhash_dedup.similar_classes(df).collect()}
    assert {i: x[0] for i, x in got.items()} == want
    assert all(kept == (i == c) for i, (c, kept) in got.items())
    kept = minhash_dedup.keep_one(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, c in want.items() if i == c}
    assert minhash_dedup.similar_classes(df.limit(0)).count() == 0


@pytest.mark.parametrize("tile,columns", [(4, 7), (512, 4096)])
def test_pairs_of_a_bucket_bounded_from_above(spark, monkeypatch, tile, columns):
    """Of all pairs in different components of a bucket, those that reach 0.8 come out, once each, and few others."""
    monkeypatch.setattr(minhash_dedup, "TILE", tile)
    monkeypatch.setattr(minhash_dedup, "COLUMNS", columns)
    rng = np.random.default_rng(2)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for k in range(40):
        words = list(base) * (1 + k % 2)
        for at in rng.integers(0, len(words), k % 6):
            words[at] = f"w{k}x{at}"
        texts.append(" ".join(words))
    counts = [shingle_counts(t) for t in texts]
    sets = spark.createDataFrame([(i, np.array(list(c), "<u8").tobytes(), np.array(list(c.values()), "<i4").tobytes()) for i, c in enumerate([Counter({hash(k) % 2**61: n for k, n in c.items()}) for c in counts])], "doc_id long, items binary, counts binary")
    buckets = spark.createDataFrame([(band, key, i, i % 5) for i in range(40) for band, key in ((0, i % 3), (1, 7))], "band int, key long, class long, component long")
    classes = spark.createDataFrame([(i, [i % 3, 7]) for i in range(40)], "class long, bands array<long>")
    got = [(r.a, r.b) for r in minhash_dedup.possible(buckets, sets, classes, 0.8).collect()]
    alike = {(i, j) for i in range(40) for j in range(i + 1, 40) if i % 5 != j % 5 and probability_jaccard(counts[i], counts[j]) >= 0.8}
    assert len(got) == len(set(got)) and alike and alike <= set(got) and len(got) < 3 * len(alike) + 20
    assert all(i < j and i % 5 != j % 5 for i, j in got)


def test_signature_estimates_probability_jaccard():
    rng = np.random.default_rng(9)
    items = np.unique(rng.integers(1, 1 << 60, 400).astype(np.uint64))
    x, y = items[:300], items[80:]
    cx, cy = rng.integers(1, 4, len(x)), rng.integers(1, 4, len(y))
    exact = minhash_dedup.probability_jaccard(x, cx, y, cy)
    plain = probability_jaccard(dict(zip(x.tolist(), cx.tolist())) and Counter(dict(zip(x.tolist(), cx.tolist()))), Counter(dict(zip(y.tolist(), cy.tolist()))))
    assert exact == pytest.approx(plain)
    a, b = minhash_dedup.prob_minhash(x, cx, 4096), minhash_dedup.prob_minhash(y, cy, 4096)
    assert (a == b).mean() == pytest.approx(exact, abs=0.03)
    assert (minhash_dedup.prob_minhash(x, cx * 5, 64) == minhash_dedup.prob_minhash(x, cx * 5, 64)).all()
    one = minhash_dedup.prob_minhash(x[:1], cx[:1], 128)
    assert (one == x[0]).all()


# -- 8 -----------------------------------------------------------------------------------

def ring_by_hand(rows, owner, room, nodes):
    """Serve each node's own rows first, then let the rest walk on clockwise."""
    homes = defaultdict(list)
    for cell, h, key in sorted(rows):
        homes[owner[cell][0]].append((cell, h, key))
    load, out, waiting = {}, {}, []
    for n in range(nodes):
        for x in homes[n][:room[n]]:
            out[x] = n
        load[n] = min(len(homes[n]), room[n])
        waiting += [(n, k, x) for k, x in enumerate(homes[n][room[n]:])]
    total = Counter()
    for n, _, x in waiting:
        at = n
        while load[at] >= room[at]:
            at = (at + 1) % nodes
        load[at] += 1
        total[at] += 1
    return out, load


@pytest.mark.parametrize("copies", [1, 400])
def test_sharding(spark, copies):
    rows = spark.range(5000).select((F.col("id") % (5000 // copies + 7)).alias("doc_id"), F.lit("x").alias("law")) if copies > 1 else spark.range(5003).select(F.col("id").alias("doc_id"), F.lit("x").alias("law"))
    out = sharding.assign(rows, ["doc_id"], 7, nodes=16).collect()
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in rows.collect())
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(7)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == rows.count()


def test_sharding_moves_little(spark):
    """Rows below a node's bound stay on it; the others go to the next nodes with room."""
    rows = spark.range(4000).select(F.col("id").alias("doc_id"))
    cells = sharding.ring(spark, 5, 8)
    owner = {r.cell: (r.node, r["shard"]) for r in cells.collect()}
    assert len(owner) == sharding.CELLS and {s for _, s in owner.values()} == set(range(5))
    hashed = rows.withColumn("h", F.xxhash64("doc_id")).withColumn("cell", F.pmod("h", F.lit(sharding.CELLS)))
    counts = hashed.groupBy("cell").agg(F.count("*").alias("n"))
    nodes = max(n for n, _ in owner.values()) + 1
    shard_of = dict(owner.values())
    room, width = {}, Counter(n for n, _ in owner.values())
    for s in range(5):
        bound, up, whole = (4000 + 4 - s) // 5, 0, sum(w for n, w in width.items() if shard_of[n] == s)
        for n in sorted(n for n in width if shard_of[n] == s):
            room[n] = bound * (up + width[n]) // whole - bound * up // whole
            up += width[n]
    stay, load = ring_by_hand([(r.cell, r.h, r.doc_id) for r in hashed.collect()], owner, room, nodes)
    plan = sharding.moves(counts, cells, 5).collect()
    moved = sum(r.high - r.low for r in plan) - len(stay)
    got = Counter()
    for r in plan:
        got[r["shard"]] += r.high - r.low
    want = Counter()
    for n, k in load.items():
        want[shard_of[n]] += k
    assert got == want and 0 < moved < 2000
    placed = {r.doc_id: r["shard"] for r in sharding.assign(rows, ["doc_id"], 5, nodes=8).collect()}
    assert all(placed[key] == shard_of[n] for (_, _, key), n in stay.items())
    loose = Counter(r["shard"] for r in sharding.assign(rows, ["doc_id"], 5, slack=0.5, nodes=8).collect())
    assert max(loose.values()) <= 1200 and sum(loose.values()) == 4000


def test_sharding_of_odd_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, ""), (None, "x" * 100_000), (3, "é")], "doc_id long, text string")
    df.createOrReplaceTempView("odd")
    body = F.coalesce("text", F.lit(""))
    rows = df.select("doc_id", (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    out = sharding.assign(rows, ["doc_id", "text_crc32"], 40).collect()
    assert len(out) == 5 and len({r["shard"] for r in out}) == 5 and {r.slot for r in out} == {0}
    assert sharding.assign(rows.limit(0), ["doc_id", "text_crc32"], 40).count() == 0


# -- 9 -----------------------------------------------------------------------------------

def test_templates_and_slots(spark):
    items = [(1, "If Tom Brown has 12 red apples and gives 5 km of rope to Tom again, how many apples are left over now?"), (2, "too short"), (3, None),
             (4, "A plain sentence of ordinary words that nobody would ever change at all in any way.")]
    docs = [(1, "Intro text. If Ann Black has 40 red apples and gives 7 km of rope to Ann again, how many apples are left over now? Outro."),
            (2, "If Ann Black has 40 red apples and gives 7 km of rope to Bob again, how many pears."),
            (3, "words before it A PLAIN sentence of ordinary words that nobody would ever change at all in any way."), (4, None), (5, ""),
            (6, "something else entirely that shares nothing with it but red apples and gives"), (3, "again: a plain sentence of ordinary words that nobody would ever change at all in any way"),
            (None, "A plain sentence of ordinary words that nobody would ever change at all")]
    docs = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    items = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(docs, items).collect()}
    assert set(got) == {(1, 1), (3, 4)}
    assert got[1, 1].changed and got[1, 1].consistent == 1.0 and got[1, 1].n_slots == 5
    assert not got[3, 4].changed
    clean = decontamination.without_benchmark(docs, items)
    assert clean.columns == docs.columns and sorted(str(r.doc_id) for r in clean.collect()) == ["2", "4", "5", "6", "None"]
    assert decontamination.contaminated(docs.limit(0), items).count() == 0
    assert decontamination.contaminated(docs, items.limit(0)).count() == 0


def test_slots_per_alignment(spark):
    """Repeated templates and several variants in a document don't hide each other."""
    year = "In year {} the price of the share rose by {} percent of its old value."
    question = "A farmer sells {} baskets of ripe plums at the market and then buys {} sacks of corn for the winter."
    items = [(1, " ".join(year.format(i, n) for i, n in ((1, 5), (2, 7), (3, 9)))), (2, question.format(12, 30))]
    docs = [(1, f"Before. {items[0][1]} After."), (2, f"{question.format(12, 30)} Then something else. {question.format(44, 51)}"),
            (3, f"{question.format(61, 62)} Then something else. {question.format(44, 51)}"), (4, " ".join(year.format(i, n) for i, n in ((4, 11), (5, 12), (6, 13)))),
            (5, "A farmer sells 61 baskets of ripe plums at the market and then quickly buys 62 sacks of corn for the winter."),
            (6, "In year 1 the price of the share rose by 2 percent of its old value."), (6, "In year 3 the price of bread fell.")]
    got = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {(1, 1), (2, 2), (3, 2), (4, 1), (5, 2)} <= set(got) <= {(1, 1), (2, 2), (3, 2), (4, 1), (5, 2), (6, 1)}
    assert not got[1, 1].changed and not got[2, 2].changed and got[3, 2].changed and got[4, 1].changed and got[5, 2].changed
    assert all(r.consistent == 1.0 for r in got.values())


def test_exact_windows(spark):
    """Copies of items dense in numbers or names, short, unspaced or in another case are found."""
    items = {1: "12 + 7 = 19, 13 + 8 = 21, 14 + 9 = 23, so 15 + 10 is 25 or 30", 2: "Why now?", 3: "明日の天気はどうですか。", 4: "We saw Anna Berg, Paul Stein, Rosa Klein and Otto Wald in Old Bonn",
             5: "the plain words of this sentence are not names at all", 6: "", 7: "北京"}
    docs = [(1, f"Sum: {items[1]}."), (2, "He asked: why NOW, of all days?"), (3, f"前の文です。{items[3]}次の文です。"), (4, f"Then {items[4].lower()} again."), (5, f"So {items[5].title()}."),
            (6, f"So {items[5].upper()}."), (7, "12 + 7 = 19, and nothing else; why? now?"), (8, "12 13 14 15 16 17 18 19 20 21 22"), (9, "他住在北京市。"), (10, "now why"), (11, None)]
    got = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 5), (7, 2), (9, 7)}
    assert all(not r.changed and r.share == 1.0 for r in got)


def test_planted_passages(spark):
    """Documents that hold a whole item are found, and only those (by plain search for runs of words)."""
    docs = {r.doc_id: " ".join(re.findall(common.WORD_CLASS, (r.text or "").lower())) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: " ".join(re.findall(common.WORD_CLASS, r.text.lower())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if f" {x} " in f" {t} "}
    got = {(r.doc_id, r.item_id) for r in decontamination.op9_decontamination(spark, SF).collect()}
    assert want and got == want


# -- 10 ----------------------------------------------------------------------------------

def test_vectors_without_an_id_or_with_the_same_one(spark):
    rows = [(None, [1.0, 0.0]), (None, [1.0, 0.01]), (7, [1.0, 0.02]), (7, [0.0, 1.0]), (9, [0.0, 1.0]), (3, [0.01, 1.0]), (None, [-1.0, 0.5]), (None, None), (5, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((tuple(r) for r in embedding_dedup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 2, 7, False), (None, 2, 7, False), (7, 2, 7, True), (7, 2, 3, False), (9, 2, 3, False), (3, 2, 3, True), (None, 0, None, False), (None, 0, None, False), (5, 0, 5, True)], key=str)


def test_length_one_in_time_that_follows_the_components():
    import pyarrow as pa

    def seconds(size):
        flat = np.random.default_rng(size).standard_normal(400 * size)
        column = pa.ListArray.from_arrays(pa.array(np.arange(401) * size, pa.int32()), pa.array(flat))
        batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array([1] * 400), column], names=["least", "copies", "v"])
        start = time.perf_counter()
        out = next(embedding_dedup.normalised(iter([batch])))
        took = time.perf_counter() - start
        assert np.allclose(np.linalg.norm(np.array(out["unit"].to_pylist()), axis=1), 1)
        return took

    seconds(16)
    assert min(seconds(1024) for _ in range(5)) < 40 * max(1e-4, min(seconds(64) for _ in range(5)))


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    vectors = {r.vec_id: list(map(float, r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    centre = rng.standard_normal(64)
    for k in range(150):
        vectors[10_000 + k] = (centre + rng.standard_normal(64) * 0.22).tolist()
    for k in range(30):
        vectors[11_000 + k] = vectors[10_000]
    vectors |= {12_000: None, 12_001: [0.0] * 64, 12_002: [1.0] * 63 + [float("nan")], 12_003: [1.0] * 63 + [None], 12_004: [float("inf")] + [1.0] * 63, 12_005: [2.0], 12_006: [3.0], 12_007: [],
                12_008: (centre * 1e200).tolist(), 12_009: (centre * 1e-200).tolist()}
    df = spark.createDataFrame([(i, v, "x") for i, v in vectors.items()], "vec_id long, embedding array<double>, component string")
    ids = [i for i, v in vectors.items() if v and None not in v and np.isfinite(v).all() and any(v) and len(v) == 64]
    unit = np.array([np.array(vectors[i]) / np.abs(vectors[i]).max() for i in ids])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near)) if a < b] + [(12_005, 12_006)]
    counts = {i: 0 for i in vectors} | {i: int(n) for i, n in zip(ids, near.sum(axis=1))} | {12_005: 1, 12_006: 1}
    want = groups_of(vectors, links)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    assert set(got) == set(vectors)
    found, there = sum(r.n_links for r in got.values()), sum(counts.values())
    assert all(r.n_links <= counts[i] for i, r in got.items()) and found >= 0.995 * there
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
    old, embedding_dedup.TILE = embedding_dedup.TILE, 16  # the same in small tiles
    try:
        assert {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df).collect()} == {i: (r.n_links, r.component_id) for i, r in got.items()}
    finally:
        embedding_dedup.TILE = old
