"""Hard negatives, mixing and periodic runs against brute force."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliosearch.llm import op11_hard_negatives, op12_mixing, op13_periodic, queries
from foliosearch.session import ship_package

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


# -- hard negatives -------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def whole(vector):
    return [max(-op11_hard_negatives.INT_MAX, min(op11_hard_negatives.INT_MAX, math.floor(256 * float(np.float32(x))))) for x in vector]


def sound(rows):
    kept = {}
    for id_, vector, label in rows:
        if id_ is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        own = (label, whole(vector))
        kept[id_] = min(kept.get(id_, own), own)
    return kept


def negatives_of(rows, every):
    kept = sound(rows)
    score = lambda a, b: sum(x * y for x, y in zip(kept[a][1], kept[b][1]))
    out = []
    for a in kept:
        if a % every:
            continue
        ranked = sorted((-score(a, b), b) for b in kept if b != a)
        same = [(b, -s) for s, b in ranked if kept[b][0] == kept[a][0]][:5]
        for positive, p in same:
            within = [(b, -s) for s, b in ranked if kept[b][0] != kept[a][0] and 50 * p <= -100 * s <= 95 * p][:3]
            out += [(a, positive, k, b, p, s) for k, (b, s) in enumerate(within, 1)]
    return sorted(out)


def mined(spark, rows, every, **more):
    df = ship_package(spark).createDataFrame(rows, VECTORS)
    return sorted(tuple(r) for r in op11_hard_negatives.hard_negatives(df, F.col("vec_id") % every == 0, **more).collect())


def clustered(seed, n, width=16, labels=3, lengths=(0.2, 3.0)):
    rnd = np.random.default_rng(seed)
    centre = rnd.normal(size=(labels, width))
    rows = []
    for k in range(n):
        label = int(rnd.integers(labels))
        vector = centre[label if rnd.random() < 0.8 else int(rnd.integers(labels))] + rnd.normal(size=width)
        vector *= rnd.uniform(*lengths) / np.linalg.norm(vector)
        rows.append((k, [float(np.float32(x)) for x in vector], label))
    return rows


def test_hard_negatives_equal_brute_force(spark):
    rows = clustered(3, 900)
    assert mined(spark, rows, 40) == negatives_of(rows, 40)


def test_small_buckets_and_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(op11_hard_negatives, "BLOCK_ROWS", 60)  # several blocks, and two parts of anchors
    rows = clustered(4, 700, labels=2, lengths=(1.0, 1.0))
    assert mined(spark, rows, 1) == negatives_of(rows, 1)


def test_odd_vectors(spark):
    rows = clustered(5, 120, width=4)
    rows += [(None, [1.0] * 4, 1), (200, None, 1), (201, [1.0] * 4, None), (202, [None, 1.0], 0), (203, [float("nan")], 1), (204, [float("inf")], 1)]
    rows += [(40, [0.5] * 4, 0), (40, [0.5] * 4, 0), (300, [], 1), (320, [0.0] * 4, 2), (321, [1.0, 2.0], 2), (322, [0.1] * 7, 0)]
    rows += [(400 + k, [0.25] * 4, k % 3) for k in range(60)]  # one vector, very often: ties by id
    rows += [(1000 + 20 * k, [1e30, -1e30, 3e5, 0.0], k % 2) for k in range(3)]
    got, want = mined(spark, rows, 20), negatives_of(rows, 20)
    assert got == want and {r[0] for r in got} >= {20, 40, 400}


def test_buckets_are_pruned_and_exact():
    rows = sound(clustered(6, 3000, width=32, labels=1, lengths=(0.1, 4.0)))
    ids, vectors = np.array(list(rows)), np.array([v for _, v in rows.values()], float)
    buckets = op11_hard_negatives.buckets_of(ids, np.zeros(len(ids), np.int64), vectors)
    anchors = op11_hard_negatives.Anchors(ids[:50], np.zeros(50, np.int64), vectors[:50])
    scores = vectors @ vectors[:50].T
    least, met = np.sort(scores, axis=0)[-5], 0
    for bucket in buckets:
        where = {a: bucket.ids[r] for a, r in op11_hard_negatives.candidates(bucket, anchors, np.arange(50), least)}
        met += sum(len(x) for x in where.values())
        for a in range(50):
            needed = [i for i in bucket.ids if scores[np.flatnonzero(ids == i)[0], a] >= least[a]]
            assert set(needed) <= set(where.get(a, []))
    assert met < 0.4 * 50 * len(ids)


def test_no_vectors(spark):
    assert mined(spark, [], 2) == []
    assert mined(spark, [(0, [1.0], 1)], 2) == []


def test_other_names_and_numbers(spark):
    rows = clustered(8, 200)
    df = ship_package(spark).createDataFrame(rows, VECTORS).toDF("id", "v", "block").withColumn("part", F.lit("x"))
    got = op11_hard_negatives.hard_negatives(df, F.col("id") % 50 == 0, "id", "v", "block", positives=2, negatives=1)
    first = [r for r in negatives_of(rows, 50) if r[2] == 1]
    best = {}
    for r in first:
        best.setdefault(r[0], set()).add((-r[4], r[1]))
    assert {(r.anchor_id, r.positive_id) for r in got.collect()} <= {(a, p) for a, x in best.items() for _, p in sorted(x)[:2]}


# -- mixing ---------------------------------------------------------------

DOCS = "doc_id long, text string, source string"


def targets_of(sizes, weights, most=3):
    """Exact targets by the rounds in words: share, stop at the limit, share the excess again."""
    total, target, limited = sum(sizes.values()), {}, set()
    while True:
        left = total - sum(most * sizes[s] for s in limited)
        shared = sum(w for s, w in weights.items() if s not in limited)
        target = {s: Fraction(most * sizes[s]) if s in limited else Fraction(left * weights[s], shared) for s in sizes}
        above = {s for s in sizes if target[s] > most * sizes[s]}
        if not above:
            return target
        limited |= above


def planned(rows):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    targets = targets_of(sizes, {s: 1 + k % 3 for k, s in enumerate(order)})
    out = []
    for id_, text, source in rows:
        size = len(WORD.findall(text or ""))
        rate = float(targets[source]) / sizes[source] if sizes[source] else 0.0
        number = int(hashlib.md5(f"mix:{'' if id_ is None else id_}".encode()).hexdigest()[:13], 16) / 16**13
        out.append((id_, size, sizes[source], float(targets[source]), int(rate) + (number < rate - int(rate))))
    return sorted(out, key=repr)


def mixture(seed, n, sources):
    rnd = random.Random(seed)
    return [(k, " ".join("w" * rnd.randint(1, 4) for _ in range(rnd.choice([0, 1, 5, 50]))), rnd.choice(sources)) for k in range(n)]


@pytest.mark.parametrize("sources", [["a"], ["a", "b", None, "é", "Z"], ["big"] * 40 + list("abcdefgh") + ["\U0001f600", "￮"]])
def test_mixing_equals_brute_force(spark, sources):
    rows = mixture(len(sources), 300, sources)
    rows += [(None, "null id", sources[0]), (7, None, sources[0]), (7, None, sources[0]), (9, " \t\n", "blank"), (11, "x y z\x0b\x1fq", "odd")]
    got = op12_mixing.plan_mix(ship_package(spark).createDataFrame(rows, DOCS))
    assert got.columns == ["id", "size", "source_size", "target", "copies"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == planned(rows)


def test_mix_emits_the_copies_with_their_columns(spark):
    rows = mixture(5, 200, ["a", "b", "c"])
    df = ship_package(spark).createDataFrame(rows, DOCS)
    df = df.select("doc_id", "text", "source", *[F.lit(k).alias(c) for k, c in enumerate(("of", "Target", "copy", "_copy", "source_size"))])
    got = op12_mixing.mix(df)
    assert got.columns == df.columns
    seen = {}
    for r in got.collect():
        assert tuple(r)[3:] == (0, 1, 2, 3, 4)
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {r.id: r.copies for r in op12_mixing.plan_mix(df).collect() if r.copies}


def test_targets_are_met_on_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    plan = op12_mixing.plan_mix(ship_package(spark).createDataFrame(docs.select("doc_id", "text", "source").toPandas(), DOCS))
    sums = plan.groupBy("source_size", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("taken")).collect()
    assert all(abs(r.taken - r.target) <= 0.2 * r.target for r in sums)
    assert abs(sum(r.taken for r in sums) / sum(r.target for r in sums) - 1) < 0.03


def test_given_weights(spark):
    rows = [(k, "w " * 10, "ab"[k % 2]) for k in range(100)] + [(500, "w", "c")]
    weights = spark.createDataFrame([("a", 3), ("b", 1)], "source string, weight int")
    got = {r.target for r in op12_mixing.plan_mix(spark.createDataFrame(rows, DOCS), weights=weights).collect()}
    assert got == {1001 * 3 / 4, 1001 / 4, 0.0}
    few = spark.createDataFrame([("c", 2)], "source string, weight int")  # it can take 3 of 1001 words only
    got = {(r.target, r.copies) for r in op12_mixing.plan_mix(spark.createDataFrame(rows, DOCS), weights=few).collect()}
    assert got == {(0.0, 0), (3.0, 3)}


def test_mixing_nothing(spark):
    empty = ship_package(spark).createDataFrame([], DOCS)
    assert op12_mixing.plan_mix(empty).collect() == [] and op12_mixing.mix(empty).collect() == []


# -- periodic runs --------------------------------------------------------


def runs_of(words, least=12):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        k = 0
        while k + q < len(words):
            end = k
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end > k and end - k + q >= max(least, 2 * q):
                found.setdefault((k, end + q), q)
            k = max(end, k + 1)
    return sorted((s, q, e) for (s, e), q in found.items())


def collapsed(words, runs):
    gone = {k for s, q, e in runs for k in range(s + q, e)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def periodic_texts(seed, n):
    rnd = random.Random(seed)
    for _ in range(n):
        words, kinds = [], rnd.choice([1, 2, 3, 40])
        for _ in range(rnd.randint(0, 5)):
            block = [rnd.randrange(kinds) for _ in range(rnd.randint(1, 25))]
            words += (block * rnd.randint(1, 9))[: rnd.randint(1, 130)]
        yield rnd.choice(["", " ", "\n"]) + " ".join(f"w{w}é" for w in words) + rnd.choice(["", "\t"])


@pytest.mark.parametrize("least", [12, 3])
def test_runs_equal_brute_force(spark, least):
    texts = [*periodic_texts(least, 150), None, "", " \t ", "a", "a " * 11, "a " * 12, "a b " * 6, ("x " * 40 + "\n") * 3]
    df = ship_package(spark).createDataFrame(list(enumerate(texts)), "id int, Text string")
    df = df.withColumn("Runs", F.lit(1)).withColumn("start", F.col("id"))
    got = op13_periodic.find_runs(df, least=least)
    assert got.columns == ["id", "Text", "start", "n_words", "runs", "collapsed"]
    for r in got.collect():
        words = WORD.findall(texts[r.id] or "")
        want = runs_of(words, least)
        assert (r.n_words, r.start, r.Text) == (len(words), r.id, texts[r.id])
        assert [(x.start, x.period, x.start + x.length) for x in r.runs] == want
        assert r.collapsed == collapsed(words, want)


def test_runs_of_no_texts(spark):
    assert op13_periodic.find_runs(ship_package(spark).createDataFrame([], "text string")).collect() == []


def test_colliding_letters_are_other_words():
    """Thue-Morse words: no run, and a polynomial hash would call them equal."""
    word = lambda a, b: "".join((a, b)[bin(k).count("1") % 2] for k in range(1024))
    x, y = word("a", "b"), word("b", "a")
    from foliosearch.llm.batches import text_bytes
    import pyarrow as pa

    data, offsets = text_bytes(pa.array([" ".join([x, y] * 7), " ".join([x] * 7 + [y] * 7)]))
    runs = [column.to_pylist() for column in op13_periodic._group(data, offsets, 12)][1]
    assert runs == [[{"start": 0, "length": 14, "period": 2}], []]


@pytest.mark.parametrize("kind", ["one word", "long period", "fibonacci"])
def test_long_texts_in_little_time(kind):
    n = 200_000
    if kind == "one word":
        words, want = np.zeros(n, np.int64), [(0, n, 1)]
    elif kind == "long period":
        words, want = np.tile(np.arange(1000), n // 1000), [(0, n, 1000)]
    else:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        words, want = np.array(b[:n]), None
    start, end, period = op13_periodic.runs_of(words, np.array([0, n]))
    if want:
        assert list(zip(start.tolist(), end.tolist(), period.tolist())) == want
    else:  # periods of a Fibonacci word's runs are Fibonacci numbers
        assert len(start) > 1000 and set(period.tolist()) <= {1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610, 987, 1597, 2584, 4181, 6765, 10946, 17711, 28657, 46368, 75025}


def test_periodic_query_equals_brute_force(spark):
    documents = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.QUERIES["op13_periodic_runs"](spark, FOLDER).collect()}
    assert got.keys() == documents.keys()
    changed = 0
    for id_, text in documents.items():
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(id_).encode()), len(words)
        if h % 10 == 0 and n:
            changed += 1
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = runs_of(words)
        lines = "".join(f"{s},{e - s},{q}\n" for s, q, e in runs)
        best = min(((s - e, s, q) for s, q, e in runs), default=None)
        told = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        digests = tuple(hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, runs)))
        assert tuple(got[id_]) == (id_, len(runs), *told, *digests)
    assert changed > 5
