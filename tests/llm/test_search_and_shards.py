"""Hard negatives, shards and spelling variants against brute force and edge tables."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from logquarry.llm import negatives, sharding, spelling
from logquarry.llm.common import stored
from logquarry.llm.queries import QUERIES
from logquarry.session import shared_dir

# --- spelling variants


def apart(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute_variants(counts):
    near = {w: [v for v in counts if apart(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, counts[w], len(near[w]), form[w], counts[form[w]] if form[w] is not None else None, root))
    return out


def random_words(rng, n, alphabet="abcé", longest=6):
    return sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(n)})


def test_composition_accepts_each_pair_once():
    rng = random.Random(3)
    for alphabet, longest in (("ab", 7), ("abcé", 6), ("aß𝔞z", 5)):
        words = random_words(rng, 500, alphabet, longest)
        left, right = spelling.accepted_pairs(spelling.Acceptor(words))
        found = sorted(tuple(sorted((words[i], words[j]))) for i, j in zip(left, right))
        assert found == sorted(p for p in itertools.combinations(words, 2) if apart(*p))
    for few in ([], [""], ["a"], ["", "a"], ["a" * 5000, "a" * 5001]):
        left, _ = spelling.accepted_pairs(spelling.Acceptor(few))
        assert len(left) == (1 if len(few) == 2 else 0)


def test_acceptor_is_minimal():
    machine = spelling.Acceptor(sorted(a + b for a in ("p", "q", "r") for b in ("ing", "ed", "s")))
    rests = {w[i:] for w in ("ing", "ed", "s") for i in range(1, len(w) + 1)}
    # The start, the state after the first letter, and one state per different rest.
    assert len(machine.finals) == 2 + len(rests)


@pytest.mark.parametrize("symbols", [12, 60, spelling.SYMBOLS])
def test_variants_equal_brute_force_whatever_is_expanded(spark, symbols):
    rng = random.Random(5)
    words = random_words(rng, 160) + ["pre" + w for w in random_words(rng, 120)] + ["aaaa" + "a" * i for i in range(12)]
    counts = {w: rng.choice([1, 2, 3, 7, 50, 200, 999]) for w in dict.fromkeys(words)}
    frame = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n long, prefix string")
    columns = ["word", "n", "n_near", "form", "form_n", "root"]
    found = [tuple(r) for r in spelling.variants(frame, symbols=symbols).select(columns).collect()]
    assert len(found) == len(counts)
    assert set(found) == brute_variants(counts)


def test_variants_edges(spark):
    schema = "word string, n long, shared string, root string"
    assert spelling.variants(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, 5, "s", "r"), ("house", 4, None, None), ("house", 4, None, None), ("horse", None, None, None), ("hause", 3, None, None)]
    found = {r.word: tuple(r) for r in spelling.variants(spark.createDataFrame(rows, schema)).collect()}
    assert set(found) == {"house", "hause"}
    assert found["hause"] == ("hause", 3, 1, "house", 8, "house")


def brute_vocabulary(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in spelling_runs(text or ""):
            key = f"{'' if doc_id is None else doc_id}:{run}".encode()
            h = zlib.crc32(key)
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def spelling_runs(text):
    run = ""
    for c in text + " ":
        if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
            run += c.lower() if c <= "Z" else c
        elif run:
            yield run
            run = ""


def test_vocabulary_equals_brute_force(spark):
    rng = random.Random(8)
    stems = ["Straße", "naïve", "ÉTUDE", "colour", "color", "analyse", "zebra×crossing", "wörter"]
    docs = [(i, " ".join(rng.choices(stems, k=200)) + "𝔞" + "long" * 3000) for i in range(60)]
    docs += [(None, "ghost ghost ghost"), (7, None), (8, ""), (3, docs[3][1]), (3, docs[3][1])]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, word string, n long")
    assert {r.word: r.n for r in spelling.vocabulary(frame).collect()} == brute_vocabulary(docs)
    assert spelling.vocabulary(frame.limit(0)).count() == 0


# --- shards

DOCS = "doc_id long, text string, slot long, shard int, row string, _metadata string, hash int"


def written(spark, frame, name, **options):
    path = shared_dir(spark, name)
    sharding.write_shards(frame, path, **options)
    return sharding.read_shards(spark, path, frame.schema)


def test_shards_keep_every_row_and_law(spark):
    rng = random.Random(4)
    rows = [(i % 40 if i % 3 else None, None if i % 11 == 0 else "same" if i % 3 == 0 else "x" * rng.randrange(60), i, None, "r", "m", 1) for i in range(1003)]
    rows += [rows[5]] * 500 + [(9, "long " * 40_000, 1, 1, "", "", 1)]
    frame = stored(spark.createDataFrame(rows, DOCS), "shard-input")
    for shards, bucket in ((8, 4096), (8, 1 << 24), (2000, 4096), (1, 64)):
        found = written(spark, frame, f"shards-{shards}-{bucket}", shards=shards, bucket_bytes=bucket)
        got = [(r.shard, r.slot, tuple(r.row)) for r in found.collect()]
        assert Counter(g[2] for g in got) == Counter(rows)
        by_shard = Counter(g[0] for g in got)
        counts = [by_shard.get(s, 0) for s in range(shards)]
        assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
        assert all(sorted(g[1] for g in got if g[0] == s) == list(range(n)) for s, n in list(by_shard.items())[:8])
    report = sharding.shard_report(found).collect()
    expected = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in report) == expected
    assert {(r.law, r.grown_shard) for r in report} == {("rows", None)}


def test_shards_repeat_and_mix(spark):
    frame = stored(spark.range(6000).selectExpr("id AS doc_id", "'t' AS text"), "shard-ids")
    one = written(spark, frame, "shards-a", bucket_bytes=2048)
    order = {(r.shard, r.slot): r.row.doc_id for r in one.collect()}
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    again = written(spark, frame, "shards-b", bucket_bytes=2048)
    other = written(spark, frame, "shards-c", bucket_bytes=2048, seed=1)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert {(r.shard, r.slot): r.row.doc_id for r in again.collect()} == order
    assert {(r.shard, r.slot): r.row.doc_id for r in other.collect()} != order
    # Ids of a shard are spread as a random choice would spread them, and neighbours are no longer neighbours.
    for shard in range(8):
        ids = [order[shard, slot] for slot in range(750)]
        assert abs(np.mean(ids) - 3000) < 5 * 1732 / np.sqrt(750)
        assert sum(abs(a - b) == 1 for a, b in zip(ids, ids[1:])) < 6


def test_shards_of_other_inputs(spark):
    empty = spark.createDataFrame([], DOCS)
    assert written(spark, empty, "shards-empty").count() == 0
    # Rows that come out of a join are written first.
    made = spark.range(50).selectExpr("id AS doc_id", "CAST(NULL AS STRING) AS text").join(spark.range(50).selectExpr("id AS doc_id"), "doc_id")
    assert written(spark, made, "shards-made").count() == 50


def test_sharding_stays_native(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = sharding.shuffled(docs, sharding.text_bytes(docs["text"]), bucket_bytes=4096)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan
    assert plan[plan.index("== Physical Plan ==") :].lower().count("exchange shufflepartitionid") == 1


def test_shards_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = QUERIES["op12_two_pass_shards"](spark, sf_dir).collect()
    size = {d.doc_id: (len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in docs}
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in found) == sorted((i, *s) for i, s in size.items())
    counts = Counter(r.shard for r in found)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1


# --- hard negatives


def brute_negatives(rows):
    part = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        whole = tuple(int(np.floor(256 * x)) for x in vector)
        if sum(x * x for x in whole) < 2**53:
            part[vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, whole] = None
    out = []
    for vec_id, label, vector in part:
        if vec_id % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), i, lab) for i, lab, v in part if i != vec_id and len(v) == len(vector))
        for score, positive, _ in [s for s in scored if s[2] == label][:5]:
            window = [s for s in scored if s[2] != label and 30 * -score <= 100 * -s[0] <= 90 * -score]
            out.extend((vec_id, positive, k, s[1], -score, -s[0]) for k, s in enumerate(window[:10], 1))
    return sorted(out)


VECTORS = "vec_id long, embedding array<double>, label int, leaf int, windows string, dim string"


@pytest.mark.parametrize("sample, leaf, block, piece", [(60, 8, 16, 2), (4096, 64, 2048, 8192)])
def test_negatives_equal_brute_force(spark, monkeypatch, sample, leaf, block, piece):
    for name, value in (("SAMPLE", sample), ("LEAF", leaf), ("SPLITS", 4), ("BLOCK", block), ("PIECE", piece)):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 8))
    rows = [(i * 5, (centres[rng.integers(12)] + 0.3 * rng.normal(size=8)).tolist(), int(rng.integers(4))) for i in range(500)]
    hot = rng.normal(size=8).tolist()
    rows += [(10_000 + i, hot, 3 if i % 5 else 1) for i in range(300)]
    rows += [(20_000, None, 1), (20_100, [float("nan")] * 8, 1), (20_200, [1.0, None], 1), (20_300, hot, None), (None, hot, 2)]
    rows += [(20_400, [0.0] * 8, 1), (20_500, [1.0, 2.0], 1), (20_505, [1.0, 2.0], 1), (20_511, [0.5, 1.0], 2), (20_600, [], 1), (20_601, [], 2)]
    rows += [(20_700, [1e200] * 8, 1), rows[3], rows[3]]
    frame = spark.createDataFrame([(*r, 1, "w", "d") for r in rows], VECTORS)
    found = sorted(tuple(r) for r in negatives.hard_negatives(frame).collect())
    want = brute_negatives(rows)
    assert len(want) > 100 and found == want


def test_negatives_of_empty_tables(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], VECTORS)).count() == 0
    alone = spark.createDataFrame([(100, [1.0], 1, 1, "", "")], VECTORS)
    assert negatives.hard_negatives(alone).count() == 0


def test_tree_passes_over_leaves_and_loses_none(monkeypatch):
    monkeypatch.setattr(negatives, "LEAF", 16)
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(20, 8))[rng.integers(20, size=3000)] * 8 + rng.normal(size=(3000, 8))
    length = float((rows**2).sum(axis=1).max())
    tree = negatives.Tree(negatives.raised(rows[:400], length))
    leaf, seen = tree.route(negatives.raised(rows, length))
    tree.set_ranges(seen)
    anchors = np.hstack([rows[:50], np.zeros((50, 1))])
    gaps = negatives.distances(anchors, negatives.raised(rows, length))
    near, far = np.quantile(gaps, 0.02, axis=1), np.quantile(gaps, 0.05, axis=1)
    who, where = tree.search(anchors, near, far, np.full(50, 1e-6))
    reached = set(zip(who.tolist(), where.tolist()))
    inside = (gaps >= near[:, None]) & (gaps <= far[:, None])
    assert {(int(i), int(leaf[j])) for i, j in zip(*np.nonzero(inside))} <= reached
    assert len(reached) < 0.6 * 50 * tree.leaves
