"""Mixing, line and document near-duplicates, vectors, language and the pipeline against brute force and edge tables."""

import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from logquarry.llm import common, language, lines, mixing, simhash, vectors
from logquarry.llm.common import connected_components
from logquarry.llm.links import forest
from logquarry.llm.queries import ORACLES, QUERIES

from check import compare, duck

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, hash string"


def table(spark, rows):
    full = [(i, t, "en", s, len(t) if t is not None else None, "x", None) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS)


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def random_links(rng, n, m):
    return [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]


def test_forest_and_connected_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(1000, 1060)]
    for links in ([(3, 1)], random_links(rng, 80, 50), chain + [(0, x) for x in range(2, 400)]):
        want = components({x for p in links for x in p}, links)
        a, b = (np.array(x) for x in zip(*links))
        assert dict(zip(*(x.tolist() for x in forest(a, b)))) == want
        found = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "src long, dst long")).collect()}
        assert found == {k: v for k, v in want.items() if k in found}
        assert {k for k, v in want.items() if k != v} <= set(found)
    assert connected_components(spark.createDataFrame([(1, 1), (None, 2)], "src long, dst long")).count() == 0


# --- mixing


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir).toArrow(), duck(sf_dir).sql(ORACLES[name]).to_arrow_table()) == ""


def targets(sizes, weights, share, most):
    """Brute force: what is above a source's cap is shared by weight among the others, again and again."""
    got, open_, left = dict.fromkeys(sizes, 0.0), set(sizes), share * sum(sizes.values())
    while open_ and left > 1e-9:
        total, over = sum(weights[s] for s in open_), 0.0
        for s in list(open_):
            got[s] += left * weights[s] / total
        for s in list(open_):
            if got[s] > most * sizes[s]:
                over += got[s] - most * sizes[s]
                got[s] = float(most * sizes[s])
                open_.discard(s)
        left = over
    return got


def test_mix_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(1, 60), rng.choice(["a", "b", "B", "é", None, "hot", "hot", "hot"])) for i in range(600)]
    rows += [(1000, None, "a"), (1001, "", "empty"), (None, "x y", "a"), (1002, " \t\n", None), (5, rows[5][1], rows[5][2])]
    docs = table(spark, rows)
    found = mixing.mix_report(docs).collect()
    assert len(found) == len(rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = targets(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5, 2)
    sources = {i: s for i, _, s in rows}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in found:
        source = sources[r.doc_id]
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    for source, words in taken.items():
        # A repeated row is taken or left as a whole.
        assert abs(words - want[source]) <= largest[source]
    copies = Counter(r.doc_id for r in mixing.mixed(docs).collect())
    assert all(copies[r.doc_id] * r.size == r.taken for r in found if r.size and r.doc_id not in (5, None))
    assert mixing.mixed(docs).columns == docs.columns
    assert sorted(map(str, mixing.mix_report(docs.repartition(7)).collect())) == sorted(map(str, found))
    assert mixing.mix_report(table(spark, [])).count() == 0 and mixing.mixed(table(spark, [])).count() == 0


def test_smaller_mixes_nest(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    small, large = ({r.doc_id: r.taken for r in mixing.mix_report(docs, weights=(1,), share=s).collect()} for s in (0.3, 0.6))
    assert all(large[i] >= small[i] for i in small) and sum(small.values()) < sum(large.values())


# --- lines


def brute_lines(rows):
    parts = [(i, n, x) for i, t in rows for n, x in enumerate((t or "").split("\n")) if x.strip(lines.BLANK)]
    texts = sorted({x for _, _, x in parts})
    sets = [{x[i : i + 6] for i in range(max(1, len(x) - 5))} for x in texts]
    links = []
    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small >= 0.8 * large:
                common = len(sets[a] & sets[b])
                if common >= 0.8 * (small + large - common):
                    links.append((a, b))
    root = components(range(len(texts)), links)
    place = {x: i for i, x in enumerate(texts)}
    groups = defaultdict(list)
    for i, n, x in parts:
        groups[root[place[x]]].append((i is not None, i or 0, n))
    return {(i, n): min(groups[root[place[x]]])[1:] for i, n, x in parts if i is not None}, links


def near_lines(seed, n=60):
    rng = random.Random(seed)

    def words(k):
        return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(k)]

    rows, bases = [], [words(k) for k in (12, 30, 80, 200)]
    for i in range(n):
        texts = []
        for _ in range(4):
            line = list(rng.choice(bases)) if rng.random() < 0.7 else words(rng.randrange(1, 25))
            for _ in range(rng.randrange(0, 1 + len(line) // 20)):
                line[rng.randrange(len(line))] = words(1)[0]
            texts.append(" ".join(line))
        rows.append((i, "\n".join([*texts, "ab", "  ", ""])))
    return rows


def test_lines_against_brute_force(spark, monkeypatch):
    rows = near_lines(3) + [(900, None), (901, ""), (902, " \n\t\n"), (903, "x" * 70_000 + "\n" + "x" * 70_000), (904, rows_text := "equal line here\nequal line here")]
    rows.append((904, rows_text))
    monkeypatch.setattr(lines, "BLOCK", 8)
    monkeypatch.setattr(lines, "SMALL", 2)
    monkeypatch.setattr(lines, "HOT", 64)
    monkeypatch.setattr(lines, "SAMPLE", 4)
    docs = table(spark, [(i, t, "s") for i, t in rows])
    want, links = brute_lines(rows)
    found = {(r.doc_id, r.line_no): (r.first_doc_id, r.first_line_no) for r in lines.line_groups(docs).collect()}
    assert set(found) == set(want) and len(links) > 100
    # Banding finds 99.8 % of the pairs at the threshold, and components need a part of them.
    assert sum(found[k] != want[k] for k in want) <= 0.01 * len(want)
    kept = {r.doc_id: r.text for r in lines.without_repeated_lines(docs).collect()}
    for i, text in rows:
        parts = (text or "").split("\n")
        left = [x for n, x in enumerate(parts) if (i, n) not in found or found[i, n] == (i, n)]
        if any(x.strip(lines.BLANK) for x in left) or not (text or "").strip(lines.BLANK):
            assert kept[i] == (text if text is None else "\n".join(left))
        else:
            assert i not in kept
    assert lines.without_repeated_lines(docs).columns == docs.columns
    assert lines.line_groups(table(spark, [])).count() == 0


def test_lines_beyond_every_limit(spark, monkeypatch):
    """Many groups, no broadcast of candidates, sizes or removed lines: the same result."""
    docs = table(spark, [(i, t, "s") for i, t in near_lines(4, 20)])
    want = sorted(map(str, lines.line_groups(docs).collect()))
    kept = sorted(map(str, lines.without_repeated_lines(docs).collect()))
    monkeypatch.setattr(lines, "GROUP_BYTES", 4096)
    monkeypatch.setattr(lines, "HELD_ROWS", 160)
    monkeypatch.setattr(lines, "SAMPLE", 2)
    monkeypatch.setattr(lines, "HOT", 16)
    monkeypatch.setattr(lines, "BROADCAST_LINES", 0)
    monkeypatch.setattr(lines, "small_side", lambda df, *args, **options: df)
    assert sorted(map(str, lines.line_groups(docs).collect())) == want
    assert sorted(map(str, lines.without_repeated_lines(docs).collect())) == kept


def test_texts_of_other_lines_stay_where_they_are(spark, monkeypatch):
    """Beyond the limit of the broadcast too."""
    monkeypatch.setattr(lines, "BROADCAST_LINES", 10)
    texts = [f"line number {i} of them\nanother line {i * i}, longer" for i in range(3000)]
    docs = table(spark, [(i, t, "s") for i, t in enumerate(texts)])
    wanted = {lines.line_id(x): x for t in texts[::20] for x in t.split("\n")}
    found = {r.node: r.line for r in lines.candidate_texts(docs, spark.createDataFrame([(x,) for x in wanted], "node long")).collect()}
    assert wanted.items() <= found.items() and len(found) < 2 * len(wanted)


def test_packed_rows_come_back():
    random = np.random.default_rng(3)
    keys, nodes, sketch = random.integers(-(2**63), 2**63 - 1, (3, 5000))
    keys[:2000], nodes[0] = keys[0], -1
    hot = lines.HotKeys(keys[:1], np.array([3], dtype=np.int32))
    batch = lines.packed_rows(keys, nodes, sketch, 7, hot)
    back, at = set(), {}
    for group, blob in zip(batch["group"].to_pylist(), batch["rows"]):
        inside, own, bits = lines.unpacked_rows([blob.as_buffer()])
        part, parts = hot.of(inside, own)
        assert 0 <= group < 7 and set(parts[inside == hot.keys[0]].tolist()) <= {3}
        for row in zip(inside.tolist(), own.tolist(), bits.tolist(), part.tolist()):
            back.add(row[:3])
            assert at.setdefault((row[0], row[3]), group) == group
    assert back == set(zip((keys & (2**40 - 1)).tolist(), nodes.tolist(), sketch.tolist()))


def test_shuffles_of_finished_steps_are_deleted(spark, monkeypatch):
    monkeypatch.setattr(common, "LARGE_INPUT", 0)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle")}

    docs, before = spark.range(20_000), shuffled()
    common.stored(docs.repartition(5, "id"), "freed")
    assert shuffled() - before
    common.free_shuffles(docs)
    deadline = time.time() + 20
    while shuffled() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffled() - before


def test_few_lines_link_like_many():
    random = np.random.default_rng(2)
    for n in (2, 3, 9, 16):
        whole = [random.choice(12, random.integers(1, 12)).astype(np.uint64) for _ in range(n)]
        every = np.arange(n)
        expected = lines.block_links([np.unique(x) for x in whole], every, every, 0.5)
        assert [list(side) for side in lines.few_links(whole, 0.5)] == [side.tolist() for side in expected]


def test_signature_estimates_jaccard():
    rng = random.Random(5)
    for _ in range(30):
        a = "".join(rng.choice("abcdefgh") for _ in range(400))
        b = a[:350] + "".join(rng.choice("abcdefgh") for _ in range(50))
        x, y = ({s[i : i + 6] for i in range(len(s) - 5)} for s in (a, b))
        first, second = lines.signatures([a, b])
        assert abs((first == second).mean() - len(x & y) / len(x | y)) < 0.25


# --- SimHash


def slow_fingerprint(text, words=3):
    parts = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    shingles = [b" ".join(parts[i : i + words]) for i in range(len(parts) - words + 1)] or ([b" ".join(parts)] if parts else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_keys_meet_for_all_patterns_of_three_bits():
    patterns, counts = simhash.error_patterns()
    assert counts.sum() == 1 + 23 + 253 + 1771 + 8855 and set(counts.tolist()) == {1, 6}
    rng = np.random.default_rng(6)
    a = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    b = a.copy()
    for _ in range(3):
        b ^= np.uint64(1) << rng.integers(0, 64, len(b), dtype=np.uint64)
    looked, filed = defaultdict(set), defaultdict(set)
    for values, keep, into in ((a, True, looked), (b, False, filed)):
        key, owner, probe = simhash.keys_of(values, patterns, counts)
        for k, o in zip(key[probe == keep].tolist(), owner[probe == keep].tolist()):
            into[o].add(k)
    assert all(looked[x] & filed[y] for x, y in zip(a.tolist(), b.tolist()))


def test_links_of_fingerprints_against_brute_force(spark, monkeypatch):
    rng = random.Random(7)
    values = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(500):
        x = rng.choice(values[-60:])
        for _ in range(rng.randrange(1, 5)):
            x ^= 1 << rng.randrange(64)
        values.append(x)
    signed = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    for bits in (0, 1, 3):
        links = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= bits]
        want = components(signed, links)
        for block in (2048, 3):
            monkeypatch.setattr(simhash, "BLOCK", block)
            found = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long"), bits)
            assert components(signed, [(r.src, r.dst) for r in found.collect()]) == want


def test_simhash_of_documents_against_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows += [(5000, None, "s"), (5001, "", "s"), (5002, " \n", None), (5003, "Wörter ZWEI", "s"), (5004, "wörter zwei", "s"), (None, "wörter zwei", "s"), (5003, "Wörter ZWEI", "s"), (5005, "long " * 70_000, "s")]
    docs = table(spark, rows)
    marks = [(i, slow_fingerprint(t)) for i, t, _ in rows]
    root = components(range(len(marks)), [(a, b) for a in range(len(marks)) for b in range(a) if (marks[a][1] ^ marks[b][1]).bit_count() <= 3])
    least = {}
    for at, (i, _) in enumerate(marks):
        if i is not None:
            least[root[at]] = min(i, least.get(root[at], i))
    want = sorted((str(i), f"{m:016x}", least.get(root[at])) for at, (i, m) in enumerate(marks))
    found = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert found == want
    left = simhash.without_near_duplicates(docs)
    assert left.columns == docs.columns
    gone = {int(i) for i, _, c in want if i != "None" and int(i) != c}
    assert Counter(r.doc_id for r in left.collect()) == Counter(i for i, _, _ in rows if i not in gone)
    assert simhash.near_duplicates(table(spark, [])).count() == 0


def test_simhash_leaves_no_group_empty_when_ids_repeat(spark):
    a, b = "one text about rivers and the sea", "quite another thing entirely, told at length"
    docs = table(spark, [(1, a, "s"), (2, a, "s"), (0, b, "s"), (1, b, "t")])
    left = simhash.without_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.source) for r in left.collect()) == [(0, b, "s"), (1, a, "s")]


# --- vectors


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(8)
    q = rng.standard_normal((400, 64))
    o = q + 0.2 * rng.standard_normal((400, 64))
    q, o = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (q, o))
    codes, factors = vectors.encode(o)
    found, true = vectors.estimates(q, codes, factors), q @ o.T
    assert abs((found - true).mean()) < 2e-3
    bound = np.sqrt(1 - factors**2)[None, :] / factors[None, :] * np.sqrt(np.maximum(0, 1 - true**2))
    assert (np.abs(found - true) <= bound + 1e-4).all()


def test_vector_links_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(9)
    base = rng.standard_normal((6, 24))
    rows = []
    for i in range(400):
        v = base[i % 6] + rng.standard_normal(24) * rng.choice([0.05, 0.15, 1.0])
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 5 == 0) if i % 11 else None, "x"))
    odd = [None, [], [0.0] * 24, [None] * 24, [float("nan")] * 24, [float("inf")] * 24, [1.0, 2.0], [2.0, 4.0], [3.0]]
    rows += [(1000 + i, v, 0, "x") for i, v in enumerate(odd)] + [(None, rows[0][1], 1, "x"), rows[5]]
    monkeypatch.setattr(vectors, "BLOCK", 64)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n_links string")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(frame).collect()}
    good = {}
    for i, v, label, _ in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = (np.array(v, dtype=np.float64), label)
    links = [
        (a, b) for a in good for b in good
        if a < b and good[a][1] == good[b][1] and len(good[a][0]) == len(good[b][0])
        and good[a][0] @ good[b][0] / (np.linalg.norm(good[a][0]) * np.linalg.norm(good[b][0])) >= 0.98
    ]
    root = components({i for i, *_ in rows if i is not None}, links)
    count = Counter(x for p in links for x in p)
    assert len(links) > 200 and found.pop(None) == (0, None, True)
    assert found == {i: (count[i], r, r == i) for i, r in root.items()}
    assert vectors.near_duplicates(frame.limit(0)).count() == 0


# --- language


def test_language_accuracy_on_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.fit(docs.where("doc_id % 2 = 0"))
    found = language.document_languages(docs.where("doc_id % 2 = 1"), model).collect()
    assert sum(r.lang == r.language for r in found) >= 0.97 * len(found)
    assert sum(r.language_accepted for r in found) >= 0.99 * len(found)


def test_language_sample_counts_different_texts(spark):
    """Copies neither fill the sample nor push other texts out of it."""
    texts = [(f"the {i} words of text {chr(97 + i % 26) * 3} {chr(97 + i // 26) * 3}", "en") for i in range(100)]
    docs = spark.createDataFrame(texts, "text string, lang string")
    copies = docs.unionByName(spark.createDataFrame(texts[:1] * 3000, docs.schema))
    for sample in (1000, 40):
        assert (language.fit(copies, sample_texts=sample).table == language.fit(docs, sample_texts=sample).table).all()


def test_language_evidence_is_fused(spark, sf_dir):
    model = language.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    body = "Und die schichte der verein zu einen lichkeit mit dem nicht und die eine."
    pages = [(i, f"http://www.beispiel.de/{i}", f'<html lang="de"><script>the of and</script><p>{body}</p></html>') for i in range(30)]
    pages += [(100, "http://www.beispiel.de/x", "<html><p>e</p></html>"), (101, "http://other.fr/", '<html lang="fr-CA"><p>e</p></html>'), (102, None, None), (103, "no address", "<p>123</p>"), (0, pages[0][1], pages[0][2])]
    rows = language.page_languages(spark.createDataFrame(pages, "page_id long, url string, html string"), model).collect()
    found = {r.page_id: r for r in rows}
    assert len(rows) == len(pages) and all(found[i].language == "de" and found[i].language_accepted for i in range(30))
    assert found[100].language == "de"  # a single letter says little, its host much
    assert found[102].language is None and not found[102].language_accepted and not found[103].language_accepted


def test_rejected_and_edge_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = [(9000, None, "en", None, 0), (9001, "", "en", "s", 0), (9002, "12 34 !!", "en", "s", 0), (9003, "これは日本語の文章です。" * 20, "ja", "s", 0), (None, docs.first().text, "en", None, 0)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).selectExpr("*", "'x' AS language")
    kept = language.accepted_documents(docs)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns and None in ids and not ids & {9000, 9001, 9002, 9003}
    assert kept.first().language == "x" and len(ids) >= 0.99 * 200
    assert language.accepted_documents(docs.limit(0)).count() == 0


# --- pipeline


def test_pipeline_stages_by_brute_force(spark, sf_dir):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for number, (name, stage) in enumerate(pipeline.STAGES[:-1]):
        before = docs.collect()
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
        after = docs.collect()
        assert docs.columns == columns and after, name
        if number == 0:
            assert {r.doc_id for r in before} == {r.doc_id for r in after}
        if number == 1:
            want, _ = brute_lines([(r.doc_id, r.text) for r in before])
            left = {r.doc_id: r for r in after}
            for r in before:
                parts = [x for n, x in enumerate(r.text.split("\n")) if want.get((r.doc_id, n), (r.doc_id, n)) == (r.doc_id, n)]
                if any(x.strip(lines.BLANK) for x in parts):
                    assert left[r.doc_id].text == "\n".join(parts) and left[r.doc_id].n_chars == len(left[r.doc_id].text)
                else:
                    assert r.doc_id not in left
        if number == 2:
            marks = {r.doc_id: slow_fingerprint(r.text) for r in before}
            root = components(marks, [(a, b) for a in marks for b in marks if a < b and (marks[a] ^ marks[b]).bit_count() <= 3])
            assert {r.doc_id for r in after} == set(root.values())
        if number == 3:
            sizes = {r.doc_id: r.taken // r.size for r in mixing.mix_report(spark.createDataFrame(before, docs.schema)).collect() if r.size}
            assert Counter(r.doc_id for r in after) == Counter({i: n for i, n in sizes.items() if n})
    last = pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert len(last) == docs.count() and all(r.n_tokens == len(r.ids) for r in last)
    assert pipeline.run(spark, sf_dir).count() == len(last)


# --- names, extremes and recall

CLASHING = ("row", "hash", "doc_key", "gone", "key", "value", "lane", "_id_text", "_id_n_host", "_mix_source", "_mix_copy", "_lines_key", "language", "fp", "class", "first", "component", "declared", "_text")


def test_no_column_name_clashes(spark):
    rng = random.Random(12)
    words = "der Hund und die Katze laufen heute in den großen Garten weil es regnet und niemand mehr wartet".split()
    rows = [(i, "\n".join(" ".join(rng.choices(words, k=14)) for _ in range(3)), "de", f"s{i % 3}", 7, *["kept"] * len(CLASHING)) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING))
    for operator in (language.accepted_documents, lines.without_repeated_lines, simhash.without_near_duplicates, mixing.mixed):
        found = operator(frame)
        assert found.columns == frame.columns
        out = found.collect()
        assert out and all(r[c] == "kept" for r in out for c in CLASHING)
    pages = frame.selectExpr("doc_id AS page_id", "concat('<html lang=de>', text) AS html", "'http://a.b.de/x' AS url", *CLASHING)
    out = language.page_languages(pages, language.fit(frame)).collect()
    assert out and all(r.declared == "de" and r._id_text == "kept" and r.row == "kept" for r in out)


def test_vectors_of_any_size_link(spark):
    rows = [(1, [1e-200, 0.0], 1), (2, [1e-200, 0.0], 1), (3, [1e200, 0.0], 2), (4, [2e200, 1.0], 2), (5, [5e-324, 0.0], 1), (6, [0.0, 0.0], 1)]
    found = {r.vec_id: r.component_id for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 3, 5: 1, 6: 6}


def test_templated_lines_are_tied(spark):
    """Lines that share a template fill buckets with lines below the threshold; nearly all true pairs must still be found."""
    rng = random.Random(21)
    names = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(12)]
    texts = [f"The {rng.choice(names)} department of {rng.choice(names)} was closed on {rng.randrange(28)} {rng.choice(names)} by order of the council of the region" for _ in range(900)]
    texts = sorted(set(texts))
    sets = [set(lines.shingle_hashes([x])[0].tolist()) for x in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert len(pairs) > 50
    found = {r.doc_id: (r.first_doc_id, r.first_line_no) for r in lines.line_groups(table(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    assert sum(found[i] == found[j] for i, j in pairs) >= 0.99 * len(pairs)
