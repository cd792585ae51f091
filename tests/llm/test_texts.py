"""Fingerprints, chat examples, packing, tokens and licenses against brute force, round trips and edge tables."""

import hashlib
import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from logquarry.llm import bpe, chat, fingerprints, licenses, packing
from logquarry.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string"


@pytest.fixture(scope="module")
def edge_docs(spark):
    rows = [
        (5, "one two three four", "en", "a", 18, "x"), (4, None, None, None, None, "x"), (3, "", "en", "b", 0, None),
        (2, "word " * 4000 + "end.", "en", "a", 0, "x"), (1, "one two three four", "en", "a", 18, "x"),
        (1, "one two three four", "en", "a", 18, "x"), (None, "no id é中😀 </s>", "xx", None, 3, "x"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def encoder():
    return bpe.BytePairEncoder(bpe.read_ranks())


@pytest.fixture(scope="module")
def reference(encoder):
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})


# --- fingerprints


def test_common_length_is_the_longest_common_subsequence():
    rng = random.Random(1)

    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b):
                before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
        return row[-1]

    for _ in range(200):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(0, 70))) for _ in range(2))
        assert fingerprints._common_length(a, b) == slow(a, b)


def test_boundaries_depend_on_the_last_seven_bytes_only():
    data = bytes(random.Random(2).randrange(256) for _ in range(500))
    whole = fingerprints.zero_bits(data)
    assert np.array_equal(fingerprints.zero_bits(data[100:])[6:], whole[106:])


def test_fingerprints_of_equal_near_and_unlike_texts():
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400))
    edited = text[:1000] + "CHANGED" + text[1000:]
    other = " ".join("".join(rng.choice("ijklmnop") for _ in range(6)) for _ in range(400))
    a, b, c = map(fingerprints.fingerprint, (text, edited, other))
    assert fingerprints.likeness(a, a) == 1 and 0.8 < fingerprints.likeness(a, b) < 1 and fingerprints.likeness(a, c) == 0
    assert fingerprints.fingerprint(None) == fingerprints.fingerprint("") == "0::"
    assert all(len(s) <= 65 for s in fingerprints.fingerprint("ab" * 50_000).split(":")[1:])


def edited_texts(docs):
    """Brute force: rows in descending doc_id (null last), then text; each with its follower's start."""
    rows = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    for i, (doc_id, text) in enumerate(rows):
        text, follower = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 3
        yield doc_id, text, text[: len(text) - cut] + follower[:cut], follower


@pytest.mark.parametrize("range_rows", [1, 100])
def test_edited_texts_against_brute_force(spark, sf_dir, edge_docs, monkeypatch, range_rows):
    monkeypatch.setattr(fingerprints.neighbour_stream, "__defaults__", (range_rows,))
    for docs in (edge_docs, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        found = sorted((tuple(r) for r in fingerprints.compare_with_edits(docs).collect()), key=str)
        f = fingerprints.fingerprint
        want = []
        for doc_id, text, edited, follower in edited_texts([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]):
            digest = hashlib.sha256(edited.encode()).hexdigest()
            near = fingerprints.likeness(f(text), f(edited)), fingerprints.likeness(f(text), f(follower))
            want.append((doc_id, len(text), digest, f(text), f(edited), *near))
        assert found == sorted(want, key=str)


def test_fingerprints_column_and_empty_table(edge_docs, no_docs):
    assert {r.text: r.fingerprint for r in fingerprints.fingerprints(edge_docs).collect()}[None] == "0::"
    assert fingerprints.compare_with_edits(no_docs).count() == 0


# --- chat


@given(st.lists(st.sampled_from([*"\\<>|[]/sINSTY é\n", "</s>", "[INST]", "<<SYS>>", "<|"]), max_size=30).map("".join))
@settings(max_examples=300, deadline=None)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def test_chat_round_trip_and_examples(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    edge = [(-1, 1, "assistant", None), (-1, 0, "user", "<|x|></s>\\"), (-2, 0, "user", ""), (None, 0, None, "a"), (None, 0, None, "a"), (-3, None, "assistant", "b")]
    turns = turns.unionByName(spark.createDataFrame(edge, turns.schema))
    groups: dict = {}
    for r in turns.collect():
        groups.setdefault(r.conv_id, []).append(r)
    formatted = chat.format_turns(turns)
    found = {r.conv_id: r for r in chat.read_back(chat.render_examples(formatted)).collect()}
    rendered: dict = {}
    for r in chat.render_examples(formatted).where("example IS NOT NULL").collect():
        rendered.setdefault(r.conv_id, []).append(r)
    assert set(found) == set(groups)
    for conv, rows in groups.items():
        rows = sorted(rows, key=lambda r: (r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
        pairs = [(r.role or "", r.text or "") for r in rows]
        replies = [text for role, text in pairs if role == "assistant"]
        row = found[conv]
        assert row.n_turns == len(rows) and row.n_examples == len(replies)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in pairs).encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (sum(map(len, replies)), hashlib.sha256("".join(replies).encode()).hexdigest())
        segments = [f"<|{chat.escape(a)}|>{chat.escape(b)}</s>\n" for a, b in pairs]
        places = [i for i, (role, _) in enumerate(pairs) if role == "assistant"]
        examples = sorted(rendered.get(conv, []), key=lambda r: r.example)
        assert [(r.context, r.reply) for r in examples] == [("".join(segments[:i]), segments[i]) for i in places]
        for r, i in zip(examples, places):
            assert chat.unescape((r.context + r.reply)[r.loss_start : r.loss_end]) == pairs[i][1]
        rest = "".join(segments[places[-1] + 1 :] if places else segments)
        assert row.formatted_chars == sum(len(r.context) + len(r.reply) for r in examples) + len(rest)


def test_chat_query_holds_the_added_conversation(spark, sf_dir):
    row = QUERIES["op2_prefix_target_examples"](spark, sf_dir).where("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_chat_empty_table(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string, position int")
    assert chat.read_back(chat.render_examples(chat.format_turns(turns))).count() == 0


# --- packing


@given(st.lists(st.integers(1, 50), max_size=80))
@settings(max_examples=200, deadline=None)
def test_packing_is_best_fit_decreasing(sizes):
    left, rows = [], []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [(left[r], r) for r in range(len(rows)) if left[r] >= sizes[i]]
        if fits:
            row = min(fits)[1]
        else:
            row = len(rows)
            rows.append([])
            left.append(50)
        rows[row].append(i)
        left[row] -= sizes[i]
    assert packing.best_fit_decreasing(sizes, 50) == rows


def test_packing_is_lossless(spark, sf_dir, edge_docs, no_docs, reference, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for table in (docs, edge_docs):
        packs = packing.packed(table, row_tokens=256, shard_chars=50_000)
        rows = packs.collect()
        pieces: dict = {}
        for r in rows:
            ids, positions = packing.matrix([r.ids])[0], packing.matrix([r.position_ids])[0]
            assert len(ids) == len(positions) == 256 and r.cu_seqlens[-1] == r.n_tokens
            assert (ids[r.n_tokens :] == packing.PAD).all()
            for doc, piece, a, b in zip(r.doc_ids, r.pieces, r.cu_seqlens, r.cu_seqlens[1:]):
                assert positions[a:b].tolist() == list(range(b - a))
                pieces.setdefault(doc, []).append((piece, ids[a:b].tolist()))
        texts: dict = {}
        for r in table.collect():
            texts.setdefault(r.doc_id, []).append(reference.encode_ordinary(r.text or ""))
        for doc, wanted in texts.items():
            want = sorted((i // 256, ids[i : i + 256]) for ids in wanted for i in range(0, len(ids), 256))
            assert sorted(pieces.get(doc, [])) == want
    assert packing.packed(no_docs).count() == 0
    packing.write_packed(packs, f"{tmp_path}/packs")
    assert spark.read.parquet(f"{tmp_path}/packs").count() == len(rows)


# --- byte-pair encoding


def test_every_token_is_its_own_encoding(encoder):
    for rank, token in encoder.tokens.items():
        text = token.decode("utf-8", "ignore")
        if text.encode() == token:
            assert encoder.encode_piece(text) == bpe.packed((rank,))


PARTS = ["a", "b", "the", "ing", " ", "  ", "\n", "'s", "'", "é", "中", "\u200b", "\u3000", "\x1c", "\x85", "\xa0", "1", "²", "Ⅷ", "!", "?", "\t", "\r\n", "Z", "😀", "\u0301", "ß", "٠"]


@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join) | st.text(max_size=60))
@settings(max_examples=1500, deadline=None)
def test_encoding_equals_the_merges(encoder, reference, text):
    if any(0xD800 <= ord(c) < 0xE000 for c in text):
        return
    ids = encoder.encode(text)
    assert ids == reference.encode_ordinary(text) and encoder.decode(ids) == text.encode()


def test_long_runs_and_full_memos(encoder, reference, monkeypatch):
    rng = random.Random(4)
    for text in ("a" * 20_000, "ab" * 9_000, " " * 9_000 + "x", "".join(rng.choice("abcdefghij") for _ in range(20_000))):
        assert encoder.encode(text) == reference.encode_ordinary(text)
    monkeypatch.setattr(bpe, "MEMO_BYTES", 700)
    text = " ".join("".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(200))
    assert bpe.BytePairEncoder(bpe.read_ranks(), encoder.merges).encode(text) == reference.encode_ordinary(text)


def test_round_trip_of_documents(spark, sf_dir, edge_docs, no_docs, reference):
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet"), edge_docs):
        want = []
        for r in docs.collect():
            ids = reference.encode_ordinary(r.text or "")
            digests = hashlib.sha256(" ".join(map(str, ids)).encode()), hashlib.sha256((r.text or "").encode())
            want.append((r.doc_id, len(ids), *(d.hexdigest() for d in digests)))
        assert sorted(map(tuple, bpe.round_trip(docs).collect()), key=str) == sorted(want, key=str)
    with_ids = bpe.encoded(edge_docs)
    back = with_ids.select("text", bpe.decoded(with_ids["ids"], edge_docs).alias("bytes")).collect()
    assert all(bytes(r.bytes) == (r.text or "").encode() for r in back)
    assert bpe.round_trip(no_docs).count() == 0


# --- licenses


def test_differences_of_words():
    assert licenses.differences("a b c d".split(), "x a c y d z".split()) == (["b"], ["y"])


def test_licenses_are_found_and_prose_is_not(spark, no_docs):
    from logquarry.llm.license_texts import MIT_BODY, TEMPLATES

    rows = [(i, f"Some prose here.\n{text}\nMore prose there.") for i, (_, text) in enumerate(TEMPLATES)]
    changed = MIT_BODY.replace("free of charge", "at no cost")
    rows += [(100, "A permission slip for the school trip."), (101, None), (102, ""), (103, "x " * 50_000), (104, changed), (104, changed)]
    found = licenses.license_blocks(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    best = {}
    for r in found:
        if r.confirmed:
            best.setdefault(r.doc_id, set()).add(r.license)
    for i, (name, _) in enumerate(TEMPLATES):
        assert name in best[i], name
    assert 100 not in best and best[104] == {"MIT"} and sum(r.doc_id == 104 for r in found) == 2
    assert {r.doc_id for r in found} <= {*range(len(TEMPLATES)), 100, 104}
    assert licenses.license_blocks(no_docs).count() == 0


def test_license_lines_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.", "GPL-3.0": "This work is licensed under the GNU General Public License, version 3."}
    found = {(r.doc_id, r.license) for r in licenses.license_blocks(docs).where("confirmed").collect()}
    for name, line in lines.items():
        assert {(r.doc_id, name) for r in docs.where(docs["text"].contains(line)).collect()} == {x for x in found if x[1] == name}


SOFTWARE = "Our software is commercial, and we distribute this software to customers of the commercial software market"


def test_licenses_within_prose_of_the_same_vocabulary(spark):
    """Savings are not measured against the prose around a notice, and every template is compared."""
    from logquarry.llm.license_texts import GPL_NOTICE

    texts = {
        "MIT": f"{SOFTWARE}. Released under the MIT License. {SOFTWARE}.",
        "GPL-3.0": f"{SOFTWARE}. " * 20 + GPL_NOTICE.format(version=3) + f" {SOFTWARE}." * 20,
        "CC-BY-NC-4.0": f"Copyright of the {SOFTWARE}. Licensed under CC BY-NC 4.0. {SOFTWARE}.",
    }
    docs = spark.createDataFrame(list(enumerate(texts.values())), "doc_id long, text string")
    found = {(r.doc_id, r.license) for r in licenses.license_blocks(docs).where("confirmed").collect()}
    assert found >= set(enumerate(texts))


@settings(max_examples=200, deadline=None)
@given(st.randoms(use_true_random=False))
def test_places_of_templates_against_all_spans(rng):
    """If the span with fewest differing words is within bounds, it is found, and with no more words."""
    template = [rng.choice("abcdefghij") for _ in range(rng.randint(10, 30))]
    allowed, text = len(template) // 10, list(template)
    for _ in range(rng.randint(0, 2 * allowed + 2)):
        at = rng.randrange(len(text))
        text[at : at + rng.randint(0, 1)] = [rng.choice("abcxyz")] * rng.randint(0, 1)
    text = rng.choices("abcxyz", k=rng.randint(0, 8)) + text + rng.choices("abcxyz", k=rng.randint(0, 8))
    spans = []
    for start in range(len(text)):
        row = [0] * (len(template) + 1)
        for end in range(start + 1, len(text) + 1):
            new = [0]
            for i, word in enumerate(template):
                new.append(row[i] + 1 if word == text[end - 1] else max(row[i + 1], new[-1]))
            row = new
            spans.append((len(template) - row[-1], end - start - row[-1]))
    least = min(map(sum, spans))
    found = licenses.LicenseScanner([("x", " ".join(template))]).places(text, 0, 0, len(text))
    assert all((len(m), len(a)) in spans and max(len(m), len(a)) <= allowed for _, _, _, m, a in found)
    if all(max(s) <= allowed for s in spans if sum(s) == least):
        assert least == min(len(m) + len(a) for _, _, _, m, a in found)


def spaced_edits(template, allowed, fillers):
    """The template with `allowed` words missing and as many added, all evenly spaced: the most that bounds permit."""
    words, gap = list(template), len(template) / (2 * allowed + 1)
    for k in range(2 * allowed, 0, -1):
        at = int(k * gap)
        words[at : at + k % 2] = [] if k % 2 else [next(fillers)]
    return words


def test_savings_of_places_and_of_prose(spark, sf_dir):
    """With as many differences as are allowed, every template still saves clearly more than prose does."""
    scanner = licenses.LicenseScanner()
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect() if r.text]
    prose = [w for text in texts for w in licenses.words(text)]
    rng, compress = random.Random(7), lambda t, w: scanner.saved(t, scanner._bytes(w), len(scanner.window_alone.compress(scanner._bytes(w))))
    hits, noise = [], []
    for t, template in enumerate(scanner.words):
        allowed = scanner.allowed[t]
        length = len(template) + allowed
        size = length + max(1, length // licenses.STEPS) - 1
        for _ in range(20 if len(template) < 300 else 2):
            at = rng.randrange(len(prose) - 2 * size)
            words = spaced_edits(template, allowed, iter(prose[at + size :]))
            spare = size - len(words)
            before = rng.randint(0, spare)
            hits.append(compress(t, prose[at : at + before] + words + prose[at + before : at + spare]))
            noise.append(compress(t, prose[at : at + size]))
    assert min(hits) > 1.5 * licenses.LEAST_SAVED and max(noise) < licenses.LEAST_SAVED


def test_compression_finds_whatever_lookup_finds(spark, sf_dir):
    """Every place that exact words find anywhere in the documents, or in a changed wording, is ranked above noise."""
    from logquarry.llm.license_texts import TEMPLATES

    scanner = licenses.LicenseScanner()
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts = [t for t in texts if t and licenses.blocks(t)]
    rng, fillers = random.Random(3), iter(["inserted"] * 10**6)
    for t, (_, wording) in enumerate(TEMPLATES):
        changed = " ".join(spaced_edits(scanner.words[t], rng.randint(0, scanner.allowed[t]), fillers))
        texts += [f"Words before. {wording}\n{changed}", f"{changed}. {SOFTWARE}. {changed}"]
    confirmed = 0
    for text in texts:
        at = [m.span() for m in licenses._word.finditer(text)]
        found = [text[a:b].lower() for a, b in at]
        firsts = [a for a, _ in at]
        spans = [(licenses.bisect_left(firsts, a), licenses.bisect_left(firsts, b)) for a, b in licenses.blocks(text)]
        through = {p[:3] for _, t, low, high in scanner.stretches(found, spans) for p in scanner.places(found, t, low, high)}
        looked_up = {p[:3] for t in range(len(TEMPLATES)) for p in scanner.places(found, t, 0, len(found))}
        assert looked_up <= through
        confirmed += len(through)
    assert confirmed > 100


def test_nothing_is_confirmed_without_a_saving(monkeypatch):
    from logquarry.llm.license_texts import MIT_BODY

    text = f"{MIT_BODY} Released under the MIT License."
    assert [r[-1] for r in licenses.LicenseScanner().rows(text)] == [True, True]
    monkeypatch.setattr(licenses.LicenseScanner, "saved", lambda *_: 0.0)
    assert [r[-1] for r in licenses.LicenseScanner().rows(text)] == [False]


def test_every_license_of_a_block_is_a_row(spark):
    from logquarry.llm.license_texts import BSD_DISCLAIMER, BSD_THREE, MIT_BODY, whole

    texts = {
        "Released under the MIT License. Licensed under the Apache License, Version 2.0.": ["MIT", "Apache-2.0"],
        f"Notices of copyright.\n{BSD_THREE}{BSD_DISCLAIMER}\n{MIT_BODY}\nLicensed under CC BY 4.0.": ["BSD-3-Clause", "MIT", "CC-BY-4.0"],
        f"A license.\n{whole('GPL-3.0').replace('covered work', 'work')}\nAll rights reserved.": ["GPL-3.0", "All-rights-reserved"],
        whole("GPL-3.0").replace("GENERAL", "AFFERO GENERAL").replace("General", "Affero General"): [],
        whole("Apache-2.0")[:-4000] + " " + whole("MPL-2.0"): ["MPL-2.0"],
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(licenses.license_blocks(docs).collect(), key=lambda r: (r.doc_id, r.start))
    for i, (text, names) in enumerate(texts.items()):
        of = [r for r in rows if r.doc_id == i and r.confirmed]
        assert [r.license for r in of] == names
        assert all(a.end <= b.start for a, b in zip(of, of[1:]))
        for r in of:
            found = sum((licenses.Counter(licenses.words(text[r.start : r.end])), licenses.Counter(r.missing)), licenses.Counter())
            assert found - licenses.Counter(r.added) == licenses.Counter(licenses.words(licenses.TEMPLATES[r.template][1]))
