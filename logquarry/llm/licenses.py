"""License scan by conditional compression, confirmed by word differences.

Blocks of license vocabulary and the words around them are cut into windows a little longer than each template, and every
window is compressed by zstandard with and without the template as a raw dictionary. What that saves, as a share of the
template's own compressed size, ranks the templates; every one above noise is compared word by word, whatever its rank.
The exact comparison alone then tells licenses of nearly the same wording apart.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.llm.license_texts import TEMPLATES

# Both engines read this pattern alike: ASCII only, no case.
CUES = r"licen[cs]|copyright|permission|permitted|distribut|warrant|public domain|all rights reserved|software|liabilit|merchantab|disclaim|commercial"
# Sentences without a cue that may lie between two of a block.
GAP = 2
# Share of a template's words that may be missing or come in between.
TOLERANCE = 0.1
# Words that tell licenses of nearly the same wording apart: a place that lacks or adds one is another license.
TELLING = {"affero", "lesser"}
# Words by which pieces of templates are looked up.
SEED = 3
LEVEL = 19
# Windows are compressed at this level, and begin this often per length of the longest place of a template.
WINDOW_LEVEL = 3
STEPS = 4
# Least share of a template's own compressed size that it must save of a window to be compared word by word. Prose saves up
# to 0.09, places with as many differing words as the bounds allow over 0.22 (test_savings_of_places_and_of_prose).
LEAST_SAVED = 0.15

FOUND = (
    "doc_id long, block int, start int, end int, license string, template int, reduction double, "
    "missing array<string>, added array<string>, confirmed boolean"
)

_cue = re.compile(CUES, re.IGNORECASE | re.ASCII)
_sentence = re.compile(r"[^\n]+?(?:[.;:!?]+(?=\s)|(?=\n)|\Z)")
_word = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")


def words(text: str) -> list[str]:
    return _word.findall(text.lower())


def blocks(text: str | None, gap: int = GAP) -> list[tuple[int, int]]:
    """Spans in code points: runs of sentences with a cue, and up to `gap` sentences without between them."""
    found: list[list[int]] = []
    quiet = 0
    for sentence in _sentence.finditer(text or ""):
        start = sentence.start() + len(sentence[0]) - len(sentence[0].lstrip())
        if _cue.search(sentence[0]):
            if found and quiet <= gap:
                found[-1][1] = sentence.end()
            else:
                found.append([start, sentence.end()])
            quiet = 0
        else:
            quiet += 1
    return [(a, b) for a, b in found]


def differences(template: list[str], block: list[str]) -> tuple[list[str], list[str]]:
    """Words of the template that the block lacks, and words of the block between matching ones that it adds."""
    pieces = SequenceMatcher(None, template, block, autojunk=False).get_matching_blocks()[:-1]
    missing, added, a, b = [], [], 0, pieces[0].b if pieces else len(block)
    for piece in pieces:
        missing += template[a : piece.a]
        added += block[b : piece.b]
        a, b = piece.a + piece.size, piece.b + piece.size
    return missing + template[a:], added


def align(template: list[str], text: list[str], starts: int, allowed: int) -> tuple[int, int, list[str], list[str]] | None:
    """The place in `text` that holds the template with the fewest differing words, if it begins within the first `starts`
    words and of these at most `allowed` are missing and as many added: first word, end, missing and added words, else None.

    Row d holds, per diagonal (place in the text less place in the template), the furthest word of the template that d
    differing words reach (Landau and Vishkin); equal words are passed for nothing.
    """
    m, n, none = len(template), len(text), -(10**9)
    # Diagonals from -allowed to starts - 1 + allowed, and one that is never reached on both sides.
    width = starts + 2 * allowed + 2

    def along(i: int, c: int) -> int:
        while i < m and i + c < n and template[i] == text[i + c]:
            i += 1
        return i

    def result(d: int, x: int):
        missing, added, first, end = [], [], None, None
        while True:
            i, before = table[d][x], table[d - 1] if d else None
            base = max(before[x], before[x + 1] + 1, before[x - 1]) if d else 0
            c = x - 1 - allowed
            if base < i:
                first, end = base + c, end or i + c
            if not d:
                return first, end, missing[::-1], added[::-1]
            if base == before[x - 1] and base != before[x]:
                added.append(text[base + c - 1])
                x -= 1
            elif base != before[x]:
                missing.append(template[base - 1])
                x += 1
            d -= 1

    table = [[none if not 0 <= x - 1 - allowed < min(starts, n) else along(0, x - 1 - allowed) for x in range(width)]]
    ended: set[int] = set()
    for d in range(2 * allowed + 1):
        if d:
            last, row = table[-1], [none] * width
            for x in range(1, width - 1):
                i = max(last[x], last[x + 1] + 1, last[x - 1])
                if i >= 0 and i <= m and i + x - 1 - allowed <= n:
                    row[x] = along(i, x - 1 - allowed)
            table.append(row)
        for x in range(width):
            if table[d][x] == m and x not in ended:
                ended.add(x)
                first, end, missing, added = result(d, x)
                if first is not None and max(len(missing), len(added)) <= allowed:
                    return first, end, missing, added
    return None


class LicenseScanner:
    """Finds templates (name, wording) in texts; a wording's place in the list is its number."""

    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES):
        self.names = [name for name, _ in templates]
        self.words = [words(text) for _, text in templates]
        self.counts = [Counter(w) for w in self.words]
        self.allowed = [int(TOLERANCE * len(w)) for w in self.words]
        self.alone = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        texts = [" ".join(text.lower().split()).encode() for _, text in templates]
        dictionaries = [zstandard.ZstdCompressionDict(text, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for text in texts]
        self.given = [zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False) for d in dictionaries]
        self.own = [len(self.alone.compress(text)) for text in texts]
        # The same over words, prepared once for the many windows; templates of one length share their windows.
        self.window_alone = zstandard.ZstdCompressor(level=WINDOW_LEVEL, write_content_size=False)
        self.window_given, self.window_own = [], []
        self.lengths: dict[int, list[int]] = {}
        for t, template in enumerate(self.words):
            known = zstandard.ZstdCompressionDict(self._bytes(template), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=WINDOW_LEVEL)
            self.window_given.append(zstandard.ZstdCompressor(level=WINDOW_LEVEL, dict_data=known, write_content_size=False))
            self.window_own.append(len(self.window_alone.compress(self._bytes(template))))
            self.lengths.setdefault(len(template) + self.allowed[t], []).append(t)
        # Pieces of each template by their first words: one more than the differences allowed, so one of them stays whole.
        self.seeds: list[dict[tuple[str, ...], list[tuple[int, list[str]]]]] = []
        for t, (template, allowed) in enumerate(zip(self.words, self.allowed)):
            pieces = 2 * allowed + 1
            self.seeds.append({})
            for k in range(pieces):
                a, b = k * len(template) // pieces, (k + 1) * len(template) // pieces
                if b - a < SEED:
                    raise ValueError(f"template {t} has fewer than {SEED} words in a piece")
                self.seeds[t].setdefault(tuple(template[a : a + SEED]), []).append((a, template[a:b]))

    @staticmethod
    def _bytes(found: list[str]) -> bytes:
        return " ".join(found).encode("utf-8", "surrogatepass")

    def saved(self, t: int, window: bytes, alone: int) -> float:
        """Share of template t's own size that knowing it saves of a window of `alone` bytes compressed without it."""
        return (alone - len(self.window_given[t].compress(window))) / self.window_own[t]

    def stretches(self, found: list[str], spans: list[tuple[int, int]]) -> list[tuple[float, int, int, int]]:
        """Share saved, template, first word and end of every run of windows in which a template saves more than noise,
        largest share first.

        `spans` are blocks in words. Every wording holds a cue, so a place reaches into a block and lies within its own
        length of it; a window at every quarter of that length holds the whole place.
        """
        result = []
        for length, templates in self.lengths.items():
            step = max(1, length // STEPS)
            merged: list[list[int]] = []
            for a, b in spans:
                a, b = max(0, a - length), min(len(found), b + length)
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            for low, high in merged:
                fitting = [t for t in templates if high - low >= len(self.words[t]) - self.allowed[t]]
                runs: dict[int, list] = {}
                for a in range(low, max(low + 1, high - length + step), step) if fitting else ():
                    b = min(a + length + step - 1, high)
                    window = self._bytes(found[a:b])
                    alone = len(self.window_alone.compress(window))
                    for t in fitting:
                        share = self.saved(t, window, alone)
                        if share < LEAST_SAVED:
                            continue
                        run = runs.get(t)
                        if run and a <= run[3]:
                            run[0], run[3] = max(run[0], share), b
                        else:
                            if run:
                                result.append(tuple(run))
                            runs[t] = [share, t, a, b]
                result += [tuple(run) for run in runs.values()]
        return sorted(result, key=lambda r: (-r[0], *r[1:]))

    def reduction(self, t: int, text: str) -> float:
        """Bytes that knowing the template saves of the compressed text, as a share of the template's own compressed size."""
        data = " ".join(text.lower().split()).encode("utf-8", "surrogatepass")
        return (len(self.alone.compress(data)) - len(self.given[t].compress(data))) / self.own[t]

    def nearest(self, block: str) -> tuple[int, float, list[str], list[str]]:
        """Of a block without a confirmed template, the one it holds most of: number, share saved, differing words."""
        saved = [self.reduction(t, block) for t in range(len(self.names))]
        t = min(range(len(saved)), key=lambda t: (-saved[t], t))
        return t, saved[t], *differences(self.words[t], words(block))

    def places(self, found: list[str], t: int, low: int, high: int) -> list[tuple[int, int, int, list[str], list[str]]]:
        """Every place of template t within bounds among the words from low to high: template, first word, end, missing and
        added words. Whatever the bounds allow leaves one of the template's pieces whole, which tells where to align."""
        template, allowed, seeds = self.words[t], self.allowed[t], self.seeds[t]
        hits = set()
        for at in range(low, high - SEED + 1):
            for offset, piece in seeds.get(tuple(found[at : at + SEED]), ()):
                if found[at : at + len(piece)] == piece:
                    hits.add(at - offset)
        clusters: list[list[int]] = []
        for at in sorted(hits):
            if clusters and at - clusters[-1][0] <= allowed:
                clusters[-1][1] = at
            else:
                clusters.append([at, at])
        result = []
        for first, last in clusters:
            a, b = max(0, first - allowed), last + allowed
            window = found[a : b + len(template) + allowed]
            # At most `allowed` words are missing, in whatever order.
            if (self.counts[t] - Counter(window)).total() > allowed:
                continue
            place = align(template, window, max(1, b - a + 1), allowed)
            if place and not TELLING & {*place[2], *place[3]}:
                result.append((t, a + place[0], a + place[1], place[2], place[3]))
        return result

    def confirmed(self, found: list[str], spans: list[tuple[int, int]]) -> list[tuple[int, int, int, list[str], list[str]]]:
        """Places that do not overlap, in order of the text: the exact matches of the templates that compression ranks above
        noise. Of overlapping ones that with most equal words less differing ones stays, so a full text goes before a notice
        that is part of it; then the lower number."""
        order = lambda p: (2 * len(p[3]) + len(p[4]) - len(self.words[p[0]]), p[0], p[1])
        taken = bytearray(len(found))
        kept = []
        matches = [place for _, t, low, high in self.stretches(found, spans) for place in self.places(found, t, low, high)]
        for place in sorted(matches, key=order):
            if not any(taken[place[1] : place[2]]):
                taken[place[1] : place[2]] = b"\x01" * (place[2] - place[1])
                kept.append(place)
        return sorted(kept, key=lambda p: p[1])

    def rows(self, text: str | None) -> list[tuple]:
        """Per confirmed place, and per block that none touches: block, start, end, license, template, reduction, missing,
        added, confirmed. A place's block is the first it touches."""
        spans = blocks(text)
        if not spans:
            return []
        at = [match.span() for match in _word.finditer(text)]
        found = [text[a:b].lower() for a, b in at]
        firsts = [a for a, _ in at]
        places = self.confirmed(found, [(bisect_left(firsts, a), bisect_left(firsts, b)) for a, b in spans])
        rows, touched = [], set()
        for t, a, b, missing, added in places:
            start, end = at[a][0], at[b - 1][1]
            own = [k for k, (x, y) in enumerate(spans) if x < end and start < y]
            touched.update(own)
            rows.append((own[0] if own else None, start, end, self.names[t], t, self.reduction(t, text[start:end]), missing, added, True))
        for k, (x, y) in enumerate(spans):
            if k not in touched:
                rows.append((k, x, y, None, *self.nearest(text[x:y]), False))
        return sorted(rows, key=lambda r: r[1:3])


def license_blocks(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per place where a template's words stand within bounds, and one per block of license vocabulary that no such
    place touches: doc_id, the block's number, the span of the place or block in code points, the license (null unless
    confirmed), the template (of a block, the one it holds most of), what the template saves there as a share of its own
    compressed size, and the exact word differences.

    Only texts with a cue reach Python, whole. Null and empty texts have no blocks, equal rows give equal rows, null
    doc_ids are kept, other columns are ignored and an empty table gives no rows.
    """

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = LicenseScanner(templates)
        names = [f.split()[0] for f in FOUND.split(", ")]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                rows += [(doc_id, *row) for row in scanner.rows(text)]
            out = pd.DataFrame(rows, columns=names)
            whole = {c: pd.array([None if pd.isna(x) else int(x) for x in out[c]], dtype="Int64") for c in ("doc_id", "block")}
            yield out.assign(**whole)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.where(F.col("text").rlike(f"(?i){CUES}")).mapInPandas(of, FOUND)
