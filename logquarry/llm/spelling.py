"""Spelling variants: words one edit apart, found by composing finite-state machines.

The vocabulary's acceptor, a transducer that makes exactly one edit, and the acceptor again are composed. A state of the
composition is (p, edits, q): before the edit both sides have read the same symbols, so p = q; after it both must read the
same rest. The composition is cut by its initial states, one per prefix that both words share: prefixes with few words are
one task each, which minimises the acceptor of its words and lists all accepted pairs. The initial state of a prefix with
too many words is expanded instead: reading one more symbol on both sides gives smaller prefixes, and making the edit right
there leaves states whose rests must be equal, which is a grouping of rests by key.
"""

from __future__ import annotations

import string
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import small_side, stored

RUNS = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 5
LEAST_COUNT = 3
DAMAGED = 97
RATIO = 2
# Symbols of the words that one task composes; prefixes with more are expanded.
SYMBOLS = 200_000
# Composed states advanced at once.
FRONTIER = 500_000


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damaged: int | None = DAMAGED) -> DataFrame:
    """Rows (word, n): runs of Latin letters with A-Z lower-cased, counted over whole texts.

    Where the unsigned crc32 h of '<doc_id>:<run>' is divisible by `damaged`, the run's code point at h % length is
    deleted first; None damages nothing. A null text has no runs, a null id is written as no text at all; repeated rows
    count as often as they occur; an empty table gives no rows.
    """
    text = F.col("text").cast("string")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(RUNS), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= least_length)
    word = F.translate("run", string.ascii_uppercase, string.ascii_lowercase)
    runs = runs.select("id", word.alias("word"))
    if damaged is not None:
        hashed = F.crc32(F.concat_ws(":", "id", "word"))
        place = (hashed % F.char_length("word")).cast("int")
        shorter = F.concat(F.substring(F.col("word"), F.lit(1), place), F.substring(F.col("word"), place + 2, F.char_length("word")))
        runs = runs.select(F.when(hashed % damaged == 0, shorter).otherwise(F.col("word")).alias("word"))
        runs = runs.where(F.char_length("word") >= least_length)
    return runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


class Acceptor:
    """The minimal acyclic automaton of sorted, different words; a word's number is the sum of its arcs' offsets.

    States are numbered from the ends of words on; equal states are found in a register as words are added in order.
    """

    def __init__(self, words: list[str]):
        register: dict[tuple, int] = {}
        first, symbols, targets, offsets, finals, sizes = [0], [], [], [], [], []

        def close(final: bool, arcs: list[int]) -> int:
            key = (final, *arcs)
            state = register.get(key)
            if state is None:
                state = register[key] = len(finals)
                below = int(final)
                for symbol, target in zip(arcs[::2], arcs[1::2]):
                    symbols.append(symbol)
                    targets.append(target)
                    offsets.append(below)
                    below += sizes[target]
                first.append(len(symbols))
                finals.append(final)
                sizes.append(below)
            return state

        # The path of the latest word: per state whether a word ends there, and its arcs as symbol, target, ...
        path: list[tuple[list[bool], list[int]]] = [([False], [])]
        last = ""
        for word in words:
            same = len(commonprefix((last, word)))
            self._shorten(path, last, same, close)
            path.extend(([False], []) for _ in range(len(word) - same))
            path[-1][0][0] = True
            last = word
        self._shorten(path, last, 0, close)
        self.root = close(path[0][0][0], path[0][1])
        self.first, self.finals = np.array(first), np.array(finals, dtype=bool)
        self.alphabet, self.symbols = np.unique(np.array(symbols, dtype=np.int64), return_inverse=True)
        self.targets, self.offsets = np.array(targets, dtype=np.int64), np.array(offsets, dtype=np.int64)
        # Arc of a state by symbol, -1 for none.
        self.arc = np.full((len(finals), max(1, len(self.alphabet))), -1, dtype=np.int32)
        self.arc[np.repeat(np.arange(len(finals)), np.diff(self.first)), self.symbols] = np.arange(len(symbols))

    @staticmethod
    def _shorten(path: list, word: str, length: int, close) -> None:
        for at in range(len(path) - 1, length, -1):
            final, arcs = path.pop()
            path[-1][1].extend((ord(word[at - 1]), close(final[0], arcs)))

    def leaving(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All arcs of the given states, with the place of the state each leaves."""
        degrees = self.first[states + 1] - self.first[states]
        rows = np.repeat(np.arange(len(states)), degrees)
        within = np.arange(len(rows)) - np.repeat(np.cumsum(degrees) - degrees, degrees)
        return rows, self.first[states][rows] + within

    def prefixes(self) -> tuple[np.ndarray, np.ndarray]:
        """State and number offset after each prefix of the words, ordered by state."""
        states, offsets = np.array([self.root]), np.array([0])
        found = [(states, offsets)]
        while len(states):
            rows, arcs = self.leaving(states)
            states, offsets = self.targets[arcs], offsets[rows] + self.offsets[arcs]
            found.append((states, offsets))
        states, offsets = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(states, kind="stable")
        return states[order], offsets[order]


def _edits(machine: Acceptor) -> list[tuple[np.ndarray, ...]]:
    """Composed states right after the edit: origin, both sides' states and offsets, and the symbol that may not follow.

    A deletion out of a run of equal symbols counts at the run's last one, so each pair is accepted on one path only.
    """
    states = np.arange(len(machine.finals))
    origin, arcs = machine.leaving(states)
    found = [(origin, machine.targets[arcs], origin, machine.offsets[arcs], np.zeros(len(arcs), dtype=np.int64), machine.symbols[arcs])]
    degrees = np.diff(machine.first)
    for degree in np.unique(degrees[degrees > 1]).tolist():
        of = states[degrees == degree]
        low, high = np.triu_indices(degree, 1)
        a, b = ((machine.first[of][:, None] + x[None, :]).ravel() for x in (low, high))
        none = np.full(len(a), -1, dtype=np.int64)
        found.append((np.repeat(of, len(low)), machine.targets[a], machine.targets[b], machine.offsets[a], machine.offsets[b], none))
    return found


def accepted_pairs(machine: Acceptor) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words that are one edit apart, each pair once."""
    waiting = [tuple(x[at : at + FRONTIER] for x in edits) for edits in _edits(machine) for at in range(0, len(edits[0]), FRONTIER)]
    found = []
    while waiting:
        origin, left, right, left_at, right_at, barred = waiting.pop()
        ends = machine.finals[left] & machine.finals[right]
        found.append((origin[ends], left_at[ends], right_at[ends]))
        rows, arcs = machine.leaving(left)
        symbol = machine.symbols[arcs]
        other = machine.arc[right[rows], symbol]
        both = (other >= 0) & (symbol != barred[rows])
        rows, arcs, other = rows[both], arcs[both], other[both]
        if len(rows):
            step = (origin[rows], machine.targets[arcs], machine.targets[other], left_at[rows] + machine.offsets[arcs], right_at[rows] + machine.offsets[other], np.full(len(rows), -1))
            waiting.extend(tuple(x[at : at + FRONTIER] for x in step) for at in range(0, len(rows), FRONTIER))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    origin, left, right = (np.concatenate(x) for x in zip(*found))
    # What follows an edit depends on the state alone: it holds after every prefix that leads there.
    states, offsets = machine.prefixes()
    low, high = np.searchsorted(states, origin), np.searchsorted(states, origin, "right")
    rows = np.repeat(np.arange(len(origin)), high - low)
    base = offsets[low[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)]
    return base + left[rows], base + right[rows]


def _compose(words: pa.Table) -> pa.Table:
    """Per word of one prefix with near words there: how many, and the best's negated n and word."""
    words = words.sort_by("word")
    texts, counts = words["word"].to_pylist(), words["n"].to_numpy()
    left, right = accepted_pairs(Acceptor(texts))
    left, right = np.concatenate([left, right]), np.concatenate([right, left])
    place = np.empty(len(texts), dtype=np.int64)
    # By falling n, then in code point order.
    order = np.lexsort((np.arange(len(texts)), -counts))
    place[order] = np.arange(len(texts))
    best = np.full(len(texts), len(texts))
    np.minimum.at(best, left, place[right])
    near = np.bincount(left, minlength=len(texts))
    at = np.flatnonzero(near)
    chosen = order[best[at]]
    of = words["word"].combine_chunks()
    return pa.table({"word": of.take(pa.array(at)), "n_near": near[at], "less": -counts[chosen], "best": of.take(pa.array(chosen))})


def _shared_prefixes(batches):
    for classes in batches:
        shared = [commonprefix(pair) for pair in zip(classes["low"].to_pylist(), classes["high"].to_pylist())]
        yield pa.RecordBatch.from_pydict({"prefix": classes["prefix"], "shared": pa.array(shared, pa.string())})


def _expanded(words: DataFrame) -> DataFrame:
    """Near words whose edit is made right after `shared`, the prefix that a whole class of words has.

    Both words then have the same rest: the longer or changed word without its symbol there, the other one whole. A rest
    is met by one word per symbol and one whole word, so these groups are bounded by the alphabet.
    """
    after = F.length("shared")
    rest = F.substring(F.col("word"), after + 1, F.length("word"))
    symbol, dropped = F.substring(rest, 1, 1), F.substring(rest, F.lit(2), F.length("word"))
    whole = words.select("shared", rest.alias("rest"), F.lit(None).cast("string").alias("symbol"), "n")
    changed = words.where(F.length("word") > after).select("shared", dropped.alias("rest"), symbol.alias("symbol"), "n")
    met = whole.union(changed).groupBy("shared", "rest").agg(F.collect_list(F.struct("symbol", "n")).alias("members")).where(F.size("members") > 1)
    each = met.withColumn("me", F.explode("members"))

    def near(other):
        mine, its = F.col("me.symbol"), other["symbol"]
        replaced = mine.isNotNull() & its.isNotNull() & (mine != its)
        # A symbol out of a run counts as deleted at the run's end.
        deleted = (mine.isNull() != its.isNull()) & (F.coalesce(mine, its) != F.substring("rest", 1, 1))
        return replaced | deleted

    def spelled(symbol):
        return F.concat("shared", F.coalesce(symbol, F.lit("")), "rest")

    others = F.filter("members", near)
    each = each.select(spelled(F.col("me.symbol")).alias("word"), F.transform(others, lambda x: F.struct((-x["n"]).alias("less"), spelled(x["symbol"]).alias("word"))).alias("others"))
    return each.where(F.size("others") > 0).select("word", F.size("others").cast("long").alias("n_near"), F.array_min("others").alias("best"))


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """Rows (word, n_near, best) of the words (word, n) that have near words; `words` are different, stored and not null."""
    found, waiting = [], words.withColumn("prefix", F.substring("word", 1, 0))
    while True:
        classes = waiting.groupBy("prefix").agg(F.count(F.lit(1)).alias("words"), F.sum(F.length("word") + 1).alias("size"), F.min("word").alias("low"), F.max("word").alias("high"))
        large = classes.where((F.col("words") > 1) & (F.col("size") > symbols))
        # At most one row per `symbols` symbols of the vocabulary.
        large = stored(large.mapInArrow(_shared_prefixes, "prefix string, shared string"), "spelling-large")
        if large.isEmpty():
            break
        split = waiting.join(small_side(large), "prefix", "left")
        found.append(_alone(split.where("shared IS NULL")))
        split = stored(split.where("shared IS NOT NULL"), "spelling-split")
        found.append(_expanded(split))
        waiting = split.where(F.length("word") > F.length("shared"))
        waiting = waiting.select("word", "n", F.substring(F.col("word"), F.lit(1), F.length("shared") + 1).alias("prefix"))
    found.append(_alone(waiting))
    total = found[0]
    for more in found[1:]:
        total = total.union(more)
    return total.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _alone(words: DataFrame) -> DataFrame:
    found = words.select("prefix", "word", "n").groupBy("prefix").applyInArrow(_compose, "word string, n_near long, less long, best string")
    return found.select("word", "n_near", F.struct("less", F.col("best").alias("word")).alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """Rows (word, root) for the words that others have as their form and that have a form themselves.

    Counts at least double along forms, so paths are short; every round doubles the steps taken.
    """
    current = stored(links.join(links.select(F.col("form").alias("word")).distinct(), "word", "left_semi").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = stored(current.join(small_side(ahead), "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        current = step.select("word", "root")
        if step.where("moved").isEmpty():
            return current


def variants(words: DataFrame, ratio: float = RATIO, symbols: int = SYMBOLS) -> DataFrame:
    """Per word of a vocabulary (word, n): its near words' number, its form and that form's n, and its root.

    Near words differ by exactly one inserted, deleted or replaced code point. The form is the near word of largest n
    (ties: first in code point order) if that n is at least `ratio` (over 1) times the word's own. Rows of one word are
    added up; null words and rows without n are left out; other columns are ignored; an empty table gives no rows.
    """
    plain = words.select(F.col("word").cast("string").alias("word"), F.col("n").cast("long").alias("n")).where("word IS NOT NULL AND n IS NOT NULL")
    plain = stored(plain.groupBy("word").agg(F.sum("n").alias("n")), "spelling-words")
    found = plain.join(near_words(plain, symbols), "word", "left")
    best = -F.col("best.less")
    linked = best >= ratio * F.col("n")
    found = stored(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(linked, F.col("best.word")).alias("form"), F.when(linked, best).alias("form_n")), "spelling-forms")
    roots = _roots(found.where("form IS NOT NULL").select("word", "form")).withColumnRenamed("word", "form")
    return found.join(small_side(roots), "form", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "form", "word").alias("root"))
