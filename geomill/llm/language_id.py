"""Operator 8: language identification by cross-parsing.

For every language a suffix automaton over a sample of its labelled text knows all substrings of the sample. A text
is parsed left to right into phrases, each the longest match that the automaton can follow; the language that
needs the fewest phrases, normalised by the length of its sample, wins. Letters are lower-cased; every letter of any
sample is a symbol of its own, in any script; a run of anything else is one space. Texts are parsed whole, and their phrases are
those of the parse from left to right, wherever the work is cut to run side by side.

Fitting takes a bounded sample, by hash order and alike at every size: of each language, whatever their number, the labelled
documents with a letter in turn, those of 200 to 20,000 characters first, then all others (short ones join, of a long one
counts the beginning of 20,000 characters), until 2 * CHARS characters; of these the first CHARS symbols are learned. score is 1 - phrases of the winner / phrases of the runner-up (1 where there is one
language only).

Defined cases: a text that is null or has no letter is `und` with score 0, as is every text when nothing could be
learned; equal counts go to the first language by name; repeated rows get equal answers; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geomill.llm.common import documents, remainder, staged

CHARS, SHORT, LONG = 30_000, 200, 20_000
SEGMENT, AT_ONCE, MAX_BROADCAST = 256, 1_000_000, 100_000
SPACE, OTHER, PAD = 0, 1, 2  # symbols; letters of the alphabet follow
UNKNOWN = "und"


def fold(char: str) -> str:
    return char.lower()[0]  # one letter where lower case has a mark after it


class Alphabet:
    """The letters of the samples; a letter that no sample has is OTHER, anything else SPACE."""

    def __init__(self, letters: str) -> None:
        place = {c: k + 3 for k, c in enumerate(letters)}
        self.size = len(letters) + 3
        self.of = np.full(0x110000, SPACE, np.int32)
        for code, char in enumerate(map(chr, range(0x110000))):
            if char.isalpha():
                self.of[code] = place.get(fold(char), OTHER)

    def symbols(self, text: str) -> np.ndarray:
        out = self.of[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
        keep = np.ones(len(out), bool)
        keep[1:] = (out[1:] != SPACE) | (out[:-1] != SPACE)
        return out[keep]


class Automaton(NamedTuple):
    """The transitions of all states laid into one array: that of a state by a symbol is at state + symbol, as state << 32 | next
    state; another state's number there, or -1, means none."""

    table: np.ndarray
    again: np.ndarray  # by symbol: the state after a phrase begins with it
    fresh: int  # the state without transitions: there any symbol begins a phrase


def suffix_automaton(symbols: list[int], alphabet: int) -> Automaton:
    """The automaton of all substrings."""
    goes, link, length, last = [{}], [-1], [0], 0
    for c in symbols:
        new = len(goes)
        goes.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in goes[p]:
            goes[p][c] = new
            p = link[p]
        if p >= 0:
            q = goes[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(goes)
                goes.append(dict(goes[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and goes[p].get(c) == q:
                    goes[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    for moves in goes:
        moves.pop(OTHER, None)
    return laid_out([*goes, {}], alphabet)


def laid_out(goes: list[dict[int, int]], alphabet: int) -> Automaton:
    """States (0 the start, the last one without transitions) numbered by the first place where all their transitions are free."""
    number, taken, used, low = [0] * len(goes), bytearray(2 * alphabet), bytearray(2 * alphabet), 0
    for state in sorted(range(len(goes)), key=lambda s: -len(goes[s])):
        first, *others = sorted(goes[state]) or [0]
        at, tries = max(low, first), 0
        while True:
            at = (taken if goes[state] else used).find(0, at)
            if at < 0 or at + alphabet >= len(taken):
                at = len(taken) - alphabet if at < 0 else at
                taken.extend(bytes(len(taken)))
                used.extend(bytes(len(used)))
                continue
            if not used[at - first] and not any(taken[at - first + c] for c in others):
                break
            at, tries = at + 1, tries + 1
            if tries % 16 == 0:  # the places at the low end are hardly ever free together
                low = taken.find(0, low) + 1
        number[state] = at - first
        used[at - first] = 1
        for c in goes[state]:
            taken[at - first + c] = 1
    table = np.full(max(number) + alphabet, -1, np.int64)
    for state, moves in zip(number, goes, strict=True):
        for c, to in moves.items():
            table[state + c] = state << 32 | number[to]
    again = np.full(alphabet, number[-1], np.int64)  # an unknown symbol is a phrase of its own
    for c, to in goes[0].items():
        again[c] = number[to]
    return Automaton(table, again, number[-1])


def phrase_starts(symbols: np.ndarray, automaton: Automaton) -> np.ndarray:
    """Where the left-to-right parse of `symbols` begins its phrases; PAD ends one and counts as a start too.

    Lanes of SEGMENT symbols are parsed side by side, each as if a phrase began with it. Then each lane goes on into the next
    one until it begins a phrase where that one did: from there on the two are the same parse. Where a lane never
    meets the next one, its parse is followed symbol by symbol until it meets a later one."""
    table, again, fresh = automaton
    lanes = -(-len(symbols) // SEGMENT)
    grid = np.full((lanes, SEGMENT), PAD, np.int64)
    grid.reshape(-1)[: len(symbols)] = symbols
    columns = np.ascontiguousarray(grid.T)
    own, state = np.zeros(columns.shape, bool), np.full(lanes, fresh, np.int64)
    for k, column in enumerate(columns):
        entry = table[state + column]
        own[k] = entry >> 32 != state
        state = np.where(own[k], again[column], entry & 0xFFFFFFFF)
    starts, walking, state = own.copy(), np.arange(1, lanes), state[:-1]
    for k, column in enumerate(columns):
        if not len(walking):
            break
        entry = table[state + column[walking]]
        missed = entry >> 32 != state
        starts[k, walking] = missed
        on = ~(missed & own[k, walking])
        state, walking = np.where(missed, again[column[walking]], entry & 0xFFFFFFFF)[on], walking[on]
    passed = 0
    for lane, at in zip(walking.tolist(), state.tolist(), strict=True):
        while lane > passed:  # lane - 1 went through `lane` without meeting it
            passed, lane = lane, lane + 1
            if lane == lanes:
                break
            starts[:, lane] = own[:, lane]
            for k, symbol in enumerate(grid[lane].tolist()):
                entry = int(table[at + symbol])
                starts[k, lane] = missed = entry >> 32 != at
                if missed and own[k, lane]:
                    passed = lane
                    break
                at = int(again[symbol]) if missed else entry & 0xFFFFFFFF
    return np.ascontiguousarray(starts.T).reshape(-1)[: len(symbols)]


def phrase_counts(texts: list[np.ndarray], automata: list[Automaton]) -> list[np.ndarray]:
    """For each automaton the phrases of each text, an array of symbols without PAD."""
    flat = np.concatenate([x for t in texts for x in (t, [PAD])]) if texts else np.zeros(0, np.int64)
    ends = np.cumsum([len(t) + 1 for t in texts]).astype(np.int64)
    counts = []
    for automaton in automata:
        upto = np.append(0, np.cumsum(phrase_starts(flat, automaton) & (flat != PAD)))
        counts.append(np.diff(upto[np.append(0, ends)]))
    return counts


# ---- fitting and prediction ----


PLACES = 40  # bits of a document's place in the order


def sample(docs: DataFrame) -> DataFrame:
    """lang, rank, place, text: of each language documents in the order of (rank, place) that hold 2 * CHARS characters, or all
    where there are fewer, and some twice as many at most on average. The rank is the length of the place in bits, after
    the in-band documents' for others, so each rank doubles those before it and counts per rank tell where to stop."""
    fit = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (remainder("doc_id", 4) != 2) & F.col("text").rlike(r"\p{L}")).select("doc_id", "lang", "text")
    sizes = fit.groupBy("lang", "doc_id").agg(F.min(F.length("text")).alias("size"))  # a repeated row counts once
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << PLACES))
    rank = F.length(F.bin(place)) + F.when(F.col("size").between(SHORT, LONG), 0).otherwise(PLACES + 1)
    sizes = staged(sizes.select("lang", "doc_id", place.alias("place"), rank.cast("int").alias("rank"), F.least("size", F.lit(LONG)).alias("size")), "language-sizes")
    last, held = {}, Counter()
    for r in sorted(sizes.groupBy("lang", "rank").agg(F.sum("size").alias("size")).collect(), key=lambda r: r["rank"]):  # at most 2 * (PLACES + 1) of a language
        if held[r["lang"]] < 2 * CHARS:
            last[r["lang"]] = r["rank"]
        held[r["lang"]] += r["size"]
    stops = F.broadcast(docs.sparkSession.createDataFrame(list(last.items()), "lang string, stop int"))
    chosen = staged(sizes.join(stops, "lang").filter("rank <= stop").select("lang", "doc_id", "rank", "place"), "language-sample")
    few = chosen.count() <= MAX_BROADCAST
    found = fit.join(F.broadcast(chosen) if few else chosen, ["lang", "doc_id"]).withColumn("text", F.substring("text", 1, LONG))
    return found.groupBy("lang", "doc_id", "rank", "place").agg(F.min("text").alias("text")).select("lang", "rank", "place", "text")


def fit_languages(docs: DataFrame) -> tuple[list[str], Alphabet, list[Automaton], list[float]]:
    """(languages, alphabet, automata, log2 of the sample lengths); the driver holds the bounded sample only."""
    drawn = sample(docs)
    names = sorted(r.lang for r in drawn.select("lang").distinct().collect())
    prefix = F.aggregate(F.array_sort(F.collect_list(F.struct("rank", "place", "text"))), F.lit(""), lambda a, x: F.when(F.length(a) < 2 * CHARS, F.concat(a, F.lit(" "), x["text"])).otherwise(a))
    texts = {r.lang: r.text[: 2 * CHARS] for r in drawn.groupBy("lang").agg(prefix.alias("text")).collect()}
    letters = Counter(fold(c) for t in texts.values() for c in t if c.isalpha())
    alphabet = Alphabet("".join(c for c, _ in sorted(letters.items(), key=lambda x: (-x[1], x[0]))))
    learned = [alphabet.symbols(texts[n])[:CHARS] for n in names]
    return names, alphabet, [suffix_automaton(s.tolist(), alphabet.size) for s in learned], [math.log2(len(s) + 2) for s in learned]


def predict(docs: DataFrame, names: list[str], alphabet: Alphabet, automata: list[Automaton], logs: list[float]) -> DataFrame:
    """doc_id, lang_pred, score, n_phrases (of the winner)."""
    shared = docs.sparkSession.sparkContext.broadcast((names, alphabet, automata, logs))  # some 1 MB of each language

    def parse(texts: list[str | None]) -> list[tuple]:
        names, alphabet, automata, logs = shared.value
        symbols = [alphabet.symbols(t or "") for t in texts]
        letters, phrases = [bool((s != SPACE).any()) for s in symbols], phrase_counts(symbols, automata)
        out = []
        for k, known in enumerate(letters):
            cost = sorted((p[k] * log, j) for j, (p, log) in enumerate(zip(phrases, logs, strict=True)))
            if not known or not cost:
                out.append((UNKNOWN, 0.0, 0))
            else:
                score = 1.0 - cost[0][0] / cost[1][0] if len(cost) > 1 else 1.0
                out.append((names[cost[0][1]], score, int(phrases[cost[0][1]][k])))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, out, group, size = batch["text"].to_pylist(), [], [], 0
            for t in texts:
                group.append(t)
                size += len(t or "")
                if size >= AT_ONCE:
                    out += parse(group)
                    group, size = [], 0
            out += parse(group) if group else []
            lang, score, n = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(n, pa.int64())], ["doc_id", "lang_pred", "score", "n_phrases"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, n_phrases long")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict(docs, *fit_languages(docs)).select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "n_phrases")
