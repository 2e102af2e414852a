"""Operator 6: line-first quality rules.

Every `\\n`-split line with a word is judged by three rules; a line that breaks one is removed:

- punctuation: at least 4 words and no sentence end (terminal punctuation of any script, as `. ! ? : ; ,` or a danda, or a closing quote or bracket)
  as the last character; a line of LONG_LINE words or more passes if a sentence of any script ends inside it (a paragraph that was cut off), and so
  does a line that ends in Thai or Lao, which are written without such marks;
- navigation: at least 3 menu separators (`|`, `»`, `›`) and at least one for every 4 words;
- boilerplate: at most 40 words and a stock phrase (by default of licences, cookies, logins, sharing; `phrases` is a parameter).

A document is rejected when the removed lines hold more than `max_lost` of its word characters, or by the base
rules (under 50 words, or over half of its words inside 3-word windows that occur twice), which see the text as it came. One that is
kept goes on as its cleaned text: the lines that passed and those without a word, in their order.

Defined cases: a null or empty text has no words, keeps nothing, and fails the base rule; repeated rows are judged
alike, each by itself; other columns are ignored, whatever their names. Texts are judged whole, one row at a time, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from geomill.llm.common import documents

# The base rules' white space and symbols.
SPACE, SYMBOLS = "\x20\x09\x0a\x0b\x0c\x0d", "#*$%&|<>"
_all = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x20000))))  # all planes with punctuation
SENTENCE_END = "\"'”’»…" + "".join(regex.findall(r"[\p{Terminal_Punctuation}\p{Pe}]", _all))
STOPS = "".join(regex.findall(r"\p{Sentence_Terminal}", _all))
UNMARKED = ("\u0e00", "\u0eff")  # the blocks of Thai and Lao
STOCK_PHRASES = (
    "licensed under", "is licensed", "all rights reserved", "terms of service", "terms of use", "privacy policy",
    "cookie policy", "accept cookies", "use of cookies", "click here", "read more", "sign up", "log in", "subscribe to",
    "share this", "follow us", "back to top", "skip to content", "javascript", "lorem ipsum",
)
MAX_LOST, LONG_LINE = 0.5, 30

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_removed_lines long, removed_chars long, base_failed boolean, kept boolean"

_ends = frozenset(SENTENCE_END)
_sentence = regex.compile(rf"[{regex.escape(STOPS)}][\x20\x09-\x0D]")


def phrase_test(phrases: tuple[str, ...] = STOCK_PHRASES) -> regex.Pattern:
    """Finds any of the phrases, given in lower case."""
    return regex.compile("|".join(map(regex.escape, phrases)) or "(?!)")


_stock = phrase_test()


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    _, pair = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)
    _, window, count = np.unique(pair[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    twice = count[window] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : len(words) - 2 + shift] |= twice
    return int(covered.sum())


def line_fails(line: str, n_words: int, stock: regex.Pattern = _stock) -> bool:
    bare = line.strip(SPACE)
    if n_words >= 4 and bare[-1] not in _ends and not UNMARKED[0] <= bare[-1] <= UNMARKED[1] and (n_words < LONG_LINE or not _sentence.search(bare)):
        return True
    bars = bare.count("|") + bare.count("»") + bare.count("›")
    if bars >= 3 and 4 * bars >= n_words:
        return True
    return n_words <= 40 and stock.search(bare.lower()) is not None


def word_chars(text: str) -> int:
    return len(text) - sum(map(text.count, SPACE))


def clean_text(text: str | None, stock: regex.Pattern = _stock, max_lost: float = MAX_LOST) -> tuple[str, tuple]:
    """The text without failing lines, and the figures of one document."""
    text = text or ""
    n_words = n_lines = n_removed = removed = dup = 0
    seen, words, kept_lines = set(), [], []
    for line in text.split("\n"):
        own = line.encode("utf-8", "surrogatepass").split()
        if not own:
            kept_lines.append(line)
            continue
        words += own
        n_lines += 1
        dup += line in seen
        seen.add(line)
        if line_fails(line, len(own), stock):
            n_removed += 1
            removed += word_chars(line)
        else:
            kept_lines.append(line)
    n_words, total, repeat = len(words), word_chars(text), repeated_words(words)
    base_failed = n_words < 50 or 100 * repeat > 50 * n_words
    kept = not base_failed and removed <= max_lost * total
    return "\n".join(kept_lines), (n_words, total, sum(map(text.count, SYMBOLS)), dup, repeat, n_lines, n_removed, removed, base_failed, kept)


def line_figures(docs: DataFrame, phrases: tuple[str, ...] = STOCK_PHRASES, max_lost: float = MAX_LOST) -> DataFrame:
    """One row per document: the base figures, what the line rules removed, and the verdict."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.bool_() if c.endswith("boolean") else pa.int64() for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stock = phrase_test(phrases)
        for batch in batches:
            rows = [(i.as_py(), *clean_text(t.as_py(), stock, max_lost)[1]) for i, t in zip(batch["doc_id"], batch["text"], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds], names)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def keep_clean(docs: DataFrame, phrases: tuple[str, ...] = STOCK_PHRASES, max_lost: float = MAX_LOST) -> DataFrame:
    """The documents that the rules accept, with their cleaned texts and all other columns unchanged; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stock = phrase_test(phrases)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts, kept = [], []
            for t in batch.column(at):
                text, figures = clean_text(t.as_py(), stock, max_lost)
                texts.append(text)
                kept.append(figures[-1])
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type)).filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_figures(documents(spark, sf_dir))


_W = r"[^\x20\x09-\x0D]+"
ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '{_W}') AS words FROM d),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM d),
lw AS (SELECT *, len(regexp_extract_all(line, '{_W}')) AS n, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
  regexp_replace(line, '[\x20\x09-\x0D]+$', '') AS bare, row_number() OVER (PARTITION BY doc_id, line ORDER BY k) AS nth FROM l),
v AS (SELECT *, (n >= 4 AND NOT contains('{SENTENCE_END.replace("'", "''")}', right(bare, 1)) AND NOT regexp_matches(bare, '[{UNMARKED[0]}-{UNMARKED[1]}]$')
      AND (n < {LONG_LINE} OR NOT regexp_matches(bare, '[{STOPS}][\x20\x09-\x0D]')))
    OR (len(regexp_extract_all(line, '[|»›]')) >= 3 AND 4 * len(regexp_extract_all(line, '[|»›]')) >= n)
    OR (n <= 40 AND regexp_matches(lower(line), '{"|".join(STOCK_PHRASES)}')) AS fails FROM lw WHERE n > 0),
ls AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (nth > 1) AS n_dup_lines, count(*) FILTER (fails) AS n_removed_lines,
  coalesce(sum(chars) FILTER (fails), 0) AS removed_chars FROM v GROUP BY doc_id),
g AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS three FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
r AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, three) AS c FROM g) WHERE c > 1) GROUP BY doc_id),
a AS (SELECT doc_id, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_removed_lines, 0) AS n_removed_lines, coalesce(removed_chars, 0)::BIGINT AS removed_chars
  FROM w LEFT JOIN ls USING (doc_id) LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a)
SELECT *, NOT base_failed AND removed_chars <= {MAX_LOST} * word_chars AS kept FROM b
"""
