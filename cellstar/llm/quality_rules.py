"""Line-first cleaning.

Every line of a document is judged by itself: an end without sentence
punctuation, symbols strewn between the words, navigation (many separators),
boilerplate phrases and repeats of an earlier line fail it. Failed lines go;
a document that loses too much of its text by that is rejected. The base rule
(too few words, or too many words inside repeated three-word windows) rejects
a document before the lines are looked at.

Whole texts are read, one document at a time, in Arrow batches of one scan;
there is no shuffle. A null or empty text has no words and fails the base rule.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from cellstar.llm.common import WORD, documents, lean

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A line with more symbols than this share of its words fails.
MAX_SYMBOL_PERCENT = 25
#: A document keeps at least this share of its word characters.
MIN_KEPT_PERCENT = 50

_WORD = re.compile(WORD)
_SYMBOL = re.compile(r"[#*$%&|<>]")
_SEPARATOR = re.compile(r"[|»›•·]|::|>>")
_END = re.compile("[.!?:;…。！？][\"'”’»)\\]]*[ \\t\\r]*$")
_BOILERPLATE = re.compile(
    r"cookie|privacy policy|terms of (?:use|service)|all rights reserved|lorem ipsum|enable javascript"
    r"|subscribe to our|sign up for|click here|read more\b|share this|add to cart", re.IGNORECASE)

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, n_lines long, n_failed_lines long, clean_text string")


def repeat_words(words: list[str]) -> int:
    """Words inside a three-word window that occurs at least twice."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    total, covered = 0, 0  # covered: end of the words counted so far
    for i, w in enumerate(windows):
        if seen[w] > 1:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


def line_passes(line: str, words: int) -> bool:
    """One line's verdict; a line without words always passes."""
    if not words:
        return True
    if 100 * len(_SYMBOL.findall(line)) > MAX_SYMBOL_PERCENT * words:
        return False
    if len(_SEPARATOR.findall(line)) >= 3:
        return False
    if not _END.search(line) and words < 8:
        return False
    return not _BOILERPLATE.search(line)


def judge(text: str) -> tuple:
    """All figures of one document, and the text of the lines that passed."""
    lines = text.split("\n")  # a line end is white space, so the lines' words are the text's
    by_line = [_WORD.findall(line) for line in lines]
    words = [w for own in by_line for w in own]
    n, chars = len(words), sum(map(len, words))
    repeats = repeat_words(words)
    failed_base = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
    seen: set[str] = set()
    dup = bad = kept_chars = 0
    kept = []
    for line, own in zip(lines, by_line):
        again = bool(own) and line in seen
        if own:
            seen.add(line)
        dup += again
        if again or not line_passes(line, len(own)):
            bad += 1
        else:
            kept.append(line)
            kept_chars += sum(map(len, own))
    verdict = not failed_base and 100 * kept_chars >= MIN_KEPT_PERCENT * chars
    return (n, chars, len(_SYMBOL.findall(text)), dup, repeats, failed_base, verdict,
            len(lines) if n else 0, bad, "\n".join(kept))


def clean_lines(docs: DataFrame) -> DataFrame:
    """Figures, verdict and cleaned text of every document (see SCHEMA)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 2 + [pa.string()]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            rows = list(zip(*(judge(t) for t in batch.column("text").to_pylist()))) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(list(r), k) for r, k in zip(rows, kinds))], names)

    return documents(docs).mapInArrow(lean(run), SCHEMA)
