"""Quality rules line by line: bad lines go first, then documents that lose too much.

Every line with a word is held against rules of punctuation, navigation and boilerplate; those that
fail one are removed. A document is kept if it passes the rules on its whole text and
if enough of its words are on lines that stay.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import texts

LEAST_WORDS = 10
REPEATED_PERCENT = 20  # of the words, in windows of WINDOW words that repeat
WINDOW = 5
LOST_PERCENT = 50  # of the words, on removed lines
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
RULES = ("punctuation", "navigation", "boilerplate")
# How lines of running text end, before closing marks, and marks that a word carries once only.
ENDS = tuple(".!?…:;。！？")
CLOSING = "\"'”’»)]"
NOISY = re.compile(r"[!?#*$%&]{2,}(?![^ \t\n\v\f\r])")
NOISY_PERCENT = 30  # of a line's words
# Signs between links, and words of menus at the start of a short line.
SEPARATOR = re.compile(r"(?<![^ \t\n\v\f\r])[|»›•·>/](?![^ \t\n\v\f\r])")
ENTRY_WORDS = 3  # words that links have at most, on average
MENU = re.compile(
    r"(?:home|menu|search|login|log in|sign in|sign up|register|next|previous|back to top|read more|"
    r"skip to content|share this|follow us|subscribe|contact us|click here)(?![a-z])"
)
MENU_WORDS = 6
# Phrases that sites repeat on every page.
BOILERPLATE = (
    "all rights reserved", "copyright ©", "licensed under", "released under the", "terms of use",
    "terms of service", "privacy policy", "cookie policy", "uses cookies", "accept cookies",
    "enable javascript", "lorem ipsum", "powered by",
)
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def failed_rule(line: str, n_words: int) -> int:
    """The first rule that a line (A to Z lower-cased) with words fails, as an index of RULES, or -1.

    A line ends like running text, and few of its words carry a run of marks; it is no row
    of short links nor a short line that begins like a menu; it holds no boilerplate.
    """
    bare = line.strip(BLANKS)
    if not bare.rstrip(CLOSING).endswith(ENDS) or 100 * len(NOISY.findall(bare)) >= NOISY_PERCENT * n_words:
        return 0
    links = len(SEPARATOR.findall(bare))
    if links >= 2 and n_words - links <= ENTRY_WORDS * (links + 1):
        return 1
    if n_words <= MENU_WORDS and MENU.match(bare):
        return 1
    return 2 if any(phrase in bare for phrase in BOILERPLATE) else -1


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """How many words lie in windows that are found twice or more, the first ones included.

    ``ids`` tell words apart. Windows are numbered by content, one word longer each time,
    so no hash decides.
    """
    n = len(ids) - window + 1
    if n < 2:
        return 0
    kinds = ids
    for more in range(1, window):
        kinds = np.unique(kinds[: len(ids) - more] * (ids.max() + 1) + ids[more:], return_inverse=True)[1]
        if more < window - 1 and kinds.max() + 1 == len(kinds):
            return 0
    twice = np.flatnonzero(np.bincount(kinds)[kinds] > 1)
    change = np.zeros(len(ids) + 1, np.int64)
    change[twice] += 1
    change[twice + window] -= 1
    return int((np.cumsum(change) > 0).sum())


def judged(text: str | None) -> tuple:
    """The numbers of one text, the removed lines and words, and the lines that stay."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    text = raw.decode("utf-8", "replace")
    known: dict[bytes, int] = {}
    ids, lines, seen = [], [], set()
    doubled = gone = 0
    removed = [0] * len(RULES)
    for line, own, lower in zip(text.split("\n"), raw.split(b"\n"), raw.translate(LOWER).decode("utf-8", "replace").split("\n")):
        words = own.split()  # at blanks and control spaces, and no others
        rule = failed_rule(lower, len(words)) if words else -1
        if rule < 0:
            lines.append(line)
        else:
            removed[rule] += 1
            gone += len(words)
        if words:
            ids += [known.setdefault(w, len(known)) for w in words]
            doubled += own in seen
            seen.add(own)
    repeated = repeated_words(np.array(ids, np.int64))
    base = len(ids) < LEAST_WORDS or 100 * repeated > REPEATED_PERCENT * len(ids)
    return (
        len(ids),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        doubled,
        repeated,
        base,
        not base and 100 * gone <= LOST_PERCENT * len(ids),
        *removed,
        gone,
        "\n".join(lines),
    )


COLUMNS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_punctuation long, n_navigation long, n_boilerplate long, "
    "n_words_lost long, cleaned string"
)


def clean_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row its numbers, whether it is kept, and ``cleaned``, the text without the removed lines.

    NULL and empty texts have no words and are not kept; lines without words stay as they
    are and count for nothing. NULL ids and rows that repeat are judged like others. A
    text is judged in one task, with memory in proportion to its length; nothing is shuffled.
    """
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judged(text.as_py()) for text in batch.column("text")]
            columns = [list(c) for c in zip(*found)] or [[] for _ in names[1:]]
            yield pa.RecordBatch.from_pydict({names[0]: batch.column("doc_id"), **dict(zip(names[1:], columns))})

    rows = texts(docs, id_column, text_column).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(judge, COLUMNS)


def digest(docs: DataFrame, **options) -> DataFrame:
    """``clean_lines`` without the texts."""
    return clean_lines(docs, **options).drop("cleaned")
