"""Quality rules, line first: every line is judged, failing lines go, and a document that loses too much of its text is rejected.

A document is first measured as a whole (the base): words are runs without space or \\x09-\\x0D, lines are what stands
between ``\\n``. It fails at once if it has too few words or repeats itself (words in 3-word windows that the text
holds twice or more). Then each line with a word is judged by three families of rules:

* punctuation: a short line that does not end a sentence; a line crowded with exclamation marks, question marks or symbols;
* navigation: words parted by separators; menu words alone; links alone;
* boilerplate: a short line with a stock phrase (licences, rights, cookies, calls to click); a line that the document has
  already shown.

The lines that fail are removed, and the document is kept if they hold at most ``MOST_LOST`` percent of its word characters.
Every document is judged by itself, in one pass over whole texts without a shuffle.

Cases: a null or empty text has no words, fails the base and (``clean``) stays as it is; very long texts are read whole; a
line without words is neither judged nor removed; repeated rows are judged each; rows tie in nothing; an empty table
gives an empty result. Only the columns named in the call are read, ``clean`` passes the others on (columns named like its own new ones are replaced).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.llm.common import chunks, texts_of

LEAST_WORDS, MOST_REPEATED = 50, 50
#: Percent of a document's word characters that failing lines may hold.
MOST_LOST = 50
#: A line of so many words may end in the middle of a sentence; marks are judged from ``CROWD_WORDS`` on.
LONG_LINE, CROWD_WORDS = 20, 10

# Characters, words and phrases that the rules look for.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SENTENCE_END = r"""[.!?\u2026\u3002\uff01\uff1f]["')\]\u00bb\u2019\u201d]*[ \x09-\x0d]*$"""
SEPARATORS = ("|", "/", ">", "-", "\u00b7", "\u00bb", "\u2022", "\u203a")
MENU_WORDS = ("about", "account", "archive", "back", "blog", "cart", "categories", "contact", "faq", "help", "home", "in", "login", "logout", "menu",
              "next", "previous", "print", "register", "search", "share", "sign", "sitemap", "skip", "tags", "top", "up", "us")
PHRASES = ("all rights reserved", "click here", "cookie policy", "copyright", "enable javascript", "licensed under", "lorem ipsum", "powered by",
           "privacy policy", "read more", "released under", "subscribe to", "terms of service", "terms of use", "use cookies")
LINK_STARTS = ("http://", "https://", "www.")

_END = re.compile(SENTENCE_END.replace("$", r"\Z"))
_PHRASE = re.compile("|".join(map(re.escape, PHRASES)))
_SEPARATORS, _MENU = {s.encode() for s in SEPARATORS}, {w.encode() for w in MENU_WORDS}
_LINKS = tuple(s.encode() for s in LINK_STARTS)


class Judged(NamedTuple):
    """What ``judge`` finds; ``removed``: numbers of the lines that fail."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    base_failed: bool
    lost_chars: int
    kept: bool
    removed: list[int]


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that stand twice or more in ``words``; each word counts once."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=n)
    if len(known) == n:
        return 0
    pairs = ids[:-1] * len(known) + ids[1:]
    ranks, pair = np.unique(pairs, return_inverse=True)  # below n, so that a window's code can't overflow
    if len(ranks) == n - 1:
        return 0
    windows = pair[:-1] * len(known) + ids[2:]
    _, which, count = np.unique(windows, return_inverse=True, return_counts=True)
    again = count[which] > 1
    inside = np.zeros(n, dtype=bool)
    for k in range(3):
        inside[k:n - 2 + k] |= again
    return int(inside.sum())


def _characters(text: str) -> int:
    """Characters that are part of a word."""
    return len(text) - sum(map(text.count, SPACES))


def line_fails(line: str, words: list[bytes], symbols: int) -> bool:
    """Whether the line, with its words and its number of symbols, breaks a rule of punctuation, navigation or stock phrases."""
    n = len(words)
    if n < LONG_LINE and not _END.search(line):
        return True
    if symbols * 4 > n or n >= CROWD_WORDS and 2 * (line.count("!") + line.count("?")) > n:
        return True
    separators = sum(w in _SEPARATORS for w in words)
    if separators >= 2 and 4 * separators >= n:
        return True
    if n > LONG_LINE:
        return False
    return bool(_PHRASE.search(line.encode().lower().decode()) or all(w.startswith(_LINKS) for w in words) or all(w.lower().strip(b".") in _MENU for w in words))


def judge(text: str, most_lost: int = MOST_LOST) -> Judged:
    """The base figures and the verdict of one whole text."""
    words = text.encode().split()
    n, chars, symbols = len(words), _characters(text), sum(map(text.count, SYMBOLS))
    repeated = repeated_words(words)
    seen: set[str] = set()
    removed, again, lost = [], 0, 0
    for k, line in enumerate(text.split("\n")):
        own = line.encode().split()
        if not own:
            continue
        shown = line in seen
        again += shown
        if shown or line_fails(line, own, sum(map(line.count, SYMBOLS)) if symbols else 0):
            removed.append(k)
            lost += _characters(line)
        seen.add(line)
    failed = n < LEAST_WORDS or 100 * repeated > MOST_REPEATED * n
    return Judged(n, chars, symbols, again, repeated, failed, lost, not failed and 100 * lost <= most_lost * chars, removed)


_FIGURES = T.StructType([*(T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                         T.StructField("base_failed", T.BooleanType()), T.StructField("lost_chars", T.LongType()), T.StructField("kept", T.BooleanType())])


def rules(documents: DataFrame, keep: list[str], text: str = "text", most_lost: int = MOST_LOST) -> DataFrame:
    """The columns ``keep``, the base figures, ``lost_chars`` and the verdict ``kept`` of every row."""
    keep = [c for c in dict.fromkeys(keep) if c not in _FIGURES.names]
    # the text goes last under a name of its own, so that it may be kept as well
    source = documents.select(*keep, F.col(text).alias("__text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "__text"):
                found = list(zip(*(judge(t, most_lost)[:8] for t in texts_of(part, "__text")), strict=True))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *(pa.array(c) for c in found)], [*keep, *_FIGURES.names])

    return source.mapInArrow(task, T.StructType([*source.schema.fields[:-1], *_FIGURES.fields]))


def clean(documents: DataFrame, text: str = "text", length: str | None = "n_chars", most_lost: int = MOST_LOST) -> DataFrame:
    """The kept rows, with all their columns, without their failing lines; ``length`` (if there) is the new text's code points."""
    names = documents.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                at, new = [], []
                for k, t in enumerate(texts_of(part, text)):
                    found = judge(t, most_lost)
                    if found.kept:
                        out = set(found.removed)
                        at.append(k)
                        new.append("\n".join(x for j, x in enumerate(t.split("\n")) if j not in out) if out else t)
                if at:
                    cols = dict(zip(names, part.take(pa.array(at)).columns, strict=True))
                    old, cols[text] = cols[text].to_pylist(), pa.array(new, cols[text].type)
                    if length in cols:
                        cols[length] = pa.array([len(t) if t != o else n for t, o, n in zip(new, old, cols[length].to_pylist(), strict=True)], cols[length].type)
                    yield pa.RecordBatch.from_arrays(list(cols.values()), names)

    return documents.mapInArrow(task, documents.schema)


def _sql() -> str:
    """The same figures and verdict in DuckDB."""
    word, quoted = r"[^\x20\x09-\x0d]+", lambda xs: ", ".join(f"'{x}'" for x in xs)
    characters = "len(regexp_replace({}, '[\\x20\\x09-\\x0d]+', '', 'g'))"
    fails = f"""n < {LONG_LINE} AND NOT regexp_matches(line, '{_END.pattern.replace("'", "''").replace(chr(92) + "Z", "$")}')
     OR 4 * len(regexp_replace(line, '[^{SYMBOLS}]', '', 'g')) > n
     OR n >= {CROWD_WORDS} AND 2 * len(regexp_replace(line, '[^!?]', '', 'g')) > n
     OR len(list_filter(words, lambda w: w IN ({quoted(SEPARATORS)}))) >= 2 AND 4 * len(list_filter(words, lambda w: w IN ({quoted(SEPARATORS)}))) >= n
     OR n <= {LONG_LINE} AND (regexp_matches(low, '{"|".join(PHRASES)}')
        OR len(list_filter(words, lambda w: starts_with(w, '{LINK_STARTS[0]}') OR starts_with(w, '{LINK_STARTS[1]}') OR starts_with(w, '{LINK_STARTS[2]}'))) = n
        OR len(list_filter(words, lambda w: trim({_ascii_lower('w')}, '.') IN ({quoted(MENU_WORDS)}))) = n)"""
    fails = re.sub(r"\\u([0-9a-f]{4})", r"\\x{\1}", fails)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{word}') AS words FROM documents),
f AS (SELECT doc_id, len(words) AS n_words, {characters.format("text")} AS word_chars, len(regexp_replace(text, '[^{SYMBOLS}]', '', 'g')) AS n_symbols FROM d),
p AS (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS pos FROM d),
g AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, words[pos], words[pos + 1], words[pos + 2]) AS c FROM p),
r AS (SELECT doc_id, count(DISTINCT word) AS n_repeat_words FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS word FROM g WHERE c > 1) GROUP BY doc_id),
l0 AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos FROM d),
l1 AS (SELECT doc_id, line, pos, regexp_extract_all(line, '{word}') AS words, {_ascii_lower('line')} AS low FROM l0),
l2 AS (SELECT doc_id, line, words, low, len(words) AS n, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) > 1 AS again FROM l1 WHERE len(words) > 0),
l3 AS (SELECT doc_id, again, {characters.format("line")} AS chars, again OR {fails} AS fails FROM l2),
l AS (SELECT doc_id, sum(CAST(again AS INT)) AS n_dup_lines, sum(CASE WHEN fails THEN chars ELSE 0 END) AS lost_chars FROM l3 GROUP BY doc_id),
a AS (SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost_chars, 0) AS lost_chars,
             n_words < {LEAST_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {MOST_REPEATED} * n_words AS base_failed
      FROM f LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, CAST(lost_chars AS BIGINT) AS lost_chars, NOT base_failed AND 100 * lost_chars <= {MOST_LOST} * word_chars AS kept
FROM a
"""


def _ascii_lower(column: str) -> str:
    return f"translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


#: For tables whose ids are unique.
SQL = _sql()
