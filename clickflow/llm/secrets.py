"""Secret scans: a linear-chain CRF tags tokens as secret begin, inside or outside, decoded by Viterbi.

Three patterns give base spans (``BASE``). They also label the training tokens: bounded windows around base spans of all
documents, and from documents without any, around odd-looking tokens (addresses, numbers, codes, long words) if they have some. Texts are cut at
white space, quotes, brackets, commas, colons, ``&``, ``=``, ``|`` and sentence ends; every piece is tagged, whatever its length. A
token's features are its shape, affixes and length, what it is cut off by, its neighbouring words and shapes, and features of
the whole file (how dense it is in digits, assignments and marks). Tagged runs that overlap no base span become spans of kind
``crf``; base spans always stay.

Most tokens are certain: where "outside" leads by more than all transitions could make up for, no other label can be on the
best path. Viterbi runs on the stretches between such tokens, with the same result as over whole texts.

Offsets are code points, the end exclusive; spans are ordered by start, then kind as listed in ``KINDS``.

Cases: a null or empty text has no span; very long texts are scanned whole; repeated rows are scanned each; empty
tables give an empty result; without any base span in the table nothing is learned (``fit`` says so by giving
None) and only base spans are reported. Only the columns named in the call are read; ``redact`` keeps all columns.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from operator import ne

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.llm import crf
from clickflow.llm.common import chunks, texts_of, tidy

KINDS = ("assign", "access", "hex", "crf")
# What counts as a base span. Key names in either case (ASCII); a match whose value is too short is dropped.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 18
#: A run of [0-9a-f] is matched whole, so the least length may stand in the pattern.
HEX = re.compile(r"[0-9a-f]{16,}")

#: Training windows at most with and without a base span; tokens to both sides.
WINDOWS, AROUND = 3000, 8
#: Documents without a base span that offer training windows, about.
SAMPLE = 60_000
DIM = 1 << 17
#: Features of a token: its own, as the one before, as the one after.
OWN, BEFORE, AFTER = 7, 2, 2
WIDTH = OWN + BEFORE + AFTER
_SEPARATORS = r"""[\s"'`,;:{}()\[\]<>&=|]"""
#: Runs of separators with the sentence ends before them, or at the end of the text; a run of marks is looked at once. The pattern
#: begins with one set of characters, which the search skips to.
CUT = re.compile(rf"({_SEPARATORS[:-1]}.!?](?<![.!?][\s\S])(?:(?<=[.!?])[.!?]*+(?:{_SEPARATORS}++|\Z)|(?<![.!?]){_SEPARATORS}*+)"
                 rf"(?:[.!?]*+{_SEPARATORS}++)*(?:[.!?]++\Z)?)")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index into KINDS, end), ordered."""
    return sorted((a, k, b) for a, k, b, _ in _matches(text))


def _matches(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of base spans."""
    out = []
    if "=" in text or ":" in text:  # an assignment has one of them
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return out


def cut(text: str) -> tuple[list[str], list[str]]:
    """The tokens of a text, none of them empty but for an empty text's one, and what stands before each."""
    pieces = CUT.split(text)
    tokens, gaps = pieces[::2], ["", *pieces[1::2]]
    if not tokens[0] and len(tokens) > 1:
        del tokens[0]
        gaps[:2] = [gaps[1]]
    if not tokens[-1] and len(tokens) > 1:
        del tokens[-1], gaps[-1]
    return tokens, gaps


def _places(tokens: list[str], gaps: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each token."""
    n = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    ends = np.cumsum(n + np.fromiter(map(len, gaps), dtype=np.int64, count=len(gaps)))
    return ends - n, ends


_DIGIT, _UPPER, _LOWER, _OTHER = range(4)
_CLASS = bytes(_DIGIT if chr(c).isdigit() and c < 128 else _UPPER if chr(c).isupper() and c < 128 else _LOWER if c >= 128 or chr(c).isalpha() else _OTHER for c in range(256))
_NO_MARK = bytes(c for c in range(256) if c >= 128 or chr(c).isalnum())


#: What ``_shape_features`` has made; distinct shapes are few, and past this many the table begins anew.
_SHAPES: dict[tuple, tuple[int, ...]] = {}
_MOST_SHAPES = 50_000


def _shape_features(kinds: int, runs: int, size: int, dense: int, marks: bytes) -> tuple[int, ...]:
    """Marks; classes with runs and length, with how often classes change, and that with the length alone; then as a neighbour."""
    known = _SHAPES.get((kinds, runs, size, dense, marks))
    if known is None:
        if len(_SHAPES) > _MOST_SHAPES:
            _SHAPES.clear()
        shape = kinds * 64 + min(runs, 15) * 4
        known = _SHAPES[kinds, runs, size, dense, marks] = (
            zlib.crc32(marks, 3) % DIM, (shape * 16 + size + 1) * 2654435761 % DIM, (kinds * 8 + dense + 70001) * 2654435761 % DIM,
            (min(size, 4) * 8 + dense + 90001) * 2654435761 % DIM, zlib.crc32(marks, kinds + 100) % DIM, zlib.crc32(marks, kinds + 200) % DIM)
    return known


#: The same of plain words, by their classes and length (up to 32 bytes).
_WORDS: dict[int, tuple[int, ...]] = {}


def _of_length(kinds: int, runs: int, n: int, marks: bytes) -> tuple[int, ...]:
    return _shape_features(kinds, runs, min(n // 4, 5) + (n >= 32), min(4, 5 * runs // max(1, n)), marks)


def token_features(token: str) -> list[int]:
    """Word, affixes, marks, and shape (classes, runs of classes, length); then word and shape as a neighbour."""
    raw = token.encode("utf-8", "replace")
    if token.isalpha():  # the common case: a plain word
        kinds, n = 4 if token.islower() else 2 if token.isupper() else 6, len(raw)
        at = kinds * 64 + (n if n < 32 else 32)
        shape = _WORDS.get(at)
        if shape is None:
            shape = _WORDS[at] = _of_length(kinds, 1, n, b"")
        h = zlib.crc32(raw.lower())
    else:
        cls = raw.translate(_CLASS)
        runs = 1 + sum(map(ne, cls, cls[1:]))
        kinds = sum(1 << k for k in set(cls))
        shape = _of_length(kinds, runs, len(raw), bytes(sorted(set(raw.translate(None, _NO_MARK)))))
        h = zlib.crc32(raw.lower().strip(b"\"'.,;:!?()"))
    mark, mix, mix2, mix3, before, after = shape
    return [h % DIM, zlib.crc32(raw[:4], 1) % DIM, zlib.crc32(raw[-2:], 2) % DIM, mark, mix, mix2, mix3,
            (h ^ 0x5BD1E995) % DIM, before, (h ^ 0x27D4EB2F) % DIM, after]


def file_features(text: str) -> list[int]:
    """Of the whole text: density of digits, of assignments and of quotes, as powers of two."""
    n = len(text) + 1
    digits = sum(map(text.count, "0123456789"))
    return [zlib.crc32(b"%d/%d" % (k, int(np.log2(1 + 4096 * c / n)))) % DIM
            for k, c in enumerate((digits, text.count("=") + text.count(":"), text.count('"') + text.count("'")))]


def gap_feature(gap: str) -> int:
    """Of what stands before a token: its marks, and whether it holds space."""
    marks = gap.split()
    return zlib.crc32("".join(marks)[-3:].encode() + (b" " if not marks or gap[-1:].isspace() else b""), 11) % DIM


class Tagger:
    """Best tags of a chunk of texts; keeps what distinct tokens contribute from chunk to chunk."""

    def __init__(self, model: crf.Model):
        self.model, self.types = model, crf.Types(token_features, WIDTH, most=120_000)
        self.gaps: dict[str, int] = {}
        self.gap_weights = np.zeros((0, model.labels))
        self.roles = [np.zeros((0, model.labels)) for _ in range(3)]
        # what another label can gain by transitions to and from it, at most
        lo, hi = min(model.trans.min(), model.start.min()), max(model.trans.max(), model.start.max())
        self.spread = 2 * (hi - lo)

    def _weights(self) -> None:
        """Sums of weights of the tokens and gaps that came since the last call."""
        w, done = self.model.weights, len(self.roles[0])
        rows = np.array(self.types.flat[done * WIDTH:], dtype=np.int64).reshape(-1, WIDTH)
        parts = (rows[:, :OWN], rows[:, OWN:OWN + BEFORE], rows[:, OWN + BEFORE:])
        self.roles = [np.concatenate([x, w[p].sum(axis=1)]) for x, p in zip(self.roles, parts, strict=True)]
        new = list(self.gaps)[len(self.gap_weights):]
        if new:
            self.gap_weights = np.concatenate([self.gap_weights, w[[gap_feature(g) for g in new]]])

    def tags(self, texts: list[str]) -> tuple[list[tuple[list[str], list[str]]], np.ndarray, np.ndarray]:
        """(tokens and gaps of each text; owner and tag of all tokens that are not outside, with their number in the text)."""
        if self.types.full:
            self.types.reset()
            self.roles = [x[:0] for x in self.roles]
        if len(self.gaps) > 20_000:
            self.gaps, self.gap_weights = {}, self.gap_weights[:0]
        blank = int(self.types.of([""])[0])
        parts = [cut(t) for t in texts]
        tokens, owner, first = crf.chained([p[0] for p in parts])
        ids = self.types.of(tokens)
        gaps = [g for p in parts for g in p[1]]
        for g in set(gaps).difference(self.gaps):
            self.gaps[g] = len(self.gaps)
        gap = np.fromiter(map(self.gaps.__getitem__, gaps), dtype=np.int64, count=len(gaps))
        self._weights()
        before, after = crf.neighbours(ids, first, blank)
        of_file = self.model.weights[np.array([file_features(t) for t in texts])].sum(axis=1)
        tables = [(self.roles[0], ids), (self.roles[1], before), (self.roles[2], after), (self.gap_weights, gap), (of_file, owner)]

        lead = [sum((t[:, 0] - t[:, k])[i] for t, i in tables) for k in range(1, self.model.labels)]
        open_ = np.minimum.reduce(lead) <= self.spread
        if not open_.any():
            return parts, np.zeros((0, 2), dtype=np.int64), np.zeros(0, dtype=np.int64)
        near = open_.copy()  # and the certain tokens beside them, which a stretch begins and ends with
        near[1:] |= open_[:-1] & ~first[1:]
        near[:-1] |= open_[1:] & ~first[1:]
        at = np.flatnonzero(near)
        emit = sum(t[i[at]] for t, i in tables)
        sure = ~open_[at]
        emit[sure, 1:] = -1e9
        begins = first[at]
        begins[0] = True
        begins[1:] |= np.diff(at) > 1
        # a stretch that begins within a text begins with a certain token, so the start's weights don't matter there
        tags = crf.viterbi(self.model, emit, begins)
        hit = at[tags > 0]
        number = hit - np.searchsorted(owner, owner[hit])
        return parts, np.stack([owner[hit], number], axis=1), tags[tags > 0]


def tagged_spans(tokens: list[str], gaps: list[str], numbers: np.ndarray, tags: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Base spans, and the runs of tagged tokens (their ``numbers`` and ``tags``) that overlap none of them."""
    out = list(base)
    if len(numbers):
        starts, ends = _places(tokens, gaps)
        runs: list[list[int]] = []
        last = -2
        for k, tag in zip(numbers.tolist(), tags.tolist(), strict=True):
            if tag == 2 and k == last + 1:
                runs[-1][1] = int(ends[k])
            else:
                runs.append([int(starts[k]), int(ends[k])])
            last = k
        out += [(a, 3, b) for a, b in runs if b > a and all(b <= s or a >= e for s, _, e in base)]
        out.sort()
    return out


def labelled_tokens(text: str, kinds: tuple[int, ...] = (0, 1, 2)) -> tuple[list[str], list[str], list[int]]:
    """Tokens, gaps and labels: the values of base spans of ``kinds`` begin with 1 and go on with 2."""
    tokens, gaps = cut(text)
    tags = [0] * len(tokens)
    starts, ends = _places(tokens, gaps)
    for _, kind, e, s in _matches(text):
        if kind in kinds:
            k, tag = int(np.searchsorted(ends, s, side="right")), 1
            while k < len(tokens) and starts[k] < e:
                tags[k] = tags[k] or tag
                tag, k = 2, k + 1
    return tokens, gaps, tags


_ODD, _LONG = re.compile(r"[0-9@_/+]"), 15


def _training_windows(documents: DataFrame, id_col: str, text: str, kinds: tuple[int, ...], modulus: int) -> DataFrame:
    """(id, found, tokens, gaps, tags, file): a window around one of a document's base spans; without any, from one document in ``modulus``."""
    names = ["id", "found", "tokens", "gaps", "tags", "file"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                out = []
                for i, t in zip(part.column("id").to_pylist(), texts_of(part), strict=True):
                    at = zlib.crc32(str(i).encode())
                    spans = {m[1] for m in _matches(t)}
                    # a document with a kind that is withheld teaches nothing: its spans would count as outside
                    if not t or at % modulus and not spans or not spans.issubset(kinds):
                        continue
                    tokens, gaps, tags = labelled_tokens(t, kinds)
                    hits = [k for k, y in enumerate(tags) if y == 1]
                    odd = [] if hits else [k for k, x in enumerate(tokens) if _ODD.search(x)] or [k for k, x in enumerate(tokens) if len(x) >= _LONG]
                    k = hits[at % len(hits)] if hits else odd[at % len(odd)] if odd else at % len(tokens)
                    cut_ = slice(max(0, k - AROUND), k + AROUND + 1)
                    out.append((i, bool(hits), [x[:4096] for x in tokens[cut_]], [x[-8:] for x in gaps[cut_]], tags[cut_], file_features(t)))
                cols = list(zip(*out, strict=True)) or [[]] * 6
                kinds_ = [pa.int64(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds_, strict=True)], names)

    return documents.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        tidy(task), "id long, found boolean, tokens array<string>, gaps array<string>, tags array<int>, file array<int>")


def fit(documents: DataFrame, id_col: str = "doc_id", text: str = "text", sample: int = SAMPLE, windows: int = WINDOWS, kinds: tuple[int, ...] = (0, 1, 2)) -> crf.Model | None:
    """Train on windows around base spans (of ``kinds``) of all documents and on windows of about ``sample`` documents without one; None if there is no base span.

    The driver gets at most 2 * ``windows`` windows of 2 * ``AROUND`` + 1 tokens of at most 4,096 characters.
    """
    rows = _training_windows(documents, id_col, text, kinds, max(1, documents.count() // max(1, sample)))
    nth = F.row_number().over(Window.partitionBy("found").orderBy(F.xxhash64("id"), "id", F.xxhash64("tokens")))
    got = rows.withColumn("nth", nth).where(F.col("nth") <= windows).orderBy("found", "nth").collect()
    if not any(r["found"] for r in got):
        return None
    types = crf.Types(token_features, WIDTH, most=1 << 30)
    blank = int(types.of([""])[0])
    tokens, owner, first = crf.chained([r["tokens"] for r in got])
    ids = types.of(tokens)
    rows_of, (before, after) = types.rows, crf.neighbours(ids, first, blank)
    gap = np.array([gap_feature(g) for r in got for g in r["gaps"]])[:, None]
    x = np.concatenate([rows_of[ids, :OWN], rows_of[before, OWN:OWN + BEFORE], rows_of[after, OWN + BEFORE:], gap, np.array([r["file"] for r in got])[owner]], axis=1)
    # in two of three windows the words and affixes themselves are blank, so that shapes and marks must tell a secret; in one of
    # these all but the token's own shape
    words, around = (0, 1, 2, OWN, OWN + BEFORE), (OWN + 1, WIDTH - 1)
    x[np.ix_(owner % 3 != 0, words)] = rows_of[blank, list(words)]
    x[np.ix_(owner % 3 == 2, around)] = rows_of[blank, list(around)]
    x[owner % 3 == 2, WIDTH:] = gap_feature(" ")
    return crf.train(x, np.array([y for r in got for y in r["tags"]]), first, 3, DIM)


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _found(batch: pa.RecordBatch, text: str, tagger: Tagger | None) -> list[tuple[str, list[tuple[int, int, int]]]]:
    texts = texts_of(batch, text)
    base = [base_spans(t) for t in texts]
    if tagger is None:
        return list(zip(texts, base, strict=True))
    parts, hits, tags = tagger.tags(texts)
    at = np.searchsorted(hits[:, 0], np.arange(len(texts) + 1))
    return [(t, tagged_spans(*parts[i], hits[at[i]:at[i + 1], 1], tags[at[i]:at[i + 1]], base[i])) for i, t in enumerate(texts)]


def find(documents: DataFrame, model: crf.Model | None, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``spans`` (kind, start, end); a column of that name in the input is not kept."""
    keep = [c for c in dict.fromkeys(keep) if c != "spans"]
    source = documents.select(*keep, F.col(text).alias("__text"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("spans", T.ArrayType(SPAN))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model) if model is not None else None
        for batch in batches:
            for part in chunks(batch, "__text"):
                spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in x] for _, x in _found(part, "__text", tagger)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(spans, _SPANS)], [*keep, "spans"])

    return source.mapInArrow(tidy(task), schema)


def masked(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """``text`` with each stretch that spans cover replaced by ``mark``."""
    out, at = [], 0
    for a, _, b in spans:
        if b > at:
            out.append(text[at:max(at, a)])
            if a >= at:
                out.append(mark)
            at = b
    return "".join([*out, text[at:]])


def redact(documents: DataFrame, model: crf.Model | None, text: str = "text", length: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns, with secrets in ``text`` replaced by ``mark``; ``length`` (if there) is the new text's code points. Null texts stay null."""
    names, schema = documents.columns, documents.schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model) if model is not None else None
        for batch in batches:
            for part in chunks(batch, text):
                new = [masked(t, x, mark) if x else t for t, x in _found(part, text, tagger)]
                cols = dict(zip(names, part.columns, strict=True))
                old = cols[text]
                cols[text] = pa.array([t if ok else None for t, ok in zip(new, old.is_valid().to_pylist(), strict=True)], old.type)
                if length in cols:
                    cols[length] = pa.array([len(t) if t != o else n for t, o, n in zip(new, texts_of(part, text), cols[length].to_pylist(), strict=True)], cols[length].type)
                yield pa.RecordBatch.from_arrays(list(cols.values()), names)

    return documents.mapInArrow(tidy(task), schema)
