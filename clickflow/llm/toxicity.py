"""Toxicity: a linear-chain CRF over words tags toxic spans; forward-backward marginals give document scores and offsets.

Labels are known by document only, so tokens are labelled first: a word or word stem is toxic if it stands in
many more different contexts (pairs of neighbours; so copies of one text count once) in toxic training documents
than in clean ones. Its tokens in toxic documents are labelled toxic, all others clean, and the field is trained
on bounded windows of them. A token's features are its word, stems, ending, shape and both neighbours. A
document's score is the largest marginal of its tokens; its spans are the tokens whose marginal reaches a limit.

Cases: a null or empty text has no token, no span and score 0; very long texts are tagged whole; equal texts get
equal scores; repeated rows are scored each; empty tables give an empty result; without training rows of both
classes, or without toxic words, every score is 0. Only the columns named in the call are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.llm import crf
from clickflow.llm.common import chunks, labelled_sample, texts_of

#: Training rows of each label at most, words of the token labelling at most, tokens to both sides in a training window.
PER_CLASS, LEXICON, AROUND = 4000, 5000, 8
#: A word is toxic with so many contexts at least, and this many times the rate of clean documents.
LEAST, TIMES = 4, 25.0
DIM = 1 << 17
#: 5 features of the token itself, 2 as the word before another, 2 as the word after another.
WIDTH = 9
SPAN_AT = 0.5


def word(token: str) -> str:
    """Lower case, without marks at the ends."""
    return token.lower().strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def stems(w: str) -> list[str]:
    return [f"w:{w}", *(f"p{k}:{w[:k]}" for k in (4, 5) if len(w) > k)]


def token_features(token: str) -> list[int]:
    """The word, its stems of 4 and 5 letters, its ending, its shape; then as the word before and after another."""
    w = word(token)
    n, raw = len(w), w.encode("utf-8", "replace")
    h = zlib.crc32(raw)
    p4, p5, end = (raw, raw, raw) if n <= 4 else (w[:4].encode("utf-8", "replace"), w[:5].encode("utf-8", "replace"), w[-3:].encode("utf-8", "replace"))
    shape = token.isalpha() + 2 * token.islower() + 4 * token.isupper() + 8 * token.istitle() + 16 * token.isalnum() + 32 * w.isalpha()
    return [h % DIM, zlib.crc32(p4, 1 + (n > 4)) % DIM, zlib.crc32(p5, 3 + (n > 5)) % DIM, zlib.crc32(end, 5) % DIM,
            (shape * 16 + min(n, 12)) * 2654435761 % DIM, (h ^ 0x5BD1E995) % DIM, (shape * 16 + 13) * 2654435761 % DIM,
            (h ^ 0x27D4EB2F) % DIM, (shape * 16 + 14) * 2654435761 % DIM]


def _rows(types: crf.Types, ids: np.ndarray, first: np.ndarray, blank: int) -> np.ndarray:
    """[n, WIDTH] feature ids: of the token, and its neighbours' features as such."""
    rows = types.rows
    before, after = crf.neighbours(ids, first, blank)
    return np.concatenate([rows[ids, :5], rows[before, 5:7], rows[after, 7:9]], axis=1)


@dataclass
class Model:
    field: crf.Model | None


class Tagger:
    """Marginals of a chunk of texts; keeps distinct tokens' features from chunk to chunk."""

    def __init__(self, model: Model):
        self.model, self.types = model, crf.Types(token_features, WIDTH)

    def marginals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(owner, P(toxic)) of all tokens of all texts, in order."""
        if self.types.full:
            self.types.reset()
        blank = int(self.types.of([""])[0])
        tokens, owner, first = crf.chained([t.split() for t in texts])
        if self.model.field is None or not tokens:
            return owner, np.zeros(len(owner))
        ids = self.types.of(tokens)
        rows, w = self.types.rows, self.model.field.weights
        own, as_before, as_after = w[rows[:, :5]].sum(axis=1), w[rows[:, 5:7]].sum(axis=1), w[rows[:, 7:9]].sum(axis=1)
        before, after = crf.neighbours(ids, first, blank)
        return owner, crf.marginals(self.model.field, own[ids] + as_before[before] + as_after[after], first)[:, 1]


def lexicon(rows: DataFrame, sizes: tuple[int, int]) -> set[str]:
    """Words and stems with many more contexts in toxic than in clean sampled documents; at most ``LEXICON``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                out: set[tuple[str, int, int]] = set()
                for t, y in zip(texts_of(part), part.column("label").to_pylist(), strict=True):
                    ws = ["", *map(word, t.split()), ""]
                    for i in range(1, len(ws) - 1):
                        if ws[i]:
                            context = zlib.crc32(f"{ws[i - 1]} {ws[i + 1]}".encode("utf-8", "replace"))
                            out.update((x, y, context) for x in stems(ws[i]))
                cols = list(zip(*out, strict=True)) or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64())], ["x", "y", "context"])

    seen = rows.mapInArrow(task, "x string, y int, context long").distinct().groupBy("x").agg(
        F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c"))
    rate = (F.col("t") / sizes[1]) / ((F.col("c") + 0.5) / sizes[0])
    return {r[0] for r in seen.where((F.col("t") >= LEAST) & (rate >= TIMES)).orderBy(F.desc("t"), "x").limit(LEXICON).select("x").collect()}


def windows(rows: DataFrame, toxic: set[str]) -> DataFrame:
    """One window of tokens and labels for each sampled document: around a toxic word, a clean look-alike, or anywhere."""
    near = {x[3:7] if x[0] == "p" else x[2:6] for x in toxic}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                out = []
                for i, t, y in zip(part.column("id").to_pylist(), texts_of(part), part.column("label").to_pylist(), strict=True):
                    tokens = t.split()
                    hit = [bool(y) and not toxic.isdisjoint(stems(word(x))) for x in tokens]
                    at = [k for k, h in enumerate(hit) if h] or [k for k, x in enumerate(tokens) if not y and word(x)[:4] in near]
                    if not tokens or y and not at:
                        continue  # a toxic document without a known toxic word teaches nothing about tokens
                    k = at[i % len(at)] if at else i % len(tokens)
                    cut = slice(max(0, k - AROUND), k + AROUND + 1)
                    out.append((i, [x[:64] for x in tokens[cut]], [int(h) for h in hit[cut]]))
                cols = list(zip(*out, strict=True)) or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.list_(pa.string())), pa.array(cols[2], pa.list_(pa.int32()))], ["id", "tokens", "tags"])

    return rows.mapInArrow(task, "id long, tokens array<string>, tags array<int>")


def fit(documents: DataFrame, labels: DataFrame, train: Column, label: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """The driver gets at most ``LEXICON`` words and 2 * ``per_class`` windows of 2 * ``AROUND`` + 1 short tokens."""
    rows, sizes = labelled_sample(documents, labels, label, train, per_class)
    if not sizes.get(0) or not sizes.get(1):
        return Model(None)
    toxic = lexicon(rows, (min(per_class, sizes[0]), min(per_class, sizes[1])))
    got = windows(rows, toxic).orderBy("id", F.xxhash64("tokens")).collect() if toxic else []
    if not any(1 in r[2] for r in got):
        return Model(None)
    types = crf.Types(token_features, WIDTH, most=1 << 30)
    blank = int(types.of([""])[0])
    tokens, _, first = crf.chained([r[1] for r in got])
    ids = types.of(tokens)
    return Model(crf.train(_rows(types, ids, first, blank), np.array([y for r in got for y in r[2]]), first, 2, DIM))


def spans_of(text: str, p: np.ndarray, limit: float) -> list[dict]:
    """Runs of tokens at or over ``limit`` as code point offsets, end exclusive, with their largest marginal."""
    out: list[dict] = []
    last = -2
    for k, m in enumerate(re.finditer(r"\S+", text)):
        if p[k] >= limit:
            if k == last + 1:
                out[-1]["end"], out[-1]["p"] = m.end(), max(out[-1]["p"], float(p[k]))
            else:
                out.append({"start": m.start(), "end": m.end(), "p": float(p[k])})
            last = k
    return out


def score(documents: DataFrame, model: Model, keep: list[str], text: str = "text", span_at: float = SPAN_AT) -> DataFrame:
    """The columns ``keep``, ``score``, and ``spans`` (start, end, p) of the offending tokens; like-named input columns are not kept."""
    keep = [c for c in dict.fromkeys(keep) if c not in ("score", "spans")]
    source = documents.select(*keep, F.col(text).alias("__text"))
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("p", T.DoubleType())])
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for batch in batches:
            for part in chunks(batch, "__text"):
                texts = texts_of(part, "__text")
                owner, p = tagger.marginals(texts)
                top = np.zeros(len(texts))
                np.maximum.at(top, owner, p)
                at = np.searchsorted(owner, np.arange(len(texts) + 1))
                spans = [spans_of(t, p[at[i]:at[i + 1]], span_at) if top[i] >= span_at else [] for i, t in enumerate(texts)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(top), pa.array(spans, kind)], [*keep, "score", "spans"])

    return source.mapInArrow(task, schema)
