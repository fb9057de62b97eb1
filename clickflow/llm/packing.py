"""Packing: vector bin packing of tokenised examples under limits on tokens, segments and loss-bearing tokens.

Rows are packed as they stream through a task, so many at once as ``ROWS`` and ``CHARS`` allow: nothing is shuffled, a
task holds the ids of so many characters or of one text, and a lost task is simply run again. An example longer than a sequence gives full sequences first; what
is left of all examples of the batch is placed by the dot-product heuristic: of all examples that still fit, the one
whose demands point most in the direction of the sequence's free capacities. When none fits, the free tokens are
filled by cutting the best example that is larger; a sequence that keeps free tokens all the same (the last of a
batch, or one whose segments or loss-bearing tokens are used up) is cut to powers of two, which need no padding.

Cases: a null or empty text is its end-of-text id alone; very long texts become many pieces; equal and repeated
rows are packed each (a row's pieces carry its id); empty tables give an empty result. Only the columns named in
the call are read.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.llm.common import chunks, give_back, texts_of, tidy

SEQUENCE = 1024
#: Segments in a sequence, at most.
SEGMENTS = 64
#: Rows packed together, at most; a bound of a task's memory and of the search for the next example.
ROWS = 2048
#: Characters of texts packed together, at most (or one text); a text has about a quarter as many ids, at most four times as many.
CHARS = 4_000_000
#: The fast library is asked for texts up to this code point; it and the reference library split them alike. Others go to the reference library.
PLAIN = "ɏ"


class Encoder:
    """Ids of texts as the ``tokenizers`` file gives them by default (special strings are found, none are added)."""

    def __init__(self, tokenizer_json: Broadcast[str], special: dict[str, int], ranks: str, pattern: str, end_id: int):
        import tiktoken

        self.tokenizer_json, self.reference = tokenizer_json, None  # made when a text needs it
        pairs = (line.split() for line in ranks.splitlines() if line)
        self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens=special)
        self.allowed, self.end = set(special), end_id

    def __call__(self, text: str) -> np.ndarray:
        if not text or max(text) <= PLAIN:
            ids = self.fast.encode(text, allowed_special=self.allowed, disallowed_special=())
        else:
            if self.reference is None:
                from tokenizers import Tokenizer

                self.reference = Tokenizer.from_str(self.tokenizer_json.value)
            ids = self.reference.encode(text, add_special_tokens=False).ids
        out = np.empty(len(ids) + 1, dtype="<u4")
        out[:-1], out[-1] = ids, self.end
        return out


def place(tokens: np.ndarray, loss: np.ndarray, limits: tuple[int, int, int]) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (example, start, length). ``loss``: the share of each example's tokens that bear loss.

    Limits: tokens, segments and loss-bearing tokens of a sequence. A piece bears its length times the share, rounded up.
    """
    size, segments, most = limits
    out: list[list[tuple[int, int, int]]] = []
    done = np.zeros(len(tokens), dtype=np.int64)
    bears = np.minimum(np.ceil(loss * size), size)
    # a piece may be so long that its own loss-bearing tokens are within the limit
    longest = np.where(bears > most, np.maximum(1, np.floor(most / np.maximum(loss, 1e-9))), size).astype(np.int64)
    longest = np.minimum(longest, size)
    for i in np.flatnonzero(tokens >= longest):
        while tokens[i] - done[i] >= longest[i]:
            out.append([(int(i), int(done[i]), int(longest[i]))])
            done[i] += longest[i]
    left = tokens - done
    live = np.flatnonzero(left > 0)
    live = live[np.argsort(-left[live], kind="stable")]
    while len(live):
        free = np.array([1.0, 1.0, 1.0])  # of each capacity, as shares
        row: list[tuple[int, int, int]] = []
        rest, rest_loss = size, most
        while len(live) and rest and len(row) < segments and rest_loss >= 0:
            n = left[live]
            lossy = np.ceil(n * loss[live])
            fits = (n <= rest) & (lossy <= rest_loss)
            if not fits.any():
                break
            points = n / size * free[0] + free[1] / segments + lossy / max(1, most) * free[2]
            k = int(np.where(fits, points, -1).argmax())
            i = int(live[k])
            row.append((i, int(done[i]), int(left[i])))
            rest, rest_loss = rest - int(n[k]), rest_loss - int(lossy[k])
            free = np.array([rest / size, 1 - len(row) / segments, rest_loss / max(1, most)])
            live = np.delete(live, k)
        if rest and len(live) and len(row) < segments:  # cut an example that is too long to the tokens that are free
            room = np.minimum(np.where(loss[live] > 0, np.floor(rest_loss / np.maximum(loss[live], 1e-9)), rest), rest)
            k = int(room.argmax())
            take, i = int(min(room[k], left[live[k]] - 1)), int(live[k])
            if take > 0:
                row.append((i, int(done[i]), take))
                done[i], left[i], rest = done[i] + take, left[i] - take, rest - take
                order = np.argsort(-left[live], kind="stable")
                live = live[order]
        out.extend(powers(row) if rest else [row])
    return out


def powers(row: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The pieces of one short sequence, cut into sequences whose lengths are powers of two."""
    out: list[list[tuple[int, int, int]]] = []
    total = sum(n for _, _, n in row)
    row = list(reversed(row))
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        out.append([])
        while room:
            i, start, n = row.pop()
            take = min(n, room)
            out[-1].append((i, start, take))
            room -= take
            if n > take:
                row.append((i, start + take, n - take))
    return out


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(documents: DataFrame, tokenizer_path: str, ranks_path: str, pattern: str, keep: list[str], text: str = "text", end_id: int = 0,
         sequence: int = SEQUENCE, segments: int = SEGMENTS, loss_limit: int | None = None, loss_share: Column | None = None,
         with_ids: bool = False, rows: int = ROWS, chars: int = CHARS) -> DataFrame:
    """One row for each piece: the columns ``keep`` of its example, ``PIECES``, and its ``ids`` if asked for.

    ``loss_share``: share of an example's tokens that bear loss (for instruction data: what the assistant says);
    all of them if it is not given. ``loss_limit``: of a sequence; ``sequence`` if it is not given. A sequence's id
    holds the number of the task's partition and its number therein. Files are read on the driver and sent with the
    tasks (a few MB); like-named columns of the input are not kept.
    """
    limits = (sequence, segments, sequence if loss_limit is None else loss_limit)
    made = [x.split()[0] for x in PIECES.split(", ")] + ["ids"]
    keep = [c for c in dict.fromkeys(keep) if c not in made]
    tokenizer_json = Path(tokenizer_path).read_text()
    special = {t["content"]: t["id"] for t in json.loads(tokenizer_json)["added_tokens"]}
    whole_json, ranks = (documents.sparkSession.sparkContext.broadcast(x) for x in (tokenizer_json, Path(ranks_path).read_text()))
    share = F.lit(1.0) if loss_share is None else F.coalesce(loss_share.cast("double"), F.lit(1.0))
    source = documents.select(*keep, F.col(text).alias("__text"), F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)).alias("__share"))
    fields = [*source.schema.fields[:-2], *T.StructType.fromDDL(PIECES).fields]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        sequence_id = TaskContext.get().partitionId() << 36
        for whole in batches:
            encode = encode or Encoder(whole_json, special, ranks.value, pattern, end_id)
            for batch in (b for at in range(0, whole.num_rows, rows) for b in chunks(whole.slice(at, rows), "__text", chars)):
                ids = [encode(t) for part in chunks(batch, "__text") for t in texts_of(part, "__text")]
                n = np.array([len(x) for x in ids], dtype=np.int64)
                sequences = place(n, batch.column("__share").to_numpy(zero_copy_only=False), limits)
                pieces = [(i, s, k) for row in sequences for i, s, k in row]
                counts = np.array([len(row) for row in sequences])
                owner, start, length = (np.array(x, dtype=np.int64) for x in zip(*pieces, strict=True))
                number = np.repeat(sequence_id + np.arange(len(sequences)), counts)
                before = np.cumsum(length) - length
                offset = before - np.repeat(before[np.cumsum(counts) - counts], counts)
                sequence_id += len(sequences)
                # the text stays behind: a long one would be copied with each of its pieces
                cols = [*(c.take(pa.array(owner)) for c in batch.columns[:-2]), pa.array(start), pa.array(length),
                        pa.array([zlib.crc32(ids[i][s:s + k].tobytes()) for i, s, k in pieces], pa.int64()), pa.array(n[owner]), pa.array(number), pa.array(offset)]
                if with_ids:
                    values = np.concatenate([ids[i][s:s + k] for i, s, k in pieces]).view(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(before, len(values)), pa.int32()), pa.array(values)))
                    del values
                del ids
                yield pa.RecordBatch.from_arrays(cols, [f.name for f in fields])
                del cols
                give_back()

    return source.mapInArrow(tidy(task), T.StructType(fields))
