"""Token counts: pieces are counted once per distinct pre-token, joined to pre-token frequencies, and summed by document.

For a word-end tokenizer of lower-cased text that drops white space (word_bpe_49k.json): nothing joins across ASCII
white space, so the number of pieces of a text is the sum over its runs without it, and a run is one or two
pre-tokens (``pretokens``).

Plan, for a table of any size:
1. A task turns each batch of documents (a block) into the block's distinct pre-tokens, one row each, and one row
   with the block's documents and their frequencies by the pre-token's number in the block. Frequent pre-tokens so
   become one row per block however many documents hold them; the blocks are written to the shared folder.
2. The pre-token rows are shuffled and sorted by pre-token; a task counts each distinct one once and passes the
   count on to all blocks that have it. No ids are kept.
3. Counts and frequencies of a block meet in one group, bounded by the block's size, and are summed by document.

Cases: a null or empty text has 0 bytes and 0 tokens; a very long text may be a block by itself; repeated rows are
counted each; empty tables give an empty result. Only the columns named in the call are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.llm.common import chunks, saved, texts_of

#: Characters of a block; more than this only if one text is longer.
BLOCK_CHARS = 32_000_000
#: Words up to this code point are known to split from the marks after them.
LATIN = "ɏ"
#: A number of pieces that isn't sent back to the blocks: a pre-token without a number has this one.
USUAL = 4
#: Characters of pre-tokens that the library is given at once.
ASK_CHARS = 500_000


def pretokens(raw: bytes) -> tuple[bytes, bytes]:
    """A run without white space as one or two pre-tokens (the second may be empty) that make as many pieces as the run.

    Marks after a Latin word are pre-tokens of their own whatever they are, but for the apostrophe, which may begin
    a contraction; and ASCII letters may be lower-cased, as the tokenizer does it, but in what may be a special string.
    """
    if b"<|" in raw:
        return raw, b""
    raw = raw.lower()
    word = raw.rstrip(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
    if len(word) < len(raw) and word:
        text = word.decode()
        if word.isascii() and text.isalpha() or max(text) <= LATIN and text.lower().isalpha():  # lower-casing may make marks
            return word, raw[len(word):]
    return raw, b""


def _blocks(documents: DataFrame, keep: list[str], text: str) -> DataFrame:
    """Rows of two kinds: (block, word, at) for a distinct pre-token, and (block, block_rows) for the block's documents."""
    source = documents.select(*keep, F.col(text).alias("__text"))
    names = ["block", "word", "at", "block_rows"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = count(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for part in chunks(batch, "__text", BLOCK_CHARS):
                runs: dict[bytes, int] = {}  # distinct runs without white space, by first appearance
                n_bytes, steps, freq = [], [], []
                for t in (t for few in chunks(part, "__text") for t in texts_of(few, "__text")):
                    raw = t.encode()
                    n_bytes.append(len(raw))
                    own = np.fromiter((runs.setdefault(w, len(runs)) for w in raw.split()), dtype=np.int32)
                    a, f = np.unique(own, return_counts=True)
                    steps.append(np.diff(a, prepend=0).astype(np.int32))  # small numbers, which compress well
                    freq.append(f.astype(np.int32))
                words: dict[bytes, int] = {b"": 0}
                first, second = (np.empty(len(runs), dtype=np.int32) for _ in range(2))
                for i, w in enumerate(runs):
                    x, y = pretokens(w)
                    first[i], second[i] = words.setdefault(x, len(words)), words.setdefault(y, len(words))
                rows = part.drop_columns(["__text"]).append_column("n_bytes", pa.array(n_bytes, pa.int64())).append_column("n_runs", pa.array(list(map(len, steps)), pa.int64()))
                numbers = [_planes(x) for x in (np.concatenate(steps), np.concatenate(freq), np.diff(first, prepend=0), second)]
                sink = pa.BufferOutputStream()
                for columns in (rows, pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in numbers], ["steps", "freq", "first", "second"])):
                    with pa.ipc.new_stream(sink, columns.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                        out.write_batch(columns)
                block = next(number)
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([None], pa.binary()), pa.array([-1], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names)
                found = list(words)
                for i in range(1, len(found), 50_000):
                    some = found[i:i + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), block)), pa.array(some, pa.binary()), pa.array(np.arange(i, i + len(some), dtype=np.int32)), pa.nulls(len(some), pa.binary())], names)

    return source.mapInArrow(task, "block long, word binary, at int, block_rows binary")


def _planes(numbers: np.ndarray) -> bytes:
    """int32 numbers as all their lowest bytes, then all second ones, and so on: small numbers then compress well."""
    return numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _counted(words: DataFrame, tokenizer_path: str) -> DataFrame:
    """(block, at, n) of rows sorted by ``word``, but for n = ``USUAL``: every distinct pre-token is given to the library once."""
    shared = words.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_text())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer, last, last_n = None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            tokenizer = tokenizer or Tokenizer.from_str(shared.value)
            coded = batch.column("word").dictionary_encode()
            words = coded.dictionary.to_pylist()
            n = np.zeros(len(words), dtype=np.int32)
            known = int(words[0] == last)  # the batch may begin with the word that ended the last one
            n[:known] = last_n
            at = known
            while at < len(words):
                stop, chars = at, 0
                while stop < len(words) and (stop == at or chars < ASK_CHARS):
                    chars += len(words[stop])
                    stop += 1
                n[at:stop] = [len(e) for e in tokenizer.encode_batch_fast([w.decode() for w in words[at:stop]], add_special_tokens=False)]
                at = stop
            each = n[coded.indices.to_numpy()]
            last, last_n = batch.column("word")[-1].as_py(), int(each[-1])
            rest = pa.array(each != USUAL)
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("at"), pa.array(each)], ["block", "at", "n"]).filter(rest)

    return words.mapInArrow(task, "block long, at int, n int")


def count_tokens(documents: DataFrame, tokenizer_path: str, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep``, ``n_bytes`` (UTF-8) and ``n_tokens``; like-named columns of the input are not kept."""
    made = ("n_bytes", "n_tokens", "n_runs")
    keep = [c for c in dict.fromkeys(keep) if c not in made]
    spark = documents.sparkSession
    blocks, _ = saved(spark, _blocks(documents, keep, text), "token-blocks")
    words = blocks.where("word is not null").select("block", "word", "at")
    counted = _counted(words.repartition("word").sortWithinPartitions("word"), tokenizer_path)
    holders = blocks.where("word is null").select("block", "block_rows")
    schema = T.StructType([*documents.select(*keep).schema.fields, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def sums(holder: pa.Table, counts: pa.Table) -> pa.Table:
        stream = pa.BufferReader(holder.column("block_rows")[0].as_buffer())
        rows, packed = (pa.ipc.open_stream(stream).read_all().combine_chunks() for _ in range(2))
        steps, freq, first, second = (_numbers(packed.column(c)[0].as_py()) for c in ("steps", "freq", "first", "second"))
        n = np.full(int(second.max(initial=0)) + int(np.cumsum(first).max(initial=0)) + 2, USUAL, dtype=np.int64)
        n[0] = 0  # the empty pre-token
        n[counts.column("at").to_numpy()] = counts.column("n").to_numpy()
        of_run = n[np.cumsum(first)] + n[second]
        ends = np.concatenate([[0], np.cumsum(rows.column("n_runs").to_numpy())])
        gone = np.cumsum(steps, dtype=np.int64)
        before = np.concatenate([[0], gone])[ends[:-1]]  # sum of all steps of earlier documents
        at = gone - np.repeat(before, np.diff(ends))
        tokens = np.diff(np.concatenate([[0], np.cumsum(of_run[at] * freq)])[ends])
        return rows.drop_columns(["n_runs"]).append_column("n_tokens", pa.array(tokens, pa.int64()))

    return holders.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(sums, schema)
