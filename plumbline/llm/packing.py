"""Packing token sequences under several limits at once.

A piece is a vector: its tokens, one segment, and the tokens that bear loss. A sequence has a limit
in each. A sequence is filled by the dot-product heuristic: of the pieces waiting that fit in every
limit, the one whose vector has the largest dot product with what the sequence has left, both in
shares of the limits. When none fits and pieces may be cut, the best piece too long is cut to what is
left. Each task packs the rows of its own partition from a pool of bounded size, so nothing is
shuffled and no task sees more than its share.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from plumbline.llm.shared import text_of

END_ID = 1


@dataclass(frozen=True)
class Limits:
    """Of one sequence. pool: pieces that wait at most; min_piece: no cut leaves less in a sequence."""

    tokens: int = 2048
    segments: int = 128
    loss: int = 2048
    pool: int = 1024
    min_piece: int = 8


class Packer:
    """Pieces in, placed pieces out: (piece, sequence, offset). A piece is (key, start, length, loss)."""

    def __init__(self, limits: Limits, cut: bool):
        self.limits, self.cut, self.sequence = limits, cut, 0
        self.shares = np.array([limits.tokens, limits.loss], dtype=float)
        size = limits.pool + 1
        self.pieces: list = [None] * size
        self.vectors = np.full((size, 2), np.inf)  # an empty place fits nowhere
        self.free = list(range(size))

    def add(self, key, start: int, length: int, loss: int) -> Iterator[tuple]:
        at = self.free.pop()
        self.pieces[at], self.vectors[at] = (key, start), (length, loss)
        while not self.free:
            yield from self.fill()

    def finish(self) -> Iterator[tuple]:
        while len(self.free) < len(self.pieces):
            yield from self.fill()

    def _take(self, at: int, length: int, loss: int):
        key, start = self.pieces[at]
        if length == self.vectors[at, 0]:
            self.vectors[at], self.pieces[at] = np.inf, None
            self.free.append(at)
        else:
            self.vectors[at] -= (length, loss)
            self.pieces[at] = (key, start + length)
        return key, start, length, loss

    def fill(self) -> Iterator[tuple]:
        """Close one sequence."""
        left, segments, offset, sequence = self.shares.copy(), self.limits.segments, 0, self.sequence
        self.sequence += 1
        while segments and left[0] > 0:
            fits = (self.vectors <= left).all(axis=1)
            if fits.any():
                score = np.where(fits, self.vectors @ (left / self.shares**2), -1.0)
                at = int(score.argmax())
                length, loss = (int(x) for x in self.vectors[at])
            else:
                room = int(min(left))
                waiting = np.isfinite(self.vectors[:, 0])
                if not self.cut or room < self.limits.min_piece or not waiting.any():
                    break
                at = int(np.where(waiting, self.vectors[:, 0], -1.0).argmax())
                # the loss of a cut piece: every token but its first may bear it
                length = min(room, int(self.vectors[at, 0]))
                loss = min(length, int(self.vectors[at, 1]))
                if length < self.limits.min_piece:
                    break
            piece = self._take(at, length, loss)
            yield piece, sequence, offset
            offset, segments, left = offset + length, segments - 1, left - (length, loss)


class Encoder:
    """Token ids of whole texts, as bytes of unsigned 32-bit numbers.

    Texts go to a byte-pair encoder with the tokenizer's own pattern, vocabulary and ranks, which gives the same ids.
    It takes about as long for words never met before as for frequent ones, and nothing is kept from text to text.
    Texts with one of the tokenizer's special strings, or with white space so long that the encoder's pattern gives up
    on it, go to the tokenizer itself.
    """

    #: A text that is white space over such a stretch goes to the tokenizer; shorter white space is safe up to twice this.
    STRETCH = 500
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # in the file, bytes that do not print stand as characters from 256 up
        prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in prints)}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if t not in self.special}
        self.encoder = tiktoken.Encoding("texts", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special) or any(text[i : i + self.STRETCH].isspace() for i in range(0, len(text) - self.STRETCH + 1, self.STRETCH)):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return array("I", self.encoder.encode_ordinary(text)).tobytes()


#: Its name when it kept words.
WordCache = Encoder


def _rows(batches: Iterator[pa.RecordBatch], path: str, limits: Limits, with_ids: bool) -> Iterator[pa.RecordBatch]:
    encode, packer = Encoder(path), Packer(limits, cut=True)
    first = TaskContext.get().partitionId() << 33
    end, step = np.array([END_ID], dtype="<u4").tobytes(), min(limits.tokens, limits.loss)
    out: list[tuple] = []

    def row(placed):
        ((doc_id, ids), start, length, loss), sequence, offset = placed
        part = ids[4 * start : 4 * (start + length)]
        found = (doc_id, start, length, zlib.crc32(part), len(ids) // 4, first + sequence, offset, loss)
        return (*found, np.frombuffer(part, dtype="<i4")) if with_ids else found

    def batch():
        names = [*FIELDS, "ids"] if with_ids else FIELDS
        types = [pa.int64()] * len(FIELDS) + [pa.list_(pa.int32())] * with_ids
        columns = zip(*out) if out else [()] * len(names)
        made = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=list(names))
        out.clear()
        return made

    for b in batches:
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
            ids = encode(text.as_py()) + end
            n, start = len(ids) // 4, 0
            while n - start >= step:  # fills a sequence by itself
                out.append(row((((doc_id, ids), start, step, step), packer.sequence, 0)))
                packer.sequence += 1
                start += step
            if start < n:
                out.extend(map(row, packer.add((doc_id, ids), start, n - start, n - start)))
            if len(out) >= 10_000:
                yield batch()
    out.extend(map(row, packer.finish()))
    yield batch()


FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits(), with_ids: bool = False
) -> DataFrame:
    """One row per piece; with_ids adds the piece's token ids.

    A document is its token ids and the end id. It is cut where that fills a sequence; every id is in
    exactly one piece. The pieces of a sequence lie one after another from offset 0. In plain text
    every token bears loss. A null or empty text is the end id alone; a null id stays null; repeated
    rows are packed each for itself. An empty table gives an empty result. Columns other than the
    two named are not read. Sequence ids hold the partition's number, so a task that runs again
    after a lost executor makes the same ones.

    Memory per task: the pool of pieces, each with the ids of its document.
    """
    own = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    schema = ", ".join(f"{c} long" for c in FIELDS) + (", ids array<int>" if with_ids else "")
    return own.mapInArrow(lambda it: _rows(it, tokenizer_path, limits, with_ids), schema)


def pack_examples(examples: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Place whole examples (key long, tokens long, loss long), as for instruction data.

    Adds sequence_id and offset. An example is never cut; one beyond a limit has sequence_id null,
    since no sequence can hold it. Null counts are zero.
    """

    def place(batches):
        packer, first = Packer(limits, cut=False), TaskContext.get().partitionId() << 33
        names, rows = ("key", "tokens", "loss", "sequence_id", "offset"), []

        def made():
            arrays = [pa.array(list(c), pa.int64()) for c in (zip(*rows) if rows else [()] * 5)]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names=list(names))

        for b in batches:
            for key, tokens, loss in zip(*(c.to_pylist() for c in b.columns)):
                if tokens > limits.tokens or loss > limits.loss:
                    rows.append((key, tokens, loss, None, None))
                else:
                    rows.extend((p[0], p[2], p[3], first + s, o) for p, s, o in packer.add(key, 0, tokens, loss))
            yield made()
        rows.extend((p[0], p[2], p[3], first + s, o) for p, s, o in packer.finish())
        yield made()

    own = examples.selectExpr("cast(key as long) key", "cast(coalesce(tokens, 0) as long) tokens", "cast(coalesce(loss, 0) as long) loss")
    return own.mapInArrow(place, "key long, tokens long, loss long, sequence_id long, offset long")
