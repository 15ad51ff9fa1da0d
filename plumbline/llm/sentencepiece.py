"""SentencePiece encoding by Viterbi over an Aho-Corasick automaton, and decoding.

All pieces of a model are in one automaton. A text is read once; at each position the automaton's
output links give the pieces that end there, and each relaxes the best score of a path to that
position. A character no piece covers is spelled in byte pieces at a fixed penalty. The path with the
largest sum of scores is the encoding.

No piece has a space mark after another character (checked when the model is loaded), so the best path
of a text is that of its words one after another, and a word met again is taken from a cache.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plumbline.llm.shared import text_of

MARK = "▁"
PENALTY = 10.0


class Model:
    """A SentencePiece model file with byte pieces. cache: words remembered at most."""

    def __init__(self, path: str, cache: int = 300_000):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size, self.limit = sp.get_piece_size(), cache
        self.bytes_at, self.text_of = {}, []
        self.automaton = ahocorasick.Automaton()
        scores, self.splits = [], True
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(piece[3:5], 16)
                self.bytes_at[b] = i
                self.text_of.append(chr(b) if b < 128 else None)
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.text_of.append("")
            else:
                self.text_of.append(piece.replace(MARK, " "))
                self.automaton.add_word(piece, (len(piece), sp.get_score(i), i))
                scores.append(sp.get_score(i))
                self.splits &= MARK not in piece.lstrip(MARK)
        self.automaton.make_automaton()
        self.unknown = min(scores) - PENALTY
        self.raw = {i: b for b, i in self.bytes_at.items()}
        self.known: dict[str, tuple[bytes, float]] = {}
        self.words = re.compile(f"{MARK}+[^{MARK}]*" if self.splits else "(?s).+")

    def best_path(self, marked: str) -> tuple[bytes, float]:
        """Ids, as bytes of 32-bit numbers, and score of one marked text."""
        n = len(marked)
        best, back, at, unknown = [0.0] * (n + 1), [None] * (n + 1), 0, self.unknown
        for last, (length, score, piece) in self.automaton.iter(marked):
            end = last + 1
            while at < end:
                best[at + 1] = best[at] + unknown
                at += 1
            found = best[end - length] + score
            if found > best[end]:
                best[end], back[end] = found, (length, piece)
        while at < n:
            best[at + 1] = best[at] + unknown
            at += 1
        ids, at = [], n
        while at:
            if back[at] is None:
                at -= 1
                ids.extend(self.bytes_at[b] for b in reversed(marked[at].encode("utf-8", "replace")))
            else:
                length, piece = back[at]
                ids.append(piece)
                at -= length
        return np.array(ids[::-1], dtype="<i4").tobytes(), best[n]

    def _word(self, marked: str) -> tuple[bytes, float]:
        found = self.known.get(marked)
        if found is None:
            if len(self.known) >= self.limit:
                self.known.clear()
            found = self.known[marked] = self.best_path(marked)
        return found

    def encode(self, text: str) -> tuple[bytes, float]:
        if not text:
            return b"", 0.0
        marked = MARK + text.replace(" ", MARK)
        parts = [self._word(w) for w in self.words.findall(marked)]
        return b"".join([p for p, _ in parts]), sum(s for _, s in parts)

    def decode(self, ids: list[int]) -> str:
        try:
            text = "".join([self.text_of[i] for i in ids])
        except TypeError:  # byte pieces beyond ASCII: gather them into characters
            raw = b"".join(bytes([self.raw[i]]) if i in self.raw else self.text_of[i].encode() for i in ids)
            text = raw.decode("utf-8", "replace")
        return text.removeprefix(" ")


@functools.lru_cache(maxsize=2)
def model(path: str) -> Model:
    return Model(path)


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids, n_ids, score, round_trip.

    round_trip says whether decoding the ids gives the text back. It does unless the text holds the
    model's space mark, which decodes to a space. A null or empty text has no ids and score 0. Ids of
    rows are passed on, null or repeated. An empty table gives an empty result. Columns other than
    the two named are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_path)
        for whole in batches:
            for b in (whole.slice(i, 512) for i in range(0, whole.num_rows, 512)):  # bounds the ids held at once
                texts = b.column(1).to_pylist()
                found = [m.encode(t) for t in texts]
                sizes = np.array([len(p) // 4 for p, _ in found], dtype=np.int64)
                ids = np.frombuffer(b"".join([p for p, _ in found]), dtype="<i4")
                offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
                same = [m.decode(ids[a:z].tolist()) == t for a, z, t in zip(offsets, offsets[1:], texts)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)), pa.array(sizes), pa.array([float(s) for _, s in found], pa.float64()), pa.array(same, pa.bool_())],
                    names=["doc_id", "ids", "n_ids", "score", "round_trip"],
                )

    own = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return own.mapInArrow(run, "doc_id long, ids array<int>, n_ids long, score double, round_trip boolean")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids are none, and none give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_path)
        for b in batches:
            texts = [m.decode(ids or []) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.selectExpr("cast(doc_id as long) doc_id", "ids").mapInArrow(run, "doc_id long, text string")
