"""Token counts by the whole-token shortcut.

Byte-pair merging works on each pre-token alone, and most pre-tokens of running text come out as one token.
Which vocabulary strings do so is proved beforehand by encoding every one of them; a pre-token among them counts
one without merging. Only the others are merged, each once as long as the cache holds it.

The same proof lets them be merged by the ranks of the merged strings alone, which is faster than by pairs. Say
two neighbours make up t, and no merge below t's rank is left. Nothing was merged across the ends of t, so inside
it the same was merged as in t alone. If t alone comes out as one token, the neighbours are the pair that makes t.
Strings that do not come out alone are left out of the ranks: no text makes them.

Pre-tokens are cut by the tokenizer's published pattern. It depends on the class of each character only (letter,
number, white space or other), so a character on which this pattern and the tokenizer cut the same probes is proved
once; a text that holds a character on which they differ, or one of the tokenizer's special strings, goes to the
tokenizer whole. No pre-token goes from a character into white space after it, so a text is first divided there:
the piece " the" is a pre-token as it stands, and only other pieces (" word,", say) are cut by the pattern.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.shared import text_of

#: Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Around a character, so that its class shows in where the pattern cuts.
PROBES = ("a{0}b", "1{0}2", "!{0}?", " {0} ", "{0}{0}'s", "'{0}  a")


#: White space, then other characters; and the white space this does not count as such.
PIECE = r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+"
WIDER_SPACES = frozenset(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \t\n\x0b\x0c\r")


class TokenCounter(dict):
    """Numbers of tokens of texts, as the tokenizer of a byte-level .json file gives them; as a dictionary, those of
    the pieces of texts met so far."""

    #: Pieces kept at most.
    CACHE = 800_000
    #: Characters of a piece kept at most.
    LONGEST = 64
    #: Characters of a text that are cut into pre-tokens at once, about.
    PART = 1 << 20

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import re

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        made = json.loads(self.tokenizer.to_str())
        shape = made["pre_tokenizer"] or {}
        if shape.get("type") != "ByteLevel" or not shape.get("use_regex") or shape.get("add_prefix_space") or made["normalizer"]:
            raise ValueError(f"{path}: not a byte-level tokenizer that takes texts as they are")
        self.cut, self.pieces = regex.compile(PATTERN).findall, re.compile(PIECE).findall
        self.border = re.compile("(?<=[A-Za-z,.]) (?=[A-Za-z])").search
        self.spans = lambda text: [m.span() for m in regex.finditer(PATTERN, text)]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole, self.encoder = self.proved(made["model"])
        self.update(dict.fromkeys(self.whole, 1))
        self.agreed: set[str] = set()
        self.odd: set[str] = set()
        self.unproved(set(map(chr, range(128))))

    def proved(self, model: dict) -> tuple[frozenset[str], object]:
        """The texts that encode alone as one token; the merging by the ranks of the strings proved."""
        import tiktoken

        # in the file, bytes that do not print stand as characters from 256 up
        prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in prints)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        alone = self.tokenizer.model.tokenize
        ranks = {t: i for i, t in enumerate(byte_of)} | {a + b: 256 + i for i, (a, b) in enumerate(merges) if len(alone(a + b)) == 1}
        strings = {bytes(map(byte_of.get, t)): i for t, i in ranks.items()}
        texts = [t.decode("utf-8", "replace") for t in strings]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        whole = frozenset(t for t, s, e in zip(texts, strings, found) if len(e.ids) == 1 and t.encode() == s)
        return whole, tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=strings, special_tokens={})

    def unproved(self, chars: set[str]) -> bool:
        """Whether there is a character among these that the tokenizer cuts otherwise."""
        for c in chars - self.agreed - self.odd:
            probes = [p.format(c) for p in PROBES]
            same = all([s for _, s in self.tokenizer.pre_tokenizer.pre_tokenize_str(p)] == self.spans(p) for p in probes)
            same = same and c.isalpha() == (len(self.cut(f"a{c}")) == 1)
            (self.agreed if same else self.odd).add(c)
        return not self.odd.isdisjoint(chars)

    def parts(self, text: str) -> Iterator[str]:
        """The text in parts that end before white space."""
        start = 0
        while len(text) - start > self.PART and (at := self.border(text, start + self.PART)):
            yield text[start : at.start()]
            start = at.start()
        yield text[start:]

    def alone(self, text: str) -> int:
        """By the tokenizer itself."""
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, piece: str) -> int:
        found = [piece] if piece[0] == " " and piece[1:].isalpha() else self.cut(piece)
        n = len(self.encoder._encode_single_piece(piece)) if len(found) == 1 else sum(map(self.__getitem__, found))
        if len(self) >= self.CACHE:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        if len(piece) <= self.LONGEST:
            self[piece] = n
        return n

    def __call__(self, text: str) -> int:
        chars = set(text)
        if any(s in text for s in self.special) or self.unproved(chars):
            return self.alone(text)
        cut = self.pieces if WIDER_SPACES.isdisjoint(chars) else self.cut
        return sum(sum(map(self.__getitem__, cut(part))) for part in self.parts(text))


@lru_cache(maxsize=1)
def counter(path: str) -> TokenCounter:
    """One per Python worker."""
    return TokenCounter(path)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes (of the text in UTF-8), n_tokens, over_limit (n_tokens > limit).

    No begin, end or other special tokens are added; a special string inside a text is what the tokenizer makes of
    it, one token. A null text is empty: 0 bytes, 0 tokens. A null id stays null; repeated rows are counted each for
    itself. An empty table gives an empty result. Columns other than the two named are not read. Nothing is
    shuffled; a task holds one batch of texts and the cache of merged pre-tokens.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_path)
        for b in batches:
            n = pa.array([count(t.as_py()) for t in b.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), n], names=["doc_id", "n_bytes", "n_tokens"])

    text = text_of(text_col)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return own.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
