"""Token counts of whole texts by a public tokenizer, in Arrow functions that return lengths only.

The tokenizer's file is read once on the driver and broadcast (some megabytes, whatever the
corpus); each Python worker builds the tokenizer once. A task takes its rows in batches of about
``batch_bytes`` bytes of text, not of so many rows, so long texts make small batches. Token ids
never leave the library's call.

The texts of a batch are cut into pieces where the tokenizer itself would begin a new word
whatever comes before, so that the counts of the pieces add up to that of the text: see
``Cut``. A text of any length is thus encoded bit by bit, and equal pieces of a batch only
once; a worker remembers the counts of ``REMEMBERED`` short pieces for its next batches. A text
without such a place is one piece. Counting needs no shuffle.

``.json`` files are read by tokenizers, ``.model`` files by sentencepiece. No begin, end or other
special tokens are added; special strings inside a text are handled as the library does by
default; nothing is truncated or padded. A tokenizer for which no place is known to be safe gets
whole texts.

Cases: null and empty texts have 0 bytes and 0 tokens; rows are counted one by one, so repeated
rows and repeated or null doc_ids each give a row; an empty table gives an empty result. Extra
columns are not looked at.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import byte_class, chunks, text_bytes

#: Pieces whose counts a Python worker keeps, and the longest that it keeps, in bytes.
REMEMBERED = 1 << 18
SHORT = 64
#: Pieces handed to the library in one call, which holds an object for each.
CALL = 1 << 13

BLANK = byte_class(lambda b: b in (0x20, 0x09, 0x0A))
SPACE = byte_class(lambda b: b == 0x20)
VISIBLE = byte_class(lambda b: 0x21 <= b <= 0x7E)
LETTER = byte_class(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)
#: First bytes of two-byte characters, but for the one that some blanks share.
TWO = byte_class(lambda b: 0xC3 <= b <= 0xDF)
REST = byte_class(lambda b: 0x80 <= b <= 0xBF)


@dataclass(frozen=True)
class Cut:
    """Where texts may be cut: at the places of ``at``, and whether the byte there goes."""

    at: Callable[[np.ndarray], np.ndarray]
    drops: bool


def _before_blanks(raw: np.ndarray) -> np.ndarray:
    """An ASCII blank after something visible: a word ends there, whatever is on either side, since
    blanks are only ever taken together with blanks or with the word behind them."""
    out = np.zeros(len(raw), dtype=bool)
    if len(raw) > 1:
        out[1:] = BLANK[raw[1:]] & VISIBLE[raw[:-1]]
        out[2:] |= BLANK[raw[2:]] & REST[raw[1:-1]] & TWO[raw[:-2]]
    return out


def _between_letters(raw: np.ndarray) -> np.ndarray:
    """The blank between two ASCII letters."""
    out = np.zeros(len(raw), dtype=bool)
    if len(raw) > 2:
        out[1:-1] = SPACE[raw[1:-1]] & LETTER[raw[:-2]] & LETTER[raw[2:]]
    return out


#: For byte-level tokenizers: the blank belongs to what follows.
BYTE_LEVEL = Cut(_before_blanks, False)
#: For tokenizers that mark the blank before a word themselves: it goes, and the next piece gets the mark.
MARKED = Cut(_between_letters, True)


class Tokenizer:
    """A tokenizer from the contents of its file: counts of texts, and where they can be cut."""

    def __init__(self, name: str, content: bytes):
        self.remembered: dict[str, int] = {}
        if name.endswith(".json"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism

            import tokenizers

            library = tokenizers.Tokenizer.from_buffer(content)
            library.no_truncation()
            library.no_padding()
            encode = getattr(library, "encode_batch_fast", library.encode_batch)
            self.encoded = lambda texts: [len(x) for x in encode(texts, add_special_tokens=False)]
            self.cut = BYTE_LEVEL if _byte_level(json.loads(content)) else None
        elif name.endswith(".model"):
            import sentencepiece

            library = sentencepiece.SentencePieceProcessor(model_proto=content)
            self.encoded = lambda texts: [len(x) for x in library.encode(texts, num_threads=1)]
            self.cut = MARKED if _marks_each_word(library) else None
        else:
            raise ValueError(f"not a .json or .model file: {name!r}")

    def pieces(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Pieces of texts (bytes, and where each begins and ends) and the number of each's text."""
        full = np.flatnonzero(offsets[1:] > offsets[:-1])
        begins = offsets[full]
        keep = np.ones(len(raw), dtype=bool)
        if self.cut is not None:
            at = self.cut.at(raw)
            at[begins] = False
            at[offsets[full + 1] - 1] &= not self.cut.drops  # a last byte has nothing behind it
            if self.cut.drops:
                keep = ~at
            begins = np.union1d(begins, np.flatnonzero(at) + self.cut.drops)
        row = np.searchsorted(offsets, begins, "right") - 1
        place = np.concatenate([[0], np.cumsum(keep)])
        edges = np.append(place[begins], place[-1])
        buffers = [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(raw[keep] if self.cut and self.cut.drops else raw)]
        return pa.Array.from_buffers(pa.large_string(), len(begins), buffers), row

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each piece; short ones that came before are remembered."""
        if len(self.remembered) > REMEMBERED:
            self.remembered.clear()
        known = [self.remembered.get(t) for t in texts]
        new = [i for i, n in enumerate(known) if n is None]
        for a in range(0, len(new), CALL):
            some = new[a : a + CALL]
            for i, n in zip(some, self.encoded([texts[i] for i in some])):
                known[i] = n
                if len(texts[i]) <= SHORT:
                    self.remembered[texts[i]] = n
        return known

    def count_texts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each of some texts."""
        pieces, row = self.pieces(raw, offsets)
        out = np.zeros(len(offsets) - 1, dtype=np.int64)
        if len(pieces):
            coded = pieces.dictionary_encode()
            n = np.array(self.count(coded.dictionary.to_pylist()), dtype=np.int64)
            np.add.at(out, row, n[coded.indices.to_numpy(zero_copy_only=False)])
        return out


def _byte_level(config: dict) -> bool:
    """Whether a text may be cut before a blank: bytes as they are, split by the usual pattern,
    and special strings without blanks that take none with them."""
    split = config.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    special = all(
        not re.search(r"\s", t["content"]) and not t["lstrip"] and not t["rstrip"] and not t["single_word"]
        for t in config.get("added_tokens", [])
    )
    return bool(plain and special and config.get("normalizer") is None)


def _marks_each_word(library) -> bool:
    """Whether every word begins with the mark and no piece goes on over it."""
    mark = "▁"
    crossing = any(mark in library.id_to_piece(i).lstrip(mark) for i in range(library.get_piece_size()))
    a, b = library.encode("ab cd", out_type=str), library.encode("ab", out_type=str) + library.encode("cd", out_type=str)
    return not crossing and a == b


_built: dict[tuple[str, int], Tokenizer] = {}


def _tokenizer(name: str, content: bytes) -> Tokenizer:
    """One tokenizer per Python worker and file."""
    key = (name, hash(content))
    if key not in _built:
        _built[key] = Tokenizer(name, content)
    return _built[key]


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, batch_bytes: int = 1 << 20) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs`` (doc_id, text), by the
    tokenizer in the file at ``path`` on the driver."""
    with open(path, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    name = os.path.basename(path)

    def run(batches):
        tokenizer = _tokenizer(name, content.value)
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            for a, b in chunks(offsets, batch_bytes):
                at = offsets[a : b + 1] - offsets[a]
                n = tokenizer.count_texts(raw[offsets[a] : offsets[b]], at)
                yield pa.record_batch(
                    [batch.column("doc_id").slice(a, b - a), pa.array(np.diff(at), pa.int64()), pa.array(n, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    got = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return got.withColumn("over_limit", F.col("n_tokens") > limit)
