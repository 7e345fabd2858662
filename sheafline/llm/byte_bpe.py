"""Byte-level BPE: encoding with the tokenizers library over Arrow batches, and decoding through the byte table.

A text is cut before each single space between two other characters. No match of the pre-tokeniser's pattern crosses such
a cut, so the pieces can be encoded on their own, and a piece met lately in the task is not encoded again. New pieces are
encoded together, as one text; the byte table tells which ids belong to which piece.

Null texts count as empty and give no tokens. Repeated rows give repeated rows. Other columns are left out. Memory beyond
the text itself is bounded: only short pieces are kept, and the older half of them is forgotten when there are too many.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import texts

#: Pieces that a task keeps in each of two generations, and the characters that a piece has at most to be kept.
KEPT_PIECES, LONGEST_KEPT = 120_000, 48
ADJOINING = re.compile(r"\s\s")
CUT = re.compile(r"(?<=\S) (?=\S)")


def vocabulary_path() -> str:
    """The default vocabulary; an operator's parameter replaces it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes are themselves, the rest follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True
    return found


@lru_cache(maxsize=2)
def byte_table(path: str) -> list[bytes]:
    """The bytes of each id."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    of = byte_characters()
    out = [b""] * (max(vocab.values(), default=-1) + 1)
    for token, i in vocab.items():
        out[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
    return out


class Encoder:
    """Encodes texts one by one, keeping the ids (packed 32-bit integers) of the pieces after a space."""

    def __init__(self, path: str, kept: int = KEPT_PIECES):
        self.tokenizer, self.kept = _tokenizer(path), kept
        self.sizes = np.array([len(x) for x in byte_table(path)], np.int64)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _batch(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of distinct pieces, each with the space before it."""
        # a piece that ends in white space would run into the next one's space
        joint = [p for p in pieces if p and not p[-1].isspace()]
        alone = [p for p in pieces if not p or p[-1].isspace()]
        first, *rest = self._batch([" " + " ".join(joint) if joint else "", *(" " + p for p in alone)])
        ends = np.cumsum([len(p.encode()) + 1 for p in joint])
        cuts = (np.searchsorted(np.cumsum(self.sizes[first]), ends) + 1).tolist()
        packed, at, found = first.tobytes(), 0, {}
        for p, end in zip(joint, cuts, strict=True):
            found[p] = packed[4 * at : 4 * end]
            at = end
        found.update((p, x.tobytes()) for p, x in zip(alone, rest, strict=True))
        for p, x in found.items():
            if len(p) <= LONGEST_KEPT:
                self.young[p] = x
        if len(self.young) >= self.kept:
            self.young, self.old = {}, self.young
        return found

    def packed(self, text: str) -> bytes:
        """The ids of a text as packed 32-bit integers."""
        if not text:
            return b""
        first, *pieces = CUT.split(text) if ADJOINING.search(text) else text.split(" ")
        found = list(map(self.young.get, pieces))
        if None in found:
            gone = [k for k, x in enumerate(found) if x is None]
            new = {}
            for k in gone:
                p = pieces[k]
                x = found[k] = self.old.get(p)
                if x is None:
                    new[p] = x
                else:
                    self.young[p] = x
            if new:
                new = self.learn(list(new))
                for k in gone:
                    if found[k] is None:
                        found[k] = new[pieces[k]]
        return b"".join([*(x.tobytes() for x in self._batch([first]) if first), *found])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.uint32).tolist()


def decode(ids: Iterable[int], table: list[bytes]) -> bytes:
    """The bytes of the ids. Ids outside the vocabulary are an error."""
    return b"".join([table[i] for i in ids])


def decode_stream(parts: Iterable[Iterable[int]], table: list[bytes]) -> Iterator[str]:
    """Text of each part; the first bytes of a character that a part ends within are held back for the next one."""
    held = codecs.getincrementaldecoder("utf-8")(errors="replace")
    for ids in parts:
        yield held.decode(decode(ids, table))
    if tail := held.decode(b"", True):
        yield tail


def offsets(ids: list[int], data: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each token in characters: a token's start is that of the character its first byte belongs to,
    its end that after the character of its last byte, so tokens that share a character overlap in it."""
    if not ids:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    ends = np.cumsum(sizes[ids])
    number = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return (number[ends - sizes[ids]] - 1).astype(np.int32), number[ends - 1].astype(np.int32)


def encode_texts(docs: DataFrame, path: str | None = None, with_offsets: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids, decoded (bytes got back from the ids) and, if asked for, starts and ends in characters."""
    path = path or vocabulary_path()

    def run(batches):
        known, table = Encoder(path), byte_table(path)
        sizes = np.array([len(x) for x in table])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [known.encode(t) for t in part.column(1).to_pylist()]
                back = [decode(x, table) for x in ids]
                cols = [part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(back, pa.binary())]
                names = ["doc_id", "ids", "decoded"]
                if with_offsets:
                    both = [offsets(i, b, sizes) for i, b in zip(ids, back, strict=True)]
                    cols += [pa.array([x[k] for x in both], pa.list_(pa.int32())) for k in (0, 1)]
                    names += ["starts", "ends"]
                yield pa.RecordBatch.from_arrays(cols, names)

    more = ", starts array<int>, ends array<int>" if with_offsets else ""
    return texts(docs, doc_id, text).mapInArrow(run, f"doc_id long, ids array<int>, decoded binary{more}")


def decode_ids(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and decoded for a table of doc_id and ids; null ids give no bytes."""
    path = path or vocabulary_path()

    def run(batches):
        table = byte_table(path)
        for batch in batches:
            back = [decode(x or [], table) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(back, pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def encode_digests(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: what the encoding holds, without the ids themselves."""
    path = path or vocabulary_path()

    def run(batches):
        known, table = Encoder(path), byte_table(path)
        names = [str(i) for i in range(len(table))]
        for batch in batches:
            rows = []
            for t in batch.column(1):
                ids = known.encode(t.as_py())
                rows.append((len(ids), hashlib.sha256(" ".join([names[i] for i in ids]).encode()).hexdigest(), hashlib.sha256(decode(ids, table)).hexdigest()))
            cols = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return texts(docs, doc_id, text).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
