"""Byte-level BPE encoding and decoding with batched numpy merge rounds.

A text is cut into words by the vocabulary's pre-tokenising pattern. The words
of a block that a task has not met yet are encoded together: their byte
symbols lie in one flat array, and each round finds the rank of every adjacent
pair by binary search over the sorted pair keys, takes each word's lowest rank
and merges all its occurrences, from left to right, at once. (A pair made by a
merge ranks after that merge, so merging every occurrence of the lowest pair
is the same as merging one at a time.) Words without a known pair leave the
array. Vocabularies are read from public files and never trained.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from vehicle_metrics.llm.common import add_columns

#: Fixed value: the pre-tokenising pattern of this family of vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""
REMEMBERED = 400_000  # words whose ids a task remembers; beyond that it starts anew


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file,
    mapped to the byte: printable Latin-1 bytes stand for themselves, the
    others take the letters from 256 on in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}


class Vocabulary:
    """Tables of a byte-level BPE file: ids of bytes, sorted pair keys with
    their rank and merged id, the bytes of every id, and special tokens."""

    def __init__(self, data: dict):
        letters, vocab = byte_letters(), data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.of_byte = np.zeros(256, np.int64)
        for c, b in letters.items():
            self.of_byte[b] = vocab.get(c, 0)
        self.size = size
        pairs = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        first = np.concatenate([[True], np.diff(keys[order]) != 0]) if len(keys) else np.zeros(0, bool)
        order = order[first]
        self.keys, self.rank = keys[order], order
        self.merged = merged  # by rank

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word, as little-endian 32-bit arrays."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lens)
        none = len(self.merged)
        done_symbols, done_owner = [], []
        while len(symbols) > 1 and none:
            key = symbols[:-1] * self.size + symbols[1:]
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            rank = np.where((self.keys[at] == key) & (owner[:-1] == owner[1:]), self.rank[at], none)
            rank = np.append(rank, none)
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lowest = np.minimum.reduceat(rank, starts)
            lowest = np.repeat(lowest, np.diff(np.append(starts, len(owner))))
            active = lowest < none
            if not active.all():
                done_symbols.append(symbols[~active])
                done_owner.append(owner[~active])
                symbols, owner, rank, lowest = symbols[active], owner[active], rank[active], lowest[active]
                if not len(symbols):
                    break
            hit = rank == lowest
            # Of overlapping hits (a run of one symbol) every second one merges, counted from the run's start.
            at = np.flatnonzero(hit)
            run = np.concatenate([[True], np.diff(at) != 1])
            nth = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            at = at[nth % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        done_symbols.append(symbols)
        done_owner.append(owner)
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        # A word leaves the array whole and in one round, so a stable sort by word restores the order.
        order = np.argsort(owner, kind="stable")
        counts = np.bincount(owner, minlength=len(words))
        return np.split(symbols[order].astype("<u4"), np.cumsum(counts)[:-1]) if words else []

    def encoder(self, remembered: int = REMEMBERED):
        """A function from texts to the little-endian 32-bit ids of each, as
        bytes. Special tokens in a text become their own id."""
        import regex

        known: dict[str, bytes] = {}
        find = regex.compile(PATTERN).findall
        special = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or "(?!)")
        ids = {s: np.array([i], "<u4").tobytes() for s, i in self.special.items()}

        def encode(texts: list[str]) -> list[bytes]:
            cut: list[list[str]] = []
            plain: list[set[int]] = []
            for text in texts:
                words, marks, at = [], set(), 0
                for m in special.finditer(text):
                    words += find(text[at:m.start()])
                    marks.add(len(words))
                    words.append(m[0])
                    at = m.end()
                words += find(text[at:] if at else text)
                cut.append(words)
                plain.append(marks)
            if len(known) > remembered:
                known.clear()
            new = [w for w in set().union(*cut) if w not in known]
            known.update(zip(new, (a.tobytes() for a in self.encode_words([w.encode() for w in new]))))
            out = []
            for words, marks in zip(cut, plain):
                parts = [known[w] for w in words]
                for i in marks:
                    parts[i] = ids[words[i]]
                out.append(b"".join(parts))
            return out

        return encode

    def decode(self, ids: bytes) -> str:
        """The text of little-endian 32-bit ids; bytes that are not UTF-8
        become U+FFFD."""
        table = self.token_bytes
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def _vocabulary(spark, path: str):
    """The vocabulary file, read once and sent to the tasks (a few MB)."""
    with open(path, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())
    return lambda: Vocabulary(json.loads(shared.value))


def encode(docs: DataFrame, path: str, out: str = "ids", text_col: str = "text") -> DataFrame:
    """Every row with its token ids as little-endian unsigned 32-bit integers
    in a binary column ``out``. NULL and empty texts have no ids."""
    load = _vocabulary(docs.sparkSession, path)

    def compute():
        run = load().encoder()
        return lambda texts: [pa.array(run([t.decode("utf-8", "replace") for t in texts]), pa.binary())]

    return add_columns(docs, text_col, StructType([StructField(out, BinaryType())]), compute)


def decode(rows: DataFrame, path: str, out: str = "decoded", ids_col: str = "ids") -> DataFrame:
    """Every row with the text of its ids in a column ``out`` (NULL ids: empty)."""
    load = _vocabulary(rows.sparkSession, path)

    def compute():
        vocabulary = load()
        return lambda ids: [pa.array([vocabulary.decode(i) for i in ids], pa.string())]

    return add_columns(rows, ids_col, StructType([StructField(out, StringType())]), compute)


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) for every row, encoded and
    decoded in one pass so that ids do not leave the task.

    NULL texts count as empty (no tokens, digests of nothing); repeated rows
    each get a row; a word of any length is encoded whole; other columns are
    not carried.
    """
    load = _vocabulary(docs.sparkSession, path)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"))

    def compute():
        vocabulary = load()
        run = vocabulary.encoder()

        def digests(texts: list[bytes]) -> list[pa.Array]:
            ids = run([t.decode("utf-8", "replace") for t in texts])
            return [pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(vocabulary.decode(i).encode()).hexdigest() for i in ids], pa.string())]

        return digests

    fields = StructType([StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
                         StructField("decoded_sha256", StringType())])
    return add_columns(rows, "body", fields, compute).select(
        F.col("id").alias(id_col), "n_tokens", "ids_sha256", "decoded_sha256")
