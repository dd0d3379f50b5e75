"""Byte-level BPE through a sentencepiece model that is written directly from a rank file.

Every byte stands for one printable character. A token of the rank file becomes a
piece of those characters with its negative rank as score, so that sentencepiece's
merging, which takes the best score first and the leftmost on ties, takes the merges in rank
order. The model normalises nothing and adds nothing. A text is cut into pre-tokens
first; each is encoded by itself, and known ones are looked up. Decoding maps pieces back to
bytes.

Defined cases: a NULL text is encoded as an empty one, to no ids; texts of any length
are taken in parts that end between pre-tokens; equal rows get equal results; an
empty table gives an empty table. Chosen columns pass unchanged beside the results.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pre-tokens remembered per worker before it starts afresh.
REMEMBERED = 300_000

#: A text is cut after about so many characters.
PART = 1_000_000


def _byte_characters() -> list[str]:
    """A printable character for each byte: itself if it has one, else one above 255."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in own else next(spare)) for b in range(256)]


BYTE_CHARACTERS = _byte_characters()
_MAPPED = dict(enumerate(BYTE_CHARACTERS))
_BYTES = {ord(c): chr(b) for b, c in enumerate(BYTE_CHARACTERS)}


def mapped(data: bytes) -> str:
    return data.decode("latin-1").translate(_MAPPED)


def unmapped(piece: str) -> bytes:
    return piece.translate(_BYTES).encode("latin-1")


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, value: bytes | int) -> bytes:
    """A protocol buffer field: bytes, or a number."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _piece(text: str, score: float, kind: int = 1) -> bytes:
    score_field = _varint(2 << 3 | 5) + struct.pack("<f", score)
    return _field(1, _field(1, text.encode()) + score_field + _field(3, kind))


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank, out of lines with a token in base64 and its rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def serialised(tokens: list[bytes]) -> bytes:
    """A sentencepiece model with one piece per token; ids are ranks plus one, 0 is the unknown piece."""
    pieces = [_piece("<unk>", 0.0, kind=2)]
    pieces += [_piece(mapped(token), -float(rank)) for rank, token in enumerate(tokens)]
    trainer = _field(3, 2) + _field(40, 0) + _field(41, 2**64 - 1) + _field(42, 2**64 - 1) + _field(43, 2**64 - 1)
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


class ByteBpe:
    """Encoder and decoder over one rank file and one pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised(tokens))
        self.split = regex.compile(pattern).findall
        self.bytes = [unmapped(self.model.id_to_piece(i + 1)) for i in range(len(tokens))]
        self.numbers = list(range(len(tokens)))
        self.known: dict[str, tuple[int, ...]] = {}

    def _learn(self, pre_tokens: list[str]) -> None:
        if len(self.known) + len(pre_tokens) > REMEMBERED:
            self.known = {}
        numbers = self.numbers
        encoded = self.model.encode([mapped(p.encode()) for p in pre_tokens], out_type=int, num_threads=1)
        for pre_token, ids in zip(pre_tokens, encoded, strict=True):
            self.known[pre_token] = tuple([numbers[i - 1] for i in ids])

    def encode(self, text: str) -> list[int]:
        """Ranks of the tokens of a whole text."""
        ids: list[int] = []
        for part in parts(text):
            pre_tokens = self.split(part)
            found = set(pre_tokens)
            new = [p for p in found if p not in self.known]
            if new:
                self._learn(new)
                if any(p not in self.known for p in found):
                    self._learn([p for p in found if p not in self.known])
            ids.extend(chain.from_iterable(map(self.known.__getitem__, pre_tokens)))
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


def parts(text: str, size: int = PART) -> Iterator[str]:
    """A text in parts; each but the first starts with the first space after a word, where a pre-token starts."""
    start = 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while at > 0 and text[at - 1].isspace():
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:] if start else text


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, and ``ids`` of each whole text with ``decoded``, the bytes the ids stand for.

    One pass without a shuffle. A worker loads the rank file once.
    """
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_bpe_text"))
    kept = [rows.schema[c] for c in keep]
    schema = T.StructType(
        [*kept, T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.BinaryType())]
    )

    def encode(batches):
        bpe = load(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                ids, decoded = [], []
                for whole in part.column(len(keep)):
                    found = bpe.encode(whole.as_py())
                    ids.append(pa.array(found, pa.int32()))
                    decoded.append(bpe.decode(found))
                offsets = pa.array(_offsets(ids), pa.int32())
                values = pa.concat_arrays(ids)
                columns = [*part.columns[:-1], pa.ListArray.from_arrays(offsets, values), pa.array(decoded, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "ids", "decoded"])

    return rows.mapInArrow(encode, schema)


def _offsets(arrays: list[pa.Array]) -> list[int]:
    out = [0]
    for array in arrays:
        out.append(out[-1] + len(array))
    return out


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document."""
    rows = round_trip(docs, path, pattern, text, (doc_id,))
    return rows.select(
        F.col(doc_id).alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
