"""Token ids in shards compressed by Re-Pair grammars, with random access to documents.

Texts are encoded with a tokenizer of the tokenizers library and put in ascending order of
ids. A shard is the ids of consecutive documents, each closed by an end id. Pairs of
ids that are frequent in a shard are replaced by new symbols, round after round; a rule
says which two symbols a new one stands for. The file of a shard stores rules, the
length each rule expands to, the remaining symbols and where in them each document
begins. No rule crosses the end of a document, so one document is decoded from its own symbols alone.
Rounds end when no pair is frequent any more or all 2^16 symbols are in use.

Files are written by Spark, a row per shard, in a folder all executors share; the order of
rows is by ``part`` and ``shard``. Starts of documents are added up from shards and
parts, never over all documents in one task.

Defined cases: a NULL text is an empty one, its ids are the end id alone; NULL ids
come last; rows of one id are ordered by text, equal rows give equal ids; a document longer
than a shard is a shard; an empty table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections import defaultdict
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedloom.llm.byte_bpe import mapped
from feedloom.plans.staging import fresh_path

SHARD_TOKENS = 1 << 20
#: Words and pieces of words that a worker remembers before it starts afresh.
REMEMBERED = 1_000_000
_MAGIC = b"RPG1"

# --- grammar ---------------------------------------------------------------------------


def compress(ids: np.ndarray, first: int, end: int, rounds: int = 5, least: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and rules of a sequence of 16-bit ids.

    Symbols from ``first`` on are rules, at most 2^16 symbols in all. Each round counts all
    pairs without the end id and replaces the most frequent ones, from left to right. Rounds go on until no pair
    occurs ``least`` times, the number from which a rule saves more bytes than it takes, or all symbols are
    in use; that is not before so many ``rounds``, each of which may take its share of those left.
    """
    seq, rules = ids.astype(np.uint16), []
    known, room, left = first, (1 << 16) - first, rounds
    while len(seq) > 1 and room > 0:
        pairs = seq[:-1].astype(np.uint32) << np.uint32(16) | seq[1:]
        inner = seq != end
        pairs_at = inner[:-1] & inner[1:]
        ordered = np.sort(pairs[pairs_at])
        if not len(ordered):
            break
        bounds = np.flatnonzero(ordered[1:] != ordered[:-1]) + 1
        bounds = np.concatenate([[0], bounds, [len(ordered)]])
        counts = np.diff(bounds)
        often = np.flatnonzero(counts >= least)
        if not len(often):
            break
        often = often[np.argsort(-counts[often], kind="stable")]
        chosen = ordered[bounds[often]]
        # A slot for each pair; of two pairs in one slot the less frequent one waits for a later round.
        _, own = np.unique(_slot(chosen), return_index=True)
        chosen = chosen[np.sort(own)][: -(-room // left)]
        left = max(left - 1, 1)
        # Free slots hold a pair that is never looked for.
        table, symbol = np.full(1 << 18, end << 16 | end, np.uint32), np.zeros(1 << 18, np.uint16)
        slots = _slot(chosen)
        table[slots], symbol[slots] = chosen, np.arange(known, known + len(chosen)).astype(np.uint16)
        at = _slot(pairs)
        hits = np.flatnonzero((table[at] == pairs) & pairs_at)
        # Of pairs that overlap every second one is taken.
        fresh = np.flatnonzero(np.diff(hits, prepend=-2) != 1)
        hits = hits[(np.arange(len(hits)) - np.repeat(fresh, np.diff(fresh, append=len(hits)))) % 2 == 0]
        stays = np.ones(len(seq), bool)
        stays[hits + 1] = False
        seq = seq.copy()
        seq[hits] = symbol[at[hits]]
        seq = seq[stays]
        rules.append(np.stack([chosen >> np.uint32(16), chosen & np.uint32(0xFFFF)], axis=1).astype(np.uint16))
        known += len(chosen)
        room -= len(chosen)
    return seq, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint16)


def _slot(pairs: np.ndarray) -> np.ndarray:
    return (pairs * np.uint32(2654435761)) >> np.uint32(14)


class Grammar:
    """Rules with the text each symbol expands to."""

    def __init__(self, rules: np.ndarray, first: int):
        self.length = np.ones(first + len(rules), np.int64)
        self.begin = np.zeros(first + len(rules), np.int64)
        self.begin[:first] = np.arange(first)
        self.flat = np.arange(first, dtype=np.uint16)
        done = 0
        highest = np.maximum.accumulate(rules.max(1)) if len(rules) else rules
        while done < len(rules):
            # All rules over symbols known so far at once.
            stop = int(np.searchsorted(highest, first + done))
            part = self.expand(rules[done:stop].ravel())
            lengths = self.length[rules[done:stop].astype(np.int64)].sum(1)
            self.length[first + done : first + stop] = lengths
            self.begin[first + done : first + stop] = len(self.flat) + np.cumsum(lengths) - lengths
            self.flat = np.concatenate([self.flat, part])
            done = stop

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        lengths = self.length[symbols]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.begin[symbols] - (ends - lengths), lengths) + np.arange(total)]


def pack(doc_ids: list[int | None], ids: np.ndarray, ends: np.ndarray, first: int, end: int) -> bytes:
    """The file of a shard: ``ends`` says where in ``ids`` each document ends."""
    seq, rules = compress(ids, first, end)
    grammar_lengths = Grammar(rules, first).length
    # Where a document ends, a symbol ends as well.
    symbol_ends = np.searchsorted(np.cumsum(grammar_lengths[seq]), ends) + 1
    return b"".join(
        [
            _MAGIC,
            struct.pack("<5q", len(doc_ids), len(rules), len(seq), first, len(ids)),
            np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], np.uint8).tobytes(),
            ends.astype("<i8").tobytes(),
            symbol_ends.astype("<i8").tobytes(),
            rules.astype("<u2").tobytes(),
            grammar_lengths[first:].astype("<u4").tobytes(),
            seq.astype("<u2").tobytes(),
        ]
    )


class Shard:
    """The file of a shard, opened."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a shard of ids")
        docs, rules, symbols, self.first, self.n_tokens = struct.unpack_from("<5q", data, 4)
        at = 44

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, n, at)
            at += found.nbytes
            return found

        ids, missing = take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if none else int(d) for d, none in zip(ids, missing, strict=True)]
        self.ends, self.symbol_ends = take("<i8", docs), take("<i8", docs)
        self.rules = take("<u2", 2 * rules).reshape(-1, 2)
        self.lengths = take("<u4", rules)
        self.symbols = take("<u2", symbols)
        self.grammar = Grammar(self.rules, self.first)

    def decode(self) -> np.ndarray:
        """All ids of the shard."""
        return self.grammar.expand(self.symbols)

    def document(self, i: int) -> np.ndarray:
        """The ids of one document, out of its own symbols."""
        begin = int(self.symbol_ends[i - 1]) if i else 0
        return self.grammar.expand(self.symbols[begin : int(self.symbol_ends[i])])


# --- encoding --------------------------------------------------------------------------

#: Characters whose classes and lower case are the same in every library: printable ASCII, and Latin letters
#: and signs whose lower case is among them as well.
_SIMPLE = re.compile("[!-~\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ſ]+")
_L = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
#: How the tokenizer's own file cuts a lower-case word of such characters.
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[0-9]|[^{_L}0-9]+")
#: Words of letters alone, but for the one letter whose lower case is two characters.
_LETTERS = re.compile(f"(?:(?!\u0130)[{_L}])+")
_STOPS = frozenset(b".,;:!?")
#: The rules in a tokenizer's own file that the expressions above repeat.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_SPLIT = {
    "type": "Split",
    "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def _by_words(tokenizer: Tokenizer) -> bool:
    """Whether a tokenizer cuts texts as is repeated here."""
    own = json.loads(tokenizer.to_str())
    cut = {"type": "Sequence", "pretokenizers": [_SPLIT, _BYTES]}
    special = all(token["content"].startswith("<|") for token in own["added_tokens"])
    return own["normalizer"] == _NORMALIZER and own["pre_tokenizer"] == cut and special


class WordEncoder:
    """A tokenizer that drops white space, applied word by word.

    No token of it reaches over white space, so each word is encoded once and looked
    up afterwards. Words of simple characters are cut here and given to the tokenizer's
    model; any other word goes through the whole tokenizer. So do whole texts if the tokenizer
    cuts by other rules than those repeated here. A vocabulary that leaves 16 bits no symbol is an error.
    """

    def __init__(self, path: str, end: int):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.end = end
        if self.tokenizer.get_vocab_size() >= 1 << 16:
            raise ValueError("shards hold symbols of 16 bits; the vocabulary fills them")
        self.by_words = _by_words(self.tokenizer)
        self.numbers = list(range(self.tokenizer.get_vocab_size()))
        self._forget()

    def _forget(self) -> None:
        # White space is no word, so it can stand for the end of a document. A word that is looked up gets the next number.
        self.known: defaultdict[bytes, int] = defaultdict(count(1).__next__, {b"\n": 0})
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.plain: dict[bytes, tuple[int, ...]] = {}
        self.flat = np.array([self.end], np.uint16)
        self.begin, self.length = np.zeros(1, np.int64), np.ones(1, np.int64)

    def _piece(self, piece: str) -> tuple[int, ...]:
        found = self.pieces.get(piece)
        if found is None:
            # Printable ASCII stands for itself.
            shown = piece if piece.isascii() else mapped(piece.encode())
            found = tuple([self.numbers[t.id] for t in self.model.tokenize(shown)])
            self.pieces[piece] = found
        return found

    def _learn(self, words: list[bytes]) -> None:
        encoded: list = [None] * len(words)
        other = []
        plain, stops = self.plain, {b: self._piece(chr(b)) for b in _STOPS}
        numbers, tokenize = self.numbers, self.model.tokenize
        for i, word in enumerate(words):
            stop = stops.get(word[-1], ())
            letters = word[:-1] if stop else word
            if letters.isalpha():  # ASCII letters only
                letters = letters.lower()
                found = plain.get(letters)
                if found is None:
                    found = plain[letters] = tuple([numbers[t.id] for t in tokenize(letters.decode())])
                encoded[i] = found + stop if stop else found
                continue
            text = word.decode()
            if _LETTERS.fullmatch(text):
                text = text.lower()
                encoded[i] = self.pieces.get(text) or self._piece(text)
            elif "<|" not in text and _SIMPLE.fullmatch(text):
                encoded[i] = tuple(chain.from_iterable(map(self._piece, _PIECES.findall(text.lower()))))
            else:
                other.append(i)
        if other:
            texts = [words[i].decode() for i in other]
            for i, found in zip(other, self.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
                encoded[i] = found.ids
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        at = len(self.flat) + np.cumsum(lengths) - lengths
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(encoded), np.uint16, int(lengths.sum()))])
        self.begin, self.length = np.concatenate([self.begin, at]), np.concatenate([self.length, lengths])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with its end id, and where each text ends."""
        return self.encode_utf8([text.encode() for text in texts])

    def encode_utf8(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts given in UTF-8."""
        if not self.by_words:
            found = self.tokenizer.encode_batch([text.decode() for text in texts], add_special_tokens=False)
            whole = [np.array([*one.ids, self.end], np.uint16) for one in found]
            return np.concatenate(whole), np.cumsum([len(one) for one in whole])
        if len(self.known) > REMEMBERED:
            self._forget()
        words: list[bytes] = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            words += text.split()
            words.append(b"\n")
            counts[i] = len(words)
        before = len(self.known)
        index = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        new = len(self.known) - before
        if new:
            try:
                self._learn(list(islice(reversed(self.known), new))[::-1])
            except BaseException:
                # A worker that goes on must not keep numbers without ids.
                self._forget()
                raise
        lengths = self.length[index]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        # Half as wide while places fit, which takes half the time.
        kind = np.int32 if len(self.flat) + total < 1 << 31 else np.int64
        shift = (self.begin[index] - (ends - lengths)).astype(kind)
        ids = self.flat[np.repeat(shift, lengths) + np.arange(total, dtype=kind)]
        return ids, ends[counts - 1]


@lru_cache(maxsize=2)
def load(path: str, end: int) -> WordEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path, end)


# --- files -----------------------------------------------------------------------------


def write(docs: DataFrame, tokenizer: str, end: int = 1, doc_id: str = "doc_id", text: str = "text") -> str:
    """Write the shards of all documents in ascending order of ids; the folder they are in."""
    path = fresh_path(docs.sparkSession, "staged/ids")
    in_order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.repartitionByRange(*in_order).sortWithinPartitions(*in_order, "text")

    def shards(batches):
        encoder, part, n = load(tokenizer, end), TaskContext.get().partitionId(), 0
        first = encoder.tokenizer.get_vocab_size()
        doc_ids, ids, ends, size = [], [], [], 0

        def row():
            data = pack(doc_ids, np.concatenate(ids), np.concatenate(ends), first, end)
            columns = [pa.array([part], pa.int32()), pa.array([n], pa.int32()), pa.array([size]), pa.array([data], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["part", "shard", "n_tokens", "data"])

        for batch in batches:
            for start in range(0, batch.num_rows, 400):
                some = batch.slice(start, 400)
                found, found_ends = encoder.encode_utf8(some.column(1).cast(pa.binary()).to_pylist())
                doc_ids += some.column(0).to_pylist()
                ids.append(found)
                ends.append(found_ends + size)
                size += len(found)
                if size >= SHARD_TOKENS:
                    yield row()
                    doc_ids, ids, ends, size, n = [], [], [], 0, n + 1
        if size:
            yield row()

    rows.mapInArrow(shards, "part int, shard int, n_tokens long, data binary").write.parquet(path)
    return path


def read(spark, path: str) -> DataFrame:
    """``part, shard, doc_id, at, ids``: every document of the shards, ``at`` its place within its shard."""

    def documents(batches):
        for batch in batches:
            for part, shard, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                opened = Shard(data)
                n = len(opened.doc_ids)
                offsets = pa.array(np.concatenate([[0], opened.ends]), pa.int32())
                ids = pa.ListArray.from_arrays(offsets, pa.array(opened.decode().astype(np.int32)))
                starts = pa.array(np.concatenate([[0], opened.ends[:-1]]).astype(np.int64))
                columns = [pa.array([part] * n, pa.int32()), pa.array([shard] * n, pa.int32())]
                columns += [pa.array(opened.doc_ids, pa.int64()), starts, ids]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "shard", "doc_id", "at", "ids"])

    stored = spark.read.parquet(path).select("part", "shard", "data")
    return stored.mapInArrow(documents, "part int, shard int, doc_id long, at long, ids array<int>")


def checked(spark, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, out of the files in a folder."""
    sizes = spark.read.parquet(path).select("part", "shard", "n_tokens")
    before_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("words"))
    parts = parts.select("part", F.coalesce(F.sum("words").over(before_part), F.lit(0)).alias("before"))
    before_shard = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.join(parts, "part").select(
        "part", "shard", (F.col("before") + F.coalesce(F.sum("n_tokens").over(before_shard), F.lit(0))).alias("begin")
    )

    def digest(batches):
        for batch in batches:
            for part, shard, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                opened = Shard(data)
                ids = opened.decode().astype("<u4")
                starts = [0, *opened.ends.tolist()]
                crcs = [zlib.crc32(ids[i:j]) for i, j in zip(starts, starts[1:], strict=False)]
                n = len(crcs)
                columns = [pa.array([part] * n, pa.int32()), pa.array([shard] * n, pa.int32())]
                columns += [pa.array(opened.doc_ids, pa.int64()), pa.array(starts[:-1], pa.int64())]
                columns += [pa.array(np.diff(starts), pa.int64()), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    stored = spark.read.parquet(path).select("part", "shard", "data")
    found = stored.mapInArrow(digest, "part int, shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(begins, ["part", "shard"]).select(
        "doc_id", (F.col("begin") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
