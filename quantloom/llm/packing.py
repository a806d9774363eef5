"""Best-fit packing of tokenised documents into sequences of fixed length.

Bounded-space online best-fit: at most ``open_bins`` sequences are open in a
partition, and there are no more partitions than every ``SEQUENCES`` full sequences need.  They sit in buckets by free space, and a bitset has a bit for every
free space that some open sequence has; the best fit is the lowest bit at or above
the piece's length.  When a new sequence is needed and all are open, the fullest
one closes.  Pieces arrive in hashed order, in runs of ``RUN_PIECES`` that are
longest first: a run opens no more sequences than can stay open, and each run brings
short pieces for the gaps of the long ones, however many pieces a partition has.

Defined cases: a null text is empty and gives the end token alone; a null ``doc_id`` is
packed like another; a text longer than a sequence, however long, is cut into full pieces
after a first, shorter one; repeated rows are packed each; other columns, whatever their
names, are ignored; no rows give no rows.
"""

from __future__ import annotations

import json
import re
import sys
import types
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantloom.llm._spark import materialise, partitions_of

LENGTH, END_ID, OPEN_BINS, RUN_PIECES, SEQUENCES = 1024, 2, 256, 512, 8000

#: Entries of a worker's cache of encoded words.
CACHE_WORDS = 50_000


class Encoder:
    """Byte-level BPE ids of texts, as little-endian 32-bit bytes.

    Texts are cut before single spaces, where the vocabulary's pre-tokeniser
    always starts a new piece; ids of such parts are remembered.  Parts not seen
    before are encoded together: in the joint result, a token that begins with a
    space begins a part.  A text with a special token's string takes the plain path.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.plain.get_added_tokens_decoder().values()]
        vocab = self.plain.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            self.opens[i] = token.startswith("Ġ")  # how the file writes a space
        self.path, self.fast = path, self._ranks(vocab) if self._known() else None
        if self.fast is not None:
            self.plain = None  # read again by the first text with a special token
        self.cache: dict[str, bytes] = {}

    def _known(self) -> bool:
        """Whether the file states the pre-tokeniser that the faster library is given here, and nothing besides it."""
        file = json.loads(self.plain.to_str())
        before, model = file.get("pre_tokenizer") or {}, file.get("model") or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True)
        return bool(plain and not file.get("normalizer") and model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")))

    def _ranks(self, vocab: dict[str, int]):
        """The same vocabulary for the faster of the two libraries; ids are the same."""
        import tiktoken

        signs, other = {}, 256
        for b in range(256):
            if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
                signs[chr(b)] = b
            else:
                signs[chr(other)] = b
                other += 1
        ranks = {bytes(signs[c] for c in t): i for t, i in vocab.items() if t not in self.specials}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def _learn(self, parts: list[str], used: set[str]) -> None:
        """Encodes ``parts`` into the cache; a full one keeps what the texts at hand use, so that none of them is encoded twice."""
        if len(self.cache) + len(parts) > CACHE_WORDS:
            self.cache = {p: self.cache[p] for p in used.intersection(self.cache)}
        ids = np.array(self.fast.encode_ordinary(" " + " ".join(parts)), "<u4")
        at = np.flatnonzero(self.opens[ids])
        if len(at) != len(parts):  # a part holds a space of its own
            for p in parts:
                self.cache[p] = array("I", self.fast.encode_ordinary(" " + p)).tobytes()
            return
        raw, ends = ids.tobytes(), [*(at[1:] * 4).tolist(), len(ids) * 4]
        for p, lo, hi in zip(parts, (at * 4).tolist(), ends, strict=True):
            self.cache[p] = raw[lo:hi]

    def __call__(self, texts: list[str]) -> list[bytes]:
        from tokenizers import Tokenizer

        if self.fast is None:
            return [array("I", self.plain.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
        out: list = [None] * len(texts)
        split, used = [], set()
        for r, text in enumerate(texts):
            if any(s in text for s in self.specials):
                if self.plain is None:
                    self.plain = Tokenizer.from_file(self.path)
                out[r] = array("I", self.plain.encode(text, add_special_tokens=False).ids).tobytes()
                split.append(None)
                continue
            parts = re.split(r" (?=\S)", text) if _TWO.search(text) else text.split(" ")
            split.append(parts)
            used.update(parts[1:])
        new = used.difference(self.cache)
        if new:
            self._learn(list(new), used)
        for r, parts in enumerate(split):
            if parts is not None:
                head = array("I", self.fast.encode_ordinary(parts[0])).tobytes()
                out[r] = head + b"".join(map(self.cache.__getitem__, parts[1:]))
        return out


_TWO = re.compile(r" (?=\s|$)")


def _encoder(path: str) -> Encoder:
    """One encoder for the life of a worker process, whichever task asks."""
    held = sys.modules.setdefault("_quantloom_worker", types.ModuleType("_quantloom_worker")).__dict__.setdefault("encoders", {})
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def piece_bounds(n: int, length: int) -> list[tuple[int, int]]:
    """Start and end of each piece of ``n`` tokens: a first, shorter one, then full ones."""
    first = n % length or min(n, length)
    return [(0, first), *((s, s + length) for s in range(first, n, length))]


_PIECES = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
_PIECES_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cutter(path: str, length: int, end_id: int, with_ids: bool):
    schema = pa.schema([*_PIECES, *[("ids", pa.binary())] * with_ids])
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        for batch in batches:
            docs, texts = batch.column("doc_id").to_pylist(), [x or "" for x in batch.column("text").to_pylist()]
            rows, held = [], 0
            for lo in range(0, len(texts), 256):
                for doc, raw in zip(docs[lo : lo + 256], encode(texts[lo : lo + 256]), strict=True):
                    raw += end
                    for k, (a, b) in enumerate(piece_bounds(len(raw) // 4, length)):
                        part = raw[4 * a : 4 * b]
                        rows.append((doc, k, a, b - a, zlib.crc32(part), part))
                        held += len(part) * with_ids
                if held > 1 << 24:
                    yield _rows(rows, schema)
                    rows, held = [], 0
            yield _rows(rows, schema)
            pa.default_memory_pool().release_unused()

    return work


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=False)], schema=schema)


def token_pieces(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Token pieces of ``docs(doc_id, text)``: doc_id, piece, start, length, ids_crc32 [, ids as 32-bit bytes]."""
    return docs.select("doc_id", "text").mapInArrow(_cutter(tokenizer_path, length, end_id, with_ids), _PIECES_SQL + ", ids binary" * with_ids)


class OpenBins:
    """The open sequences of one partition, by free space."""

    def __init__(self, length: int, most: int):
        self.length, self.most = length, most
        self.free: list[list[int]] = [[] for _ in range(length + 1)]
        self.bits = 0
        self.open = self.made = 0

    def put(self, size: int) -> tuple[int, int]:
        """Sequence and offset for a piece of ``size`` tokens."""
        fit = self.bits >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            bucket = self.free[room]
            seq = bucket.pop()
            if not bucket:
                self.bits ^= 1 << room
            self.open -= 1
        else:
            seq, room = self.made, self.length
            self.made += 1
            if self.open >= self.most:  # the fullest closes
                low = (self.bits & -self.bits).bit_length() - 1
                self.free[low].pop()
                if not self.free[low]:
                    self.bits ^= 1 << low
                self.open -= 1
        left = room - size
        if left:
            self.free[left].append(seq)
            self.bits |= 1 << left
            self.open += 1
        return seq, self.length - room


def _runs(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``n``, the last one shorter."""
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            held.append(batch.slice(0, n - rows))
            batch, rows = batch.slice(n - rows), rows + held[-1].num_rows
            if rows == n:
                yield pa.concat_batches(held)
                held, rows = [], 0
    if held:
        yield pa.concat_batches(held)


def pack(pieces: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS, partitions: int | None = None) -> DataFrame:
    """Place ``pieces(length, ...)`` of at most ``length`` tokens; adds sequence_id and offset.

    Rows are dealt evenly over ``partitions`` by a hash of all columns; each partition
    packs alone and leaves at most ``open_bins`` sequences part-filled.  By default there
    is a partition for every ``SEQUENCES`` full sequences, and no more than the session's
    shuffle partitions; ``pieces`` is read once more to count its tokens.
    """
    if partitions is None:
        total = pieces.agg(F.sum("length")).first()[0] or 0
        partitions = min(partitions_of(pieces), 1 + total // (length * SEQUENCES))
    n = partitions
    fixed = [c for c in pieces.columns if c != "ids"]
    dealt = pieces.repartition(n, F.xxhash64(*fixed)).sortWithinPartitions(F.xxhash64(*fixed), *fixed)
    schema = dealt.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, bins = TaskContext.get().partitionId() << 40, OpenBins(length, open_bins)
        for run in _runs(batches, RUN_PIECES):
            sizes, placed = run.column("length").to_pylist(), [(0, 0)] * run.num_rows
            for k in sorted(range(run.num_rows), key=sizes.__getitem__, reverse=True):
                placed[k] = bins.put(sizes[k])
            yield pa.RecordBatch.from_arrays([*run.columns, pa.array([base + s for s, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())], names=[*run.schema.names, "sequence_id", "offset"])

    return dealt.mapInArrow(work, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID, open_bins: int = OPEN_BINS, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs(doc_id, text)``; one row per piece."""
    return pack(materialise(token_pieces(docs, tokenizer_path, length, end_id, with_ids), "pieces"), length, open_bins)
