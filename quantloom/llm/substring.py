"""Substring dedup by a relative Lempel-Ziv parse against the corpus itself.

A passage repeats if its ``window`` words start anywhere else too.  To parse all texts
against all texts without matching every document with every block, the reference text
is dealt to *blocks* by content: every window has an anchor, the smallest hash among its
word 8-grams, and the windows of one anchor form a *phrase* of the text (about 14
windows).  A factor of ``window`` words has its anchor in both places, so a block can
hold a factor of a document only if it holds one of its anchors.

1. An anchor that occurs once in the corpus has no factor.
2. Phrases are named by a 128-bit BLAKE2 digest of their words.  If all phrases of an
   anchor are equal, each is a factor as a whole; so are equal ones among others.
3. The words of the *different* phrases of an anchor, one copy of each, are the reference
   text of its block.  The block is indexed by a suffix array over word numbers (made by
   prefix doubling), and each phrase is parsed against it: at each word the longest match
   with any other place of the block is grown, word by word compared.  Matches of
   ``window`` words or more are factors: the greedy ones, and at their boundaries those
   that begin inside one factor and run past its end.
4. An anchor of more than ``CROWD`` different phrases, as around a line that a third of
   the documents share, would make a block without bound.  It is made longer (8 words, 22,
   29, 32, 34, 35): by half of what a window still lacks, to the left for the windows that
   have so much to the left of it, else to the right.  So a phrase falls into two at most.
   Equal ones become one, an anchor that is left with one phrase has no factor among
   them, one of few phrases makes a block (3), and what is still crowded is halved again.

Factors are joined into duplicate spans.  Anchors only propose.

All is judged on the input texts; every occurrence is reported, the first too.  Anchors
and phrases that hold many rows are joined by broadcast (``join_counted``), and a passage
however common lands in no single task.

Defined cases: a null text has no words; fewer words than a window never repeat; a null
``doc_id`` is a document like another; very long texts are parsed whole, in slices where
they lie; repeated rows repeat each other; an empty table gives no rows; only ``doc_id``
and ``text`` are read, other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantloom.llm import _kernels as K
from quantloom.llm._spark import discard, join_counted, materialise, null_safe, partitions_of, row_hash

#: Words of a window and of an anchor, different phrases beyond which an anchor is made longer, words of a block (and one anchor's more).
WINDOW, GRAM, CROWD, BLOCK_WORDS = 35, 8, 512, 1 << 18

_SPACED = bytes(0x20 if K.SPACES[i] else i for i in range(256))
_LOW = np.uint64((1 << 28) - 1)


def anchors(hashes: np.ndarray, first: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that lie within a row, their anchors' positions, and the word 8-gram hashes.

    ``first`` holds the first word of each row and the number of words.  The anchor is
    the leftmost of the smallest 8-grams, which depends on the window's words alone.
    """
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums, down = K.word_prefix(hashes)
    lo = np.arange(n - gram + 1)
    grams = K.spans_hash(sums, down, lo, lo + gram)
    rank = (grams & ~_LOW) | lo.astype(np.uint64)
    least = (K.sliding_min(rank, window - gram + 1) & _LOW).astype(np.int64)
    end_of_row = np.repeat(first[1:], np.diff(first))
    at = np.arange(n - window + 1)
    inside = at + window <= end_of_row[: len(at)]
    return at[inside], least[inside], grams


def digest(words: bytes) -> bytes:
    return hashlib.blake2b(words, digest_size=16).digest()


def split_words(text: str | None) -> list[bytes]:
    return [w for w in (text or "").encode().translate(_SPACED).split(b" ") if w]


def _phrases(window: int, gram: int):
    schema = pa.schema([("doc_id", pa.int64()), ("row_hash", pa.int64()), ("anchor", pa.int64()), ("phrase", pa.binary()), ("pos", pa.int32()), ("n", pa.int32())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = K.texts(batch.column("text"))
            doc, row = batch.column("doc_id").cast(pa.int64()), batch.column("row_hash")
            for lo, hi in K.slices(at):
                part, off = data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
                starts, ends, first = K.words(part, off)
                hashes = K.word_hashes(part, starts, ends)
                win, anchor, grams = anchors(hashes, first, window, gram)
                if not len(win):
                    continue
                cut = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
                a, p = win[cut], anchor[cut]
                n = np.diff(np.concatenate((cut, [len(win)])))
                plain, at_word = K.spaced(part, starts, ends)
                phrase = [digest(plain[i:j]) for i, j in zip(at_word[a].tolist(), (at_word[a + n + window - 1] - 1).tolist(), strict=True)]
                r = np.searchsorted(first, a, "right") - 1
                take = pa.array(r + lo)
                yield pa.RecordBatch.from_arrays([doc.take(take), row.take(take), pa.array(grams[p].view(np.int64)), pa.array(phrase, pa.binary()), pa.array((a - first[r]).astype(np.int32)), pa.array(n.astype(np.int32))], schema=schema)

    return work


def _segments(window: int):
    """Worker: the words of the listed phrases."""
    schema = pa.schema([("anchor", pa.int64()), ("crowded", pa.bool_()), ("copies", pa.int64()), ("doc_id", pa.int64()), ("row_hash", pa.int64()), ("pos", pa.int32()), ("n", pa.int32()), ("words", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc, row, text, listed in zip(batch.column("doc_id").to_pylist(), batch.column("row_hash").to_pylist(), batch.column("text"), batch.column("phrases").to_pylist(), strict=True):
                words = split_words(text.as_py())
                for x in listed:
                    raw = b" ".join(words[x["pos"] : x["pos"] + x["n"] + window - 1])
                    rows.append((x["anchor"], x["crowded"], x["copies"], doc, row, x["pos"], x["n"], raw))
                    held += len(raw)
                if held > K.SLICE * 8:
                    yield _batch(rows, schema)
                    rows, held = [], 0
            yield _batch(rows, schema)

    return work


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def longest_matches(words: np.ndarray, longest: int) -> np.ndarray:
    """For each place of a word sequence, the length of its longest match with another place, up to ``longest`` and at least that far exact.

    Prefix doubling: two places have the same rank at width k if and only if the same k
    words follow them.  In the order of the widest ranks, the longest match of a place is
    with one of its neighbours, and ranks of falling widths add up to its length.
    """
    n = len(words)
    _, rank = np.unique(words, return_inverse=True)
    ranks, width = [(1, rank.astype(np.int64) + 1)], 1
    while width < longest:
        rank = ranks[-1][1]
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - width)] = rank[width:]
        _, nxt = np.unique(rank * (n + 2) + ahead, return_inverse=True)
        width *= 2
        ranks.append((width, nxt.astype(np.int64) + 1))
    order = np.argsort(ranks[-1][1], kind="stable")
    a, b = order[:-1], order[1:]
    common = np.zeros(max(0, n - 1), np.int64)
    for width, rank in reversed(ranks):
        padded = np.append(rank, 0)
        i, j = padded[np.minimum(a + common, n)], padded[np.minimum(b + common, n)]
        common += np.where((i == j) & (i > 0), width, 0)
    out = np.zeros(n, np.int64)
    out[a] = common
    out[b] = np.maximum(out[b], common)
    return out


def block_factors(phrases: list[list[bytes]], window: int) -> list[list[tuple[int, int]]]:
    """For each phrase of a block, its runs (first window, number) of windows that begin a match of ``window`` words elsewhere in the block."""
    vocab: dict[bytes, int] = {}
    flat: list[int] = []
    starts = []
    for k, words in enumerate(phrases):
        starts.append(len(flat))
        flat += [vocab.setdefault(w, len(vocab)) for w in words]
        flat.append(-1 - k)  # a sign of its own ends each phrase: no match runs past it
    match = longest_matches(np.array(flat, np.int64), window)
    out = []
    for start, words in zip(starts, phrases, strict=True):
        hit = match[start : start + max(0, len(words) - window + 1)] >= window
        edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
        out.append([(int(lo), int(hi - lo)) for lo, hi in zip(edge[::2], edge[1::2], strict=True)])
    return out


def _factors(window: int):
    """Worker over rows sorted by anchor: blocks of whole anchors are indexed, and the phrases without a copy are parsed."""
    schema = pa.schema([("doc_id", pa.int64()), ("row_hash", pa.int64()), ("pos", pa.int32()), ("n", pa.int32())])

    def parse(rows: list[dict]) -> pa.RecordBatch:
        found = block_factors([r["words"].split(b" ") for r in rows], window)
        return _batch([(r["doc_id"], r["row_hash"], r["pos"] + lo, n) for r, runs in zip(rows, found, strict=True) if r["copies"] == 1 for lo, n in runs], schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                if size > BLOCK_WORDS and row["anchor"] != rows[-1]["anchor"]:
                    yield parse(rows)
                    rows, size = [], 0
                rows.append(row)
                size += row["n"] + window
        if rows:
            yield parse(rows)

    return work


def _halves(window: int, gram: int, free: int):
    """Worker: phrases in two, by anchors longer by half of the ``free`` words that a window has beside the present one."""
    size, half = window - free, (free + 1) // 2
    schema = pa.schema([("anchor", pa.int64()), ("phrase", pa.binary()), ("copies", pa.int64()), ("doc_id", pa.int64()), ("row_hash", pa.int64()), ("pos", pa.int32()), ("n", pa.int32()), ("words", pa.binary())])

    def longer(anchor: int, side: str, words: list[bytes]) -> int:
        return int.from_bytes(hashlib.blake2b(f"{anchor}{side}".encode() + b" ".join(words), digest_size=8).digest(), "little", signed=True)

    def row(anchor: int, x: dict, lo: int, n: int, words: list[bytes]) -> tuple:
        raw = b" ".join(words[lo : lo + n + window - 1])
        return anchor, digest(raw), x["copies"], x["doc_id"], x["row_hash"], x["pos"] + lo, n, raw

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = K.texts(batch.column("words"))
            for lo, hi in K.slices(at):
                part, off = data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
                starts, ends, first = K.words(part, off)
                win, least, _ = anchors(K.word_hashes(part, starts, ends), first, window, gram)
                place = least[np.searchsorted(win, first[:-1])] - first[:-1]
                lacked = window - gram
                while lacked > free:  # as it was made longer so far
                    more = (lacked + 1) // 2
                    place, lacked = np.where(place >= more, place - more, place), lacked - more
                rows = []
                for x, p in zip(batch.slice(lo, hi - lo).to_pylist(), place.tolist(), strict=True):
                    words, n = x["words"].split(b" "), x["n"]
                    k = min(max(0, p - half + 1), n)  # windows that have half to the left
                    if k:
                        rows.append(row(longer(x["anchor"], "<", words[p - half : p + size]), x, 0, k, words))
                    if k < n:
                        rows.append(row(longer(x["anchor"], ">", words[p : p + size + half]), x, k, n - k, words))
                yield _batch(rows, schema)

    return work


def split_crowds(parts: DataFrame, window: int, gram: int, crowd: int) -> tuple[DataFrame, DataFrame | None]:
    """Phrases whose anchors make blocks, and phrases found to equal others (None if no anchor is crowded).

    ``parts`` holds the different phrases of each anchor with their words, and whether it
    is crowded.  A phrase gives two rows a round at most, each window is in one of them,
    and after the last of five rounds (35 words) equal windows are equal phrases.
    """
    blocks, halved, alike, total = parts.where("not crowded").drop("crowded"), None, None, 0
    crowded, free = parts.where("crowded"), window - gram
    while free and not crowded.isEmpty():
        made = materialise(crowded.mapInArrow(_halves(window, gram, free), "anchor long, phrase binary, copies long, doc_id long, row_hash long, pos int, n int, words binary"), "halves")
        kinds = made.groupBy("anchor", "phrase").agg(F.sum("copies").alias("copies"), F.count("*").alias("k"), F.min(F.struct("doc_id", "row_hash", "pos", "n", "words")).alias("one"))
        kinds = materialise(kinds.select("anchor", "phrase", "copies", "k", "one.*"), "kinds")
        groups = kinds.groupBy("anchor").agg(F.count("*").alias("size")).where("size > 1").withColumn("crowded", F.col("size") > crowd)
        met = materialise(join_counted(kinds.drop("phrase", "k"), groups, ["anchor"], "size", kinds.count()), "segments")
        blocks = blocks.unionByName(met.where("not crowded").drop("crowded"))
        crowded, free = met.where("crowded"), free - (free + 1) // 2
        single, more = made.where("copies = 1").drop("words"), kinds.where("k > 1").select("anchor", "phrase", "k")
        halved, alike = (single, more) if halved is None else (halved.unionByName(single), alike.unionByName(more))
        total += made.count()
    if halved is None:
        return blocks, None
    return blocks, join_counted(halved, alike, ["anchor", "phrase"], "k", total).select("doc_id", "row_hash", "pos", "n")


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """Factors of the parse: runs of ``n`` repeated windows from word ``pos`` of a row (doc_id, row_hash)."""
    if not 0 < gram < window:
        raise ValueError("an anchor must be shorter than a window")
    source = docs.select("doc_id", "text", row_hash("text").alias("row_hash"))
    filed = materialise(source.mapInArrow(_phrases(window, gram), "doc_id long, row_hash long, anchor long, phrase binary, pos int, n int"), "phrases")
    blocks = filed.groupBy("anchor").agg(F.count("*").alias("k"), F.min("phrase").alias("a"), F.max("phrase").alias("b")).where("k > 1")
    blocks = blocks.select("anchor", "k", (F.col("a") != F.col("b")).alias("differ"))
    n_filed = filed.count()
    met = materialise(join_counted(filed, blocks, ["anchor"], "k", n_filed), "met")
    discard(filed)
    whole = met.where("not differ").select("doc_id", "row_hash", "pos", "n")

    edge = met.where("differ")
    kinds = edge.groupBy("anchor", "phrase").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "row_hash", "pos", "n")).alias("one"))
    kinds = materialise(kinds.select("anchor", "phrase", "copies", "one.*"), "kinds")
    copied = kinds.where("copies > 1").select("anchor", "phrase", "copies")
    equal = join_counted(edge, copied, ["anchor", "phrase"], "copies", n_filed).select("doc_id", "row_hash", "pos", "n")
    full = kinds.groupBy("anchor").agg(F.count("*").alias("k")).where(F.col("k") > crowd).select("anchor", F.lit(True).alias("crowded"))
    wanted = kinds.join(F.broadcast(full), "anchor", "left").withColumn("crowded", F.coalesce("crowded", F.lit(False)))  # fewer than one anchor for `crowd` phrases
    wanted = wanted.groupBy("doc_id", "row_hash").agg(F.collect_list(F.struct("anchor", "crowded", "pos", "n", "copies")).alias("phrases"))
    read = source.join(wanted, null_safe(source, wanted, ["doc_id", "row_hash"]))
    read = read.select(source["doc_id"], source["row_hash"], "text", "phrases")
    parts = materialise(read.mapInArrow(_segments(window), "anchor long, crowded boolean, copies long, doc_id long, row_hash long, pos int, n int, words binary").distinct(), "segments")
    parsed, alike = split_crowds(parts, window, gram, crowd)
    dealt = parsed.repartition(partitions_of(docs), "anchor").sortWithinPartitions("anchor")
    grown = dealt.mapInArrow(_factors(window), "doc_id long, row_hash long, pos int, n int")
    found = whole.unionByName(equal).unionByName(materialise(grown, "factors"))
    return found if alike is None else found.unionByName(alike)


def _remover(window: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.list_(pa.int64()))), ("kept_text", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = K.texts(batch.column("text"))
            total, gone, sha, spans, kept = [], [], [], [], []
            for r, factors in enumerate(batch.column("factors")):
                raw = data[at[r] : at[r + 1]].tobytes()
                words = [w for w in raw.translate(_SPACED).split(b" ") if w]
                total.append(len(words))
                own = []
                if factors.is_valid and len(factors):
                    flat = factors.values
                    lo = flat.field("pos").to_numpy(zero_copy_only=False).astype(np.int64)
                    hi = lo + flat.field("n").to_numpy(zero_copy_only=False) + window - 1
                    mask = K.covered(len(words), lo, hi)
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
                    own = edge.reshape(-1, 2).tolist()
                    words = [words[i] for i in np.flatnonzero(~mask).tolist()]
                text = b" ".join(words)
                gone.append(total[-1] - len(words))
                spans.append(own)
                sha.append(hashlib.sha256(text).hexdigest())
                kept.append(text.decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()), pa.array(spans, schema.field("spans").type), pa.array(kept, pa.string())], schema=schema)

    return work


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs(doc_id, text)`` without the words of repeated passages.

    Returns doc_id, n_words, n_removed, kept_sha256, spans (word ranges of the joined
    factors) and kept_text for every row.
    """
    source = docs.select("doc_id", "text", row_hash("text").alias("row_hash"))
    factors = repeated_windows(docs, window, gram).groupBy("doc_id", "row_hash").agg(F.collect_list(F.struct("pos", "n")).alias("factors"))
    both = source.join(factors, null_safe(source, factors, ["doc_id", "row_hash"]), "left").select(source["doc_id"], "text", "factors")
    return both.mapInArrow(_remover(window), "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<array<long>>, kept_text string")
