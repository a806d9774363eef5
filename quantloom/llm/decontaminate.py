"""Benchmark decontamination with a generalised suffix automaton.

The normalised benchmark items are the strings of one suffix automaton over word
numbers; training words are streamed through it and the length of the longest
matching suffix is tracked at each word.  Where it reaches the window length, the
words of the window are hit.

Normalisation: A-Z are lower-cased, words are runs of digits, letters a-z and
non-ASCII bytes.  Items are handled in blocks of at most ``block_words`` words, so
what is sent to the workers and held by the driver is bounded whatever the benchmark's
size; each block is one pass over the documents, whose findings are written down.  A
worker builds the automaton of a block once.

Defined cases: a null text has no words; an item without words never occurs; an
item shorter than the window is a window as a whole; repeated items or repeated
``item_id`` count once by ``item_id``; a very long text is streamed whole; repeated rows
stay repeated; other columns, whatever their names, stay as they are; an empty table on
either side is no error.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import sys
import types
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantloom.llm import _kernels as K
from quantloom.llm._spark import fresh, materialise, row_hash

#: Words of a window, and words of benchmark items in one automaton (about 200 bytes each on a worker).
WINDOW, BLOCK_WORDS = 10, 400_000

#: Bytes that are no part of a word, after lower-casing.
_APART = np.zeros(256, bool)
_APART[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
#: Lower-cases A-Z and turns every separator into a space.
TABLE = bytes(0x20 if _APART[K.UPPER[i]] else int(K.UPPER[i]) for i in range(256))


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TABLE).split()


class Automaton:
    """Generalised suffix automaton of word sequences; a state knows the windows that end at its strings."""

    def __init__(self, window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.vocab: dict[bytes, int] = {}
        #: windows by their word numbers: the items that have them
        self.items: dict[tuple[int, ...], set[str]] = {}
        self.sizes: set[int] = set()
        self.pairs: set[int] = set()

    def add(self, item: str, words: list[bytes]) -> None:
        if not words:
            return
        ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
        last = 0
        for c in ids:
            last = self._extend(last, c)
        size = min(self.window, len(ids))
        self.sizes.add(size)
        for i in range(len(ids) - size + 1):
            self.items.setdefault(tuple(ids[i : i + size]), set()).add(item)
        self.pairs.update((a << 32) | b for a, b in zip(ids, ids[1:], strict=False))

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, q, c)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
        return cur

    def _clone(self, p: int, q: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = new
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def stream(self, ids: list[int]) -> list[int]:
        """Length of the longest suffix of ids[: i + 1] that occurs in an item, for each i."""
        nxt, link, length = self.next, self.link, self.length
        state, n, out = 0, 0, []
        for c in ids:
            while state and c not in nxt[state]:
                state = link[state]
                n = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                n += 1
            else:
                n = 0
            out.append(n)
        return out


@dataclass
class Matcher:
    """Finds the windows of one block of items in the words of a text."""

    rows: list[tuple[str, str]]
    window: int = WINDOW
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def _make(self) -> tuple:
        """The automaton, kept for the next tasks of the worker process."""
        held = sys.modules.setdefault("_quantloom_worker", types.ModuleType("_quantloom_worker")).__dict__.setdefault("automata", {})
        if self.key not in held:
            auto = Automaton(self.window)
            for item, text in self.rows:
                auto.add(item, normal_words(text))
            held.clear()
            held[self.key] = auto, np.array(sorted(auto.pairs), np.int64), min(auto.sizes, default=0)
        return held[self.key]

    def __call__(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit word ranges (each a window) and the items whose windows occur."""
        auto, pairs, least = self._make()
        if not least or len(words) < least:
            return [], set()
        ids = np.fromiter(map(auto.vocab.get, words, _MINUS), np.int64, len(words))
        known = ids >= 0
        if least > 1:  # a match of n words is n - 1 known pairs in a row: most words need no step of the automaton
            code = (ids[:-1] << 32) | np.maximum(ids[1:], 0)
            ok = known[:-1] & known[1:]
            if len(pairs):
                where = np.minimum(np.searchsorted(pairs, code), len(pairs) - 1)
                ok &= pairs[where] == code
            else:
                ok[:] = False
            need = least - 1
        else:
            ok, need = known, 1
        edge = np.flatnonzero(np.diff(np.concatenate(([0], ok.view(np.int8), [0]))))
        spans, found = [], set()
        for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if hi - lo < need:
                continue
            run = ids[lo : hi + (least > 1)].tolist()
            for i, n in enumerate(auto.stream(run)):
                for size in auto.sizes:
                    if n >= size and (items := auto.items.get(tuple(run[i + 1 - size : i + 1]))):
                        spans.append((lo + i + 1 - size, lo + i + 1))
                        found |= items
        return spans, found


class _Always:
    def __iter__(self):
        return self

    def __next__(self):
        return -1


_MINUS = _Always()


def _blocks(bench: DataFrame, block_words: int) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of at most ``block_words`` words (a longer item alone), one block on the driver at a time."""
    rows, size = [], 0
    for item, text in bench.select(F.col("item_id").cast("string"), "text").where("item_id is not null and text is not null").toLocalIterator():
        n = len(normal_words(text))
        if rows and size + n > block_words:
            yield rows
            rows, size = [], 0
        rows.append((item, text))
        size += n
    yield rows


_OUT = pa.schema([("doc_id", pa.int64()), ("row_hash", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])
_SQL = "doc_id long, row_hash long, n_words long, spans array<array<long>>, items array<string>"


def _finder(matcher: Matcher):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, spans, items = [], [], []
            for text in batch.column("text"):
                words = normal_words(text.as_py())
                s, i = matcher(words)
                n.append(len(words))
                spans.append(s)
                items.append(sorted(i))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("row_hash"), pa.array(n, pa.int64()), pa.array([[list(x) for x in s] for s in spans], _OUT.field("spans").type), pa.array(items, _OUT.field("items").type)], schema=_OUT)

    return work


def find_overlaps(docs: DataFrame, bench: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Benchmark windows in ``docs(doc_id, text)``: doc_id, row_hash, n_words, spans (word ranges), items.

    One row per row of ``docs``, repeated ones too.  With more than one block of items
    the blocks' findings are merged by (doc_id, row_hash): rows alike there have the
    same findings in each block, so one of them is merged and written as often as it came.
    """
    source = docs.select("doc_id", "text", row_hash("text").alias("row_hash"))
    key = ["doc_id", "row_hash"]
    blocks = _blocks(bench, block_words)
    head = list(itertools.islice(blocks, 2))
    first = source.mapInArrow(_finder(Matcher(head[0], window)), _SQL)
    if len(head) == 1:
        return first
    parts, rest = [materialise(first, "block")], itertools.chain(head[1:], blocks)
    del head
    for rows in rest:  # beyond the first block, only rows with findings are written
        parts.append(materialise(source.mapInArrow(_finder(Matcher(rows, window)), _SQL).where(F.size("spans") > 0), "block"))
    out = functools.reduce(DataFrame.unionByName, [p.withColumn("block", F.lit(k)) for k, p in enumerate(parts)])
    out = out.groupBy(*key, "block").agg(*[F.first(c).alias(c) for c in ("n_words", "spans", "items")], F.count("*").alias("times"))
    out = out.groupBy(*key).agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), F.max("times").alias("times")
    )
    return out.withColumn("_", F.explode(F.sequence(F.lit(1), "times"))).drop("_", "times")


def contamination_report(docs: DataFrame, bench: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, coverage for every document."""
    found = find_overlaps(docs, bench, window, block_words)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, spans, items = b.column("n_words").to_pylist(), b.column("spans").to_pylist(), b.column("items").to_pylist()
            hit = []
            for k, s in zip(n, spans, strict=True):
                x = np.array(s, np.int64).reshape(-1, 2)
                hit.append(int(K.covered(k, x[:, 0], x[:, 1]).sum()) if len(x) else 0)
            sha = [hashlib.sha256(",".join(sorted(i)).encode()).hexdigest() for i in items]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "n_words": n, "n_hit": pa.array(hit, pa.int64()), "n_items": pa.array(map(len, items), pa.int64()), "items_sha256": pa.array(sha, pa.string()), "contaminated": pa.array([h > 0 for h in hit], pa.bool_()), "coverage": pa.array([h / k if k else 0.0 for h, k in zip(hit, n, strict=True)], pa.float64())})

    return found.mapInArrow(digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, coverage double")


def decontaminate(docs: DataFrame, bench: DataFrame, window: int = WINDOW, max_coverage: float = 0.5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with the hit words cut out of ``text`` (characters from the first to the last word of a span).

    A document that lost more than ``max_coverage`` of its words goes as a whole.  The
    spans of all blocks of items count together, so ``block_words`` changes no result.
    ``n_chars``, if there, follows the new text; other columns stay as they are.
    """
    head = list(itertools.islice(_blocks(bench, block_words), 2))
    if len(head) == 1:
        return docs.mapInArrow(_cutter(docs.columns, Matcher(head[0], window), max_coverage), docs.schema)
    del head
    # Several blocks: the spans of all of them, found in the unchanged text, are cut at once.
    found = find_overlaps(docs, bench, window, block_words).where(F.size("spans") > 0).dropDuplicates(["doc_id", "row_hash"])
    doc, hashed, own, spans = (fresh(docs, x) for x in ("found_doc", "found_hash", "own_hash", "found_spans"))
    found = found.select(F.col("doc_id").alias(doc), F.col("row_hash").alias(hashed), F.col("spans").alias(spans))
    spanned = docs.withColumn(own, row_hash("text")).join(found, F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(hashed)), "left")
    return spanned.select(*docs.columns, spans).mapInArrow(_cutter(docs.columns, spans, max_coverage), docs.schema)


def _cutter(names: list[str], source: Matcher | str, max_coverage: float):
    """Worker that cuts the spans that a matcher finds, or those of a column."""
    matcher = source if isinstance(source, Matcher) else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = batch.column("text").to_pylist(), np.ones(batch.num_rows, bool)
            given = None if matcher else batch.column(source).to_pylist()
            cut = np.zeros(batch.num_rows, bool)
            for r, text in enumerate(texts):
                spans = matcher(normal_words(text))[0] if matcher else given[r]
                if not spans:
                    continue
                raw = text.encode()
                data = np.frombuffer(raw, np.uint8)
                starts, ends, _ = K.words(data, np.array([0, len(data)]), _SEPARATORS)
                x = np.array(spans, np.int64)
                mask = K.covered(len(starts), x[:, 0], x[:, 1])
                if mask.sum() > max_coverage * len(mask):
                    keep[r] = False
                    continue
                edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
                out, last = [], 0
                for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                    out.append(raw[last : starts[lo]])
                    last = int(ends[hi - 1])
                texts[r] = b"".join([*out, raw[last:]]).decode()
                cut[r] = True
            columns = {name: batch.column(name) for name in names}
            if cut.any():
                columns["text"] = pa.array(texts, batch.schema.field("text").type)
                if "n_chars" in columns:
                    n = pa.compute.utf8_length(columns["text"]).cast(columns["n_chars"].type)
                    columns["n_chars"] = pa.compute.if_else(pa.array(cut), n, columns["n_chars"])
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns)).filter(pa.array(keep))

    return work


_SEPARATORS = _APART[K.UPPER]
