"""SimHash near-dedup with pivot distance tables.

A fingerprint has a bit for each bit that is set in over half of the shingles'
XXH64 hashes.  Documents link where their fingerprints differ in at most
``max_bits`` bits; groups are the connected components.

Links are sought between *different* fingerprints only (class representatives).
Two fingerprints within three bits agree in one of four 16-bit blocks and in one
of four 12-bit blocks of the remaining bits, so sixteen keys of 28 bits find every
link.  Within a key, each fingerprint has a table row of its Hamming distances to
many fixed reference fingerprints (pivots); by the triangle inequality a pair
whose rows differ by more than ``max_bits`` in any coordinate is no link.  Rows are
swept in the order of the first coordinate, the others discard what is left, and
the survivors are verified.  A key with more than ``slice_rows`` fingerprints is
dealt out as pairs of slices, so that a task holds two slices at most; of its links
each task gives back a spanning forest, never all pairs.

For a corpus three bits are too few: texts of a five-word Jaccard similarity of 0.8 differ
in about ten.  ``near_copies`` and ``drop_near_duplicates`` therefore take proposals from
bands of shingle minima too, let the pivot tables discard the far ones, and verify the
similarity itself.

Defined cases: a null or empty text has fingerprint 0, linked like any other; rows
repeated or tied share a component; a null ``doc_id`` takes part but names no
component unless all of its members are null; very long texts are fingerprinted whole;
an empty table gives no rows; other columns, whatever their names, are ignored or kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantloom.llm import _kernels as K
from quantloom.llm._spark import connected_components, discard, fresh, join_counted, materialise, null_safe, partitions_of, row_hash

SEED, SHINGLE, MAX_BITS, PIVOTS, SLICE_ROWS = 42, 3, 3, 24, 4096
#: Near copies of a corpus: words of a shingle, least Jaccard similarity, bits that their fingerprints may differ in.
STAGE_SHINGLE, SIMILARITY, FAR_BITS = 5, 0.8, 26
#: Bands of shingle minima and minima in each: a pair of similarity 0.8 shares one of 16 bands of 6 with probability 0.99.
BANDS, ROWS = 16, 6
#: Members of a centre that are verified in one part.
MEMBERS = 512
#: Members outside a band's largest component that meet the others in one slice.
SLICE = 64

_FACTORS = np.random.default_rng(20240301).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)

_LANES = np.uint64(0x0101010101010101)


def bit_majority(h: np.ndarray) -> int:
    """Bits set in over half of the 64-bit values."""
    n, counts = len(h), np.zeros(64, np.int64)
    for b in range(8):
        lanes = (h >> np.uint64(b)) & _LANES  # eight counters of eight bits, one a byte
        sums = np.add.reduceat(lanes, np.arange(0, n, 255))
        counts[b::8] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(counts * 2 > n).tolist()))


def fingerprint(words: list[bytes], size: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of word shingles, repeats included; fewer words: the whole sequence; none: 0."""
    if not words:
        return 0
    text = b" ".join(words)
    hash_ = xxhash.xxh64_intdigest
    if len(words) <= size:
        return hash_(text, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    n = len(words) - size + 1
    h = [hash_(text[a:b], seed) for a, b in zip(starts[:n].tolist(), (ends[size - 1 :] - 1).tolist(), strict=True)]
    return bit_majority(np.array(h, np.uint64))


_TABLE = bytes(0x20 if K.SPACES[i] else int(K.UPPER[i]) for i in range(256))


def simhash_words(text: str | None) -> list[bytes]:
    return [w for w in (text or "").encode().translate(_TABLE).split(b" ") if w]


def _fingerprints(size: int, seed: int):
    schema = pa.schema([("doc_id", pa.int64()), ("row_hash", pa.int64()), ("fp", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(simhash_words(t.as_py()), size, seed) for t in batch.column("text")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("row_hash"), pa.array(fps.view(np.int64))], schema=schema)

    return work


def keys_of(fps: np.ndarray) -> np.ndarray:
    """The sixteen 28-bit block keys of each fingerprint, numbered by table in the high bits."""
    out = []
    for block in range(4):
        own = (fps >> np.uint64(16 * block)) & np.uint64(0xFFFF)
        low = fps & np.uint64((1 << 16 * block) - 1)
        high = (fps >> np.uint64(16 * block)) >> np.uint64(16)
        rest = low | (high << np.uint64(16 * block))
        for part in range(4):
            sub = (rest >> np.uint64(12 * part)) & np.uint64(0xFFF)
            out.append((np.uint64(block * 4 + part) << np.uint64(28)) | (own << np.uint64(12)) | sub)
    return np.stack(out, axis=1).view(np.int64)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False)
        keys = keys_of(fps.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(fps, 16)), pa.array(keys.ravel())], names=["fp", "key"])


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Fixed reference fingerprints: half of the bits of each are set at random."""
    return np.random.default_rng(20240229).integers(0, 1 << 64, n, np.uint64)


def linked(a: np.ndarray, b: np.ndarray | None, refs: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among ``a``, or between ``a`` and ``b`` too, by pivot tables."""
    fps = a if b is None else np.concatenate((a, b))
    first = np.bitwise_count(fps ^ refs[0])
    order = np.argsort(first, kind="stable")
    fps = fps[order]
    table = np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)
    hi = np.searchsorted(table[:, 0], table[:, 0] + np.int8(max_bits), "right")
    label = np.arange(len(fps))
    forest: list[tuple[int, int]] = []
    lo = 0
    while lo < len(fps):
        end = max(lo + 1, int(np.searchsorted(np.cumsum(hi[lo:] - np.arange(lo, len(fps))), 1 << 20)) + lo)
        rows = np.arange(lo, end)
        n = hi[lo:end] - rows - 1
        i = np.repeat(rows, n)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + i + 1
        for c in range(1, table.shape[1]):
            ok = np.abs(table[i, c] - table[j, c]) <= max_bits
            i, j = i[ok], j[ok]
        ok = np.bitwise_count(fps[i] ^ fps[j]) <= max_bits
        i, j = i[ok], j[ok]
        while len(i):
            x, y = label[i], label[j]
            open_ = x != y
            i, j, x, y = i[open_], j[open_], x[open_], y[open_]
            if not len(i):
                break
            top, low = np.maximum(x, y), np.minimum(x, y)
            _, one = np.unique(top, return_index=True)  # one link a label: no cycles, labels only fall
            forest += zip(i[one].tolist(), j[one].tolist(), strict=True)
            label[top[one]] = low[one]
            while not np.array_equal(label, nxt := label[label]):
                label = nxt
        lo = end
    return [(int(fps[i]), int(fps[j])) for i, j in forest]


def _links(n_pivots: int, max_bits: int):
    """Worker over rows sorted by (key, a, b): the links of each run, a run held at a time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = pivots(n_pivots)
        run, held = None, []

        def close() -> list[tuple[int, int]]:
            fps = np.unique(np.concatenate(held)).view(np.uint64)
            return linked(fps, None, refs, max_bits) if len(fps) > 1 else []

        for batch in batches:
            out: list[tuple[int, int]] = []
            key = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "a", "b")], axis=1)
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(fps)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                if run is not None and run != tuple(key[lo]):
                    out += close()
                    held = []
                run = tuple(key[lo])
                held.append(fps[lo:hi])
            yield _edges(out)
        if held:
            yield _edges(close())

    return work


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    x = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], names=["u", "v"])


def fingerprint_links(reps: DataFrame, max_bits: int = MAX_BITS, n_pivots: int = PIVOTS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Links (u, v) that join the same components as all pairs within ``max_bits`` bits of ``reps(fp)`` would."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the block keys find links of up to 3 bits")
    # Written out, for Spark takes a worker to give as few rows as it reads, and would broadcast sixteen times as many.
    keyed = materialise(reps.mapInArrow(_keyed, "fp long, key long"), "keys")
    many = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").withColumn("parts", F.ceil(F.col("n") / slice_rows).cast("int"))
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    rows = keyed.join(many, "key").withColumn("mine", mine)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("fp", "key", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"))
    rows = rows.repartition(partitions_of(reps), "key", "a", "b").sortWithinPartitions("key", "a", "b")
    return rows.mapInArrow(_links(n_pivots, max_bits), "u long, v long").distinct()


def grouped(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED, n_pivots: int = PIVOTS) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` as doc_id, row_hash, fp, root (a fingerprint that names the component) and component_id."""
    source = docs.select("doc_id", "text", row_hash("text").alias("row_hash"))
    found = materialise(source.mapInArrow(_fingerprints(size, seed), "doc_id long, row_hash long, fp long"), "fingerprints")
    reps = materialise(found.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")), "representatives")
    roots = connected_components(fingerprint_links(reps.select("fp"), max_bits, n_pivots))
    rooted = reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    named = materialise(join_counted(rooted, ids, ["root"], "n", reps.count()).select("fp", "root", "component_id", "rows"), "named")
    return join_counted(found, named, ["fp"], "rows", found.count()).select("doc_id", "row_hash", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED, n_pivots: int = PIVOTS) -> DataFrame:
    """Components of near-equal texts in ``docs(doc_id, text)``.

    Returns doc_id, fingerprint (16 hexadecimal digits) and component_id (smallest
    ``doc_id`` of the component) for every row.
    """
    return grouped(docs, size, max_bits, seed, n_pivots).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def minima(shingles: np.ndarray) -> np.ndarray:
    """Band keys of a set of shingle hashes: equal in a band with probability J ** ROWS for sets of Jaccard similarity J."""
    least = np.array([(shingles * a).min() for a in _FACTORS], np.uint64)
    return np.array([xxhash.xxh64_intdigest(band.tobytes(), k) for k, band in enumerate(least.reshape(BANDS, ROWS))], np.uint64)


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """The different hashes of the word shingles, in order; fewer words: that of the whole sequence; none: none."""
    if not words:
        return np.zeros(0, np.uint64)
    grams = {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64, len(grams)))


_SKETCH = "doc_id long, row_hash long, class binary, fp long, n int, bands array<long>"


def _sketches(size: int):
    """Worker: the class of equal word sequences, the fingerprint and the band keys of each text."""
    schema = pa.schema([("doc_id", pa.int64()), ("row_hash", pa.int64()), ("class", pa.binary()), ("fp", pa.int64()), ("n", pa.int32()), ("bands", pa.list_(pa.int64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                classes, fps, sizes, bands = [], [], [], []
                for t in part.column("text"):
                    words = simhash_words(t.as_py())
                    own = shingle_set(words, size)
                    classes.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                    fps.append(bit_majority(own) if len(own) else 0)
                    sizes.append(len(own))
                    bands.append(minima(own).view(np.int64) if len(own) else np.zeros(0, np.int64))
                fp = np.array(fps, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), part.column("row_hash"), pa.array(classes, pa.binary()), pa.array(fp), pa.array(sizes, pa.int32()), pa.array(bands, pa.list_(pa.int64()))], schema=schema)
            pa.default_memory_pool().release_unused()

    return work


def _verify(size: int, similarity: float):
    """Worker over rows sorted by (centre, part, role): pairs of at least ``similarity``, one centre and one member held at a time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            us, vs = [], []
            for v, u, text in zip(batch.column("v").to_pylist(), batch.column("u").to_pylist(), batch.column("text"), strict=True):
                own = shingle_set(simhash_words(text.as_py()), size)
                if u is None:
                    centre, held = v, own
                    continue
                if v != centre:
                    raise RuntimeError("a member without its centre")
                both = len(np.intersect1d(held, own, assume_unique=True))
                if both >= similarity * (len(held) + len(own) - both) and both:
                    us.append(u)
                    vs.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], names=["u", "v"])
            pa.default_memory_pool().release_unused()

    return work


def within_pivots(max_bits: int, refs: np.ndarray) -> Column:
    """Whether the pivot tables of the fingerprints ``fu`` and ``fv`` allow ``max_bits`` differing bits, and the fingerprints have no more."""
    ok = F.bit_count(F.col("fu").bitwiseXOR(F.col("fv"))) <= max_bits
    for p in refs.view(np.int64).tolist():
        ok = ok & (F.abs(F.bit_count(F.col("fu").bitwiseXOR(F.lit(p))) - F.bit_count(F.col("fv").bitwiseXOR(F.lit(p)))) <= max_bits)
    return ok


def _possible(max_bits: int, n_pivots: int, similarity: float) -> Column:
    """Whether the fingerprints (``fu``, ``fv``) and sizes (``nu``, ``nv``) of two sets of shingles allow the similarity; sizes decide exactly."""
    return within_pivots(max_bits, pivots(n_pivots)) & (F.least("nu", "nv") >= F.greatest("nu", "nv") * similarity)


class _Verifier:
    """Pairs of classes by their whole sets of shingles, and the components of those found similar."""

    def __init__(self, texts: DataFrame, size: int, similarity: float) -> None:
        self.texts, self.size, self.similarity = texts, size, similarity

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) that are similar.  Texts meet in parts of ``MEMBERS`` members of a centre v; a task holds one of each."""
        n = pairs.count()
        parts = materialise(pairs.groupBy("v").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"), F.count("*").alias("n")), "parts")
        dealt = join_counted(pairs, parts, ["v"], "n", n).withColumn("part", F.pmod(F.xxhash64("u"), F.col("parts")).cast("int"))
        members = dealt.join(self.texts.withColumnRenamed("class", "u"), "u").select("v", "part", "u", "text")
        centres = parts.join(self.texts.withColumnRenamed("class", "v"), "v").select("v", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("binary").alias("u"), "text")
        rows = members.unionByName(centres).repartition(partitions_of(pairs), "v", "part").sortWithinPartitions("v", "part", F.col("u").asc_nulls_first())
        found = materialise(rows.mapInArrow(_verify(self.size, self.similarity), "u binary, v binary"), "links")
        discard(parts)
        return found

    def merged(self, comps: DataFrame, pairs: DataFrame) -> DataFrame:
        """Components (class, comp) after the similar ones of ``pairs`` (u, v) whose components (cu, cv) are joined."""
        found = self.links(pairs.select("u", "v").distinct())
        joined = materialise(pairs.join(found, ["u", "v"], "left_semi").select(F.col("cu").alias("u"), F.col("cv").alias("v")).distinct(), "joined")
        if joined.isEmpty():
            return comps
        roots = connected_components(joined).withColumnRenamed("node", "comp")
        sizes = comps.groupBy("comp").agg(F.count("*").alias("n"))
        renamed = materialise(sizes.join(roots, "comp", "left").select("comp", F.coalesce("root", "comp").alias("now"), "n"), "renamed")
        return materialise(join_counted(comps, renamed, ["comp"], "n", comps.count()).select("class", F.col("now").alias("comp")), "comps")


def _left_over(members: DataFrame, comps: DataFrame, possible: Column) -> DataFrame:
    """Pairs of a band that no star compared: members of different components, neither the band's centre.

    In each band the members outside its largest component meet all others, in slices of
    ``SLICE`` by ``SLICE_ROWS`` so that no band is one task's.
    """
    rows = members.where("class <> low").drop("low")
    rows = rows.join(comps, "class")
    counts = rows.groupBy("key", "comp").agg(F.count("*").alias("n"))
    bands = counts.groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("bulk"), F.sum("n").alias("n"), F.max("n").alias("top"), F.count("*").alias("kinds")).where("kinds > 1")
    bands = materialise(bands.select("key", "bulk", "n", F.ceil((F.col("n") - F.col("top")) / SLICE).cast("int").alias("slices"), F.ceil(F.col("n") / SLICE_ROWS).cast("int").alias("parts")), "open")
    if bands.isEmpty():
        return None
    total = bands.agg(F.sum("n")).first()[0]
    rows = materialise(join_counted(rows, bands.withColumnRenamed("n", "held"), ["key"], "held", total), "left")
    own = lambda c: F.pmod(F.xxhash64("class"), F.col(c)).cast("int")
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    few = rows.where("comp <> bulk").select("key", own("slices").alias("slice"), each("parts").alias("part"), F.col("class").alias("u"), F.col("comp").alias("cu"), F.col("fp").alias("fu"), F.col("n").alias("nu"))
    every = rows.select("key", each("slices").alias("slice"), own("parts").alias("part"), F.col("class").alias("v"), F.col("comp").alias("cv"), F.col("fp").alias("fv"), F.col("n").alias("nv"), (F.col("comp") == F.col("bulk")).alias("in_bulk"))
    pairs = few.join(every, ["key", "slice", "part"]).where("cu <> cv and (in_bulk or u > v)").where(possible)
    return pairs.select("u", "v", "cu", "cv").distinct()


def _class_groups(docs: DataFrame, size: int, similarity: float, far_bits: int, n_pivots: int) -> tuple[DataFrame, DataFrame]:
    """The class of every row (doc_id, row_hash, class), and of every class its first row, its rows and its group (class, no, doc_id, row_hash, rows, root).

    Proposals are verified in three steps: every class with the centre that it shares most
    bands with; with the centres of its other bands, unless the first step joined the two; and
    what a band then still holds in different components.
    """
    source = docs.select("doc_id", "text", row_hash("text").alias("row_hash"))
    found = materialise(source.mapInArrow(_sketches(size), _SKETCH), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row_hash")).alias("one")
    classes = found.groupBy("class").agg(F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.count("*").alias("rows"), first)
    classes = materialise(classes.select("class", "fp", "n", "bands", "rows", "one.*"), "classes")
    keyed = classes.select("class", "fp", "n", F.explode("bands").alias("key"))
    tops = materialise(keyed.groupBy("key").agg(F.min(F.struct("class", "fp", "n")).alias("c"), F.count("*").alias("held")).where("held > 1"), "tops")
    held = max(1, tops.agg(F.sum("held")).first()[0] or 0)
    shared = join_counted(keyed, tops, ["key"], "held", held)
    shared = materialise(shared.select("key", "class", "fp", "n", F.col("c.class").alias("low"), F.col("c.fp").alias("fv"), F.col("c.n").alias("nv")), "shared")
    possible = _possible(far_bits, n_pivots, similarity)
    stars = shared.where("class <> low").select(F.col("class").alias("u"), F.col("fp").alias("fu"), F.col("n").alias("nu"), F.col("low").alias("v"), "fv", "nv")
    stars = stars.where(possible).groupBy("u", "v").agg(F.count("*").alias("bands"))
    # Equal fingerprints share a centre, and linked ones join their centres.
    equal = materialise(classes.groupBy("fp").agg(F.min(F.struct("class", "n")).alias("c"), F.count("*").alias("rows")), "centres")
    same = join_counted(classes.select(F.col("class").alias("u"), "fp", F.col("n").alias("nu")), equal.where("rows > 1"), ["fp"], "rows", classes.count())
    same = same.select("u", F.col("fp").alias("fu"), "nu", F.col("c.class").alias("v"), F.col("fp").alias("fv"), F.col("c.n").alias("nv"))
    near = materialise(fingerprint_links(equal.select("fp"), MAX_BITS, n_pivots).select(F.col("u").alias("fu"), F.col("v").alias("fv")), "near")
    named = lambda x: equal.select(F.col("fp").alias(f"f{x}"), F.col("c.class").alias(x), F.col("c.n").alias(f"n{x}"))
    near = near.join(named("u"), "fu").join(named("v"), "fv").select("u", "fu", "nu", "v", "fv", "nv")
    others = materialise(same.unionByName(near).where("u <> v").where(possible).select("u", "v").distinct(), "others")
    wanted = shared.select("class").unionByName(others.select(F.explode(F.array("u", "v")).alias("class"))).distinct().join(classes, "class").select("class", "doc_id", "row_hash")
    texts = source.join(wanted, null_safe(source, wanted, ["doc_id", "row_hash"])).select("class", "text").dropDuplicates(["class"])
    verifier = _Verifier(materialise(texts, "texts"), size, similarity)
    closest = stars.groupBy("u").agg(F.max_by("v", F.struct("bands", "v")).alias("v"))
    closest = materialise(closest.unionByName(others).distinct(), "closest")
    near = verifier.links(closest)
    # Of several links of a class one stands for it here; the components take all of them.
    under = near.groupBy(F.col("u").alias("class")).agg(F.min("v").alias("comp"))
    under = materialise(classes.select("class").join(under, "class", "left").select("class", F.coalesce("comp", "class").alias("comp")), "under")
    centres = tops.select("key", "c.*", "held").join(under.withColumnRenamed("comp", "cv"), "class").select("key", F.col("class").alias("v"), F.col("fp").alias("fv"), F.col("n").alias("nv"), "cv", "held")
    again = classes.join(under, "class").select(F.col("class").alias("u"), F.col("fp").alias("fu"), F.col("n").alias("nu"), F.col("comp").alias("cu"), F.explode("bands").alias("key"))
    rest = join_counted(again, materialise(centres, "band-centres"), ["key"], "held", held).where("u <> v and cu <> cv").where(possible).select("u", "v").distinct()
    rest = rest.join(closest, ["u", "v"], "left_anti")
    links = near.unionByName(verifier.links(materialise(rest, "rest")))
    roots = connected_components(links)
    comps = materialise(classes.select("class").join(roots.withColumnRenamed("node", "class"), "class", "left").select("class", F.coalesce("root", "class").alias("comp")), "comps")
    last = _left_over(shared.select("key", "class", "fp", "n", "low"), comps, possible)
    if last is not None:
        comps = verifier.merged(comps, materialise(last, "last"))
    groups = classes.drop("fp", "n", "bands").join(comps.withColumnRenamed("comp", "root"), "class")
    return found.select("doc_id", "row_hash", "class"), groups


def near_copies(docs: DataFrame, size: int = STAGE_SHINGLE, similarity: float = SIMILARITY, far_bits: int = FAR_BITS, n_pivots: int = PIVOTS) -> DataFrame:
    """Groups of texts linked by a Jaccard similarity of their ``size``-word shingles of at least ``similarity``: doc_id, row_hash, root for every row.

    Fingerprints within three bits, and texts with an equal band of shingle minima, propose
    pairs of different classes of equal word sequences.  Every proposed pair is verified on its
    whole sets of shingles unless others have joined the two before: members of a band meet
    its centre, and what is then still apart in a band meets each other, so proposals grow
    with the rows where groups are alike.  Pairs whose sizes rule the similarity out, or whose
    pivot distances or fingerprints differ by more than ``far_bits``, are discarded first.
    """
    found, groups = _class_groups(docs, size, similarity, far_bits, n_pivots)
    groups = materialise(groups.select("class", "rows", "root"), "groups")
    return join_counted(found, groups, ["class"], "rows", found.count()).select("doc_id", "row_hash", "root")


def drop_near_duplicates(docs: DataFrame, size: int = STAGE_SHINGLE, similarity: float = SIMILARITY, far_bits: int = FAR_BITS, n_pivots: int = PIVOTS) -> DataFrame:
    """One row of each group of ``near_copies``, that of the smallest ``doc_id`` (then of the smallest text hash), with its columns as they are.

    Null, empty and equal texts are copies of one another; a null ``doc_id`` stays only where
    a group has no other; of a row written twice one stays.
    """
    found, groups = _class_groups(docs, size, similarity, far_bits, n_pivots)
    best = groups.groupBy("root").agg(F.min(F.struct("no", "doc_id", "row_hash")).alias("b"))
    doc, hashed, own = (fresh(docs, x) for x in ("best_doc", "best_hash", "own_hash"))
    best = best.select(F.col("b.doc_id").alias(doc), F.col("b.row_hash").alias(hashed))
    kept = docs.withColumn(own, row_hash("text")).join(best, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(hashed)))
    if not found.groupBy("doc_id", "row_hash").count().where("count > 1").isEmpty():  # a row written twice: one of the copies stays
        kept = kept.dropDuplicates([doc, own])
    return kept.select(*docs.columns)
