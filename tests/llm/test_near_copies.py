"""The near-dedup stage: no link of a band is lost, whatever its place in the band."""

import random
import re
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantloom.llm import _spark, simhash
from quantloom.llm._spark import bound_batches


def components(texts, size=5, similarity=0.8):
    sets = [set(simhash.shingle_set(simhash.simhash_words(t), size).tolist()) for t in texts]
    label = list(range(len(texts)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if texts[i] == texts[j] or (both and both >= similarity * (len(a) + len(sets[j]) - both)):
                label[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(texts))]


def families(seed, families=6, members=9, words=120):
    """Groups of texts around one body each: most pairs of a group lie about the threshold, so its bands hold several components."""
    r = random.Random(seed)
    out = []
    for _ in range(families):
        body = [f"w{r.randrange(4000)}" for _ in range(words)]
        for _ in range(members):
            t = list(body)
            for _ in range(r.choice((0, 1, 2, 3))):
                t[r.randrange(words)] = f"x{r.randrange(10**6)}"
            out.append(" ".join(t))
    return out


def partition_of(labels):
    groups = {}
    for i, x in enumerate(labels):
        groups.setdefault(x, []).append(i)
    return sorted(groups.values())


@pytest.mark.parametrize("slice_", (64, 2))
def test_no_link_of_a_band_is_lost(spark, monkeypatch, slice_):
    monkeypatch.setattr(simhash, "SLICE", slice_)
    monkeypatch.setattr(simhash, "SLICE_ROWS", 4096 if slice_ == 64 else 3)
    monkeypatch.setattr(simhash, "MEMBERS", 512 if slice_ == 64 else 3)
    texts = [*families(5), "", "only two", "only two", ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: bytes(r.root) for r in simhash.near_copies(docs).collect()}
    assert partition_of([got[i] for i in range(len(texts))]) == partition_of(components(texts))
    kept = sorted(r.doc_id for r in simhash.drop_near_duplicates(docs).collect())
    assert kept == sorted(g[0] for g in partition_of(components(texts)))


def test_bands_of_the_fixture_hold_links_that_no_centre_has():
    """At least one similar pair of the fixture shares a band of five classes or more in which neither is the least or the greatest."""
    import hashlib

    texts, bands, sets = families(5), {}, {}
    for t in texts:
        words = simhash.simhash_words(t)
        name = hashlib.blake2b(b" ".join(words), digest_size=16).digest()
        sets[name] = set(simhash.shingle_set(words, 5).tolist())
        for key in simhash.minima(simhash.shingle_set(words, 5)).tolist():
            bands.setdefault(key, set()).add(name)
    found = 0
    for names in bands.values():
        order = sorted(names)
        inner = order[1:-1] if len(order) >= 5 else []
        for i, a in enumerate(inner):
            found += sum(len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for b in inner[:i])
    assert found > 0


def test_batches_are_bounded_in_bytes(spark):
    bound_batches(spark, 1000, 1 << 20)

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([b.nbytes], pa.int64())], names=["n", "size"])

    out = spark.range(40).select(F.repeat(F.lit("x"), 300_000).alias("t")).coalesce(1).mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in out) == 40 and max(r["size"] for r in out) < 3 << 20
    assert np.ceil(max(r.n for r in out)) < 40


def test_plans_stay_short(spark, monkeypatch):
    """The driver holds each plan and a few MB for every scan in it: no step of near-dedup or its components scans over 12 tables."""
    scans, write = {}, _spark.materialise

    def seen(df, name):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        scans[name] = max(scans.get(name, 0), len(re.findall(r"Relation \[", plan)))
        return write(df, name)

    for module in (_spark, simhash):
        monkeypatch.setattr(module, "materialise", seen)
    texts = families(5)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    simhash.drop_near_duplicates(docs).count()
    assert {"cc", "others", "rest"} <= set(scans)
    assert max(scans.values()) <= 12


def test_block_keys_are_not_broadcast(spark):
    """The fingerprints are few enough for a broadcast, their sixteen keys are not; which side is small is seen as the plan runs."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        reps = spark.createDataFrame([(i * 0x9E3779B97F4A7C15 % (1 << 63),) for i in range(8_000)], "fp long")
        plan = simhash.fingerprint_links(_spark.materialise(reps, "reps"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize(("grown", "calls"), ((61, 1), (60, 0)))
def test_a_grown_heap_of_the_driver_is_collected(grown, calls):
    made = []
    heap = SimpleNamespace(totalMemory=lambda: grown, maxMemory=lambda: 100)
    lang = SimpleNamespace(Runtime=SimpleNamespace(getRuntime=lambda: heap), System=SimpleNamespace(gc=lambda: made.append(1)))
    _spark.collect_driver(SimpleNamespace(sparkContext=SimpleNamespace(_jvm=SimpleNamespace(java=SimpleNamespace(lang=lang)))))
    assert len(made) == calls
