"""Mixing, clustering and vector codes against plain versions, and their defined cases."""

import hashlib
import math
import random
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from quantloom.llm import clustering, codes, mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, size string, _key int, hash_ string"


def fill(sizes, weights, share, epochs):
    """Targets by exact fractions, one clamping round after the other."""
    total, full, target = Fraction(share * sum(sizes), 100), set(), {}
    while True:
        rest = total - sum(epochs * sizes[i] for i in full)
        w = sum(weights[i] for i in range(len(sizes)) if i not in full)
        target = {i: Fraction(epochs * sizes[i]) if i in full or not w else rest * weights[i] / w for i in range(len(sizes))}
        over = {i for i in target if i not in full and target[i] >= epochs * sizes[i]}
        if not over:
            return target
        full |= over


def documents(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1, "h") for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def mixed(spark):
    r = random.Random(4)
    rows = [(i, " ".join("wörd" for _ in range(r.choice((1, 3, 40, 200)))), r.choice("aaaaaabbcé")) for i in range(300)]
    rows += [(900, "x\t\ny " * 20000, "b"), (901, None, "a"), (902, "", None), (903, " \n", "c"), (None, "p q", None), (None, "p q", None), (904, "one two three", None), (905, None, "nothing")]
    rows += [(7, rows[7][1], rows[7][2])] * 4
    return rows, mixing.mix_sources(documents(spark, rows)).collect()


def test_mixing_matches_exact_water_filling(mixed):
    rows, out = mixed
    size = lambda t: len(WORDS.findall(t or ""))
    names = sorted({s for _, _, s in rows if s is not None}) + [None]
    sizes = [sum(size(t) for _, t, s in rows if s == n) for n in names]
    target = fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], 150, 2)
    taken = defaultdict(int)
    assert len(out) == len(rows) and set(out[0].asDict()) == {"doc_id", "text", "source", "size", "_key", "hash_", "source_size", "target", "taken"}
    for r in out:
        i = names.index(r.source)
        assert r["size"] == size(r.text) and r.source_size == sizes[i] and math.isclose(r.target, float(target[i]), rel_tol=1e-12)
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    for i, n in enumerate(names):
        assert abs(taken[n] - target[i]) <= 4.5, n  # four rows written twice may share the last place
    assert len({r.taken for r in out if r.doc_id == 7}) == 1


def test_mixing_reruns_agree_whatever_the_partitions(spark, mixed):
    rows, out = mixed
    again = mixing.mix_sources(documents(spark, rows[::-1]).repartition(7)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.taken)
    assert [(r.doc_id, r.taken, r.target) for r in sorted(out, key=key)] == [(r.doc_id, r.taken, r.target) for r in sorted(again, key=key)]


def test_mixing_many_sources_clamp_in_several_rounds(spark):
    rows = [(i, "w " * (2**k), f"s{k:02d}") for k in range(12) for i in range(3)]
    out = {r.source: (r.source_size, r.target) for r in mixing.mix_sources(documents(spark, rows), weights=(9, 3, 1)).collect()}
    names = sorted(out)
    target = fill([out[n][0] for n in names], [(9, 3, 1)[i % 3] for i in range(12)], 150, 2)
    assert all(math.isclose(out[n][1], float(target[i]), rel_tol=1e-12) for i, n in enumerate(names))
    assert any(t == 2 * s for s, t in out.values()) and any(t < 2 * s for s, t in out.values())


def test_mix_itself_has_the_words_it_counts(spark, mixed):
    rows, _ = mixed
    plan = mixing.mix_sources(documents(spark, rows))
    copies = mixing.repeat_documents(plan)
    assert copies.select(mixing.n_words("text").alias("n")).groupBy().sum("n").first()[0] == plan.groupBy().sum("taken").first()[0]


def test_mixing_empty(spark):
    assert mixing.mix_sources(documents(spark, [])).collect() == []
    out = mixing.mix_sources(documents(spark, [(1, None, None), (2, " ", "a")])).collect()
    assert [(r["size"], r.source_size, r.target, r.taken) for r in out] == [(0, 0, 0.0, 0)] * 2


VEC = "vec_id long, embedding array<float>, label int, cluster string, v int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, l, "x", 1) for i, e, l in rows], VEC)  # noqa: E741


def ints(e, scale):
    return [math.floor(float(np.float32(x)) * scale) for x in e]


def far(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


@pytest.fixture(scope="module")
def cloud():
    r = np.random.default_rng(3)
    centres = r.normal(size=(5, 64)) * 0.3
    rows = [(i, (centres[i % 5] + r.normal(size=64) * 0.1).astype(np.float32).tolist(), int(i % 3)) for i in range(240)]
    rows += [(1000 + i, rows[3][1], None) for i in range(60)]  # a group of copies
    odd = list(rows[0][1])
    rows += [(2000, None, 1), (2001, [], 1), (2002, odd[:63], 1), (2003, [None, *odd[1:]], 1), (2004, [float("nan"), *odd[1:]], 1), (2005, [float("-inf"), *odd[1:]], None), (None, odd, None), (5, rows[5][1], 2), (5, rows[5][1], 2)]
    return rows


def good(e):
    return e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)


def plain_means(x, start, rounds):
    centres = [list(c) for c in start]
    for r in range(rounds + 1):
        near = [min(range(len(centres)), key=lambda k: (far(v, centres[k]), k)) for v in x]
        if r == rounds:
            return centres, near
        for k in range(len(centres)):
            own = [v for v, n in zip(x, near, strict=True) if n == k]
            if own:
                centres[k] = [sum(c) // len(own) for c in zip(*own, strict=True)]


def test_clusters_match_plain_rounds(spark, cloud):
    kept = [(i, ints(e, 1024)) for i, e, _ in cloud if good(e)]
    drawn = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:8]
    centres, near = plain_means([v for _, v in kept], [v for _, v in drawn], 10)
    dist = [far(v, centres[n]) for (_, v), n in zip(kept, near, strict=True)]
    want = sorted(repr((i, n, d, sum(b for a, b in zip(near, dist, strict=True) if a == n), sum(dist), hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest())) for (i, _), n, d in zip(kept, near, dist, strict=True))
    out = clustering.cluster_vectors(vectors(spark, cloud).repartition(5)).collect()
    assert sorted(repr(tuple(r)) for r in out) == want


def test_bounds_spare_scans_and_change_nothing():
    r = np.random.default_rng(8)
    x = np.concatenate([r.integers(-9, 9, (400, 64)) + 40 * k for k in range(4)]).astype(np.int64)
    x = np.concatenate([x, x[:50]])
    centres = x[[0, 1, 450, 900, 1300]].copy()
    near, best, second = clustering.nearest_two(x, centres)
    upper, lower = np.sqrt(best.astype(float)) * (1 + 1e-12), np.sqrt(second.astype(float)) * (1 - 1e-12)
    scans = 0
    for _ in range(6):
        new = np.array([x[near == k].sum(0) // max(1, (near == k).sum()) if (near == k).any() else centres[k] for k in range(5)])
        drift = np.sqrt(clustering.squares(new, centres).astype(float)) * (1 + 1e-12)
        centres = new
        scans += clustering.reassign(x, near, upper, lower, centres, drift)
        assert (near == clustering.nearest_two(x, centres)[0]).all()
    assert scans < 6 * len(x) / 2


def test_clusters_with_few_or_no_vectors(spark, cloud):
    assert clustering.cluster_vectors(vectors(spark, [])).collect() == []
    out = clustering.cluster_vectors(vectors(spark, cloud[:3])).collect()
    assert {r.cluster for r in out} == {0, 1, 2} and {r.distance for r in out} == {0}
    equal = [(i, cloud[0][1], 1) for i in range(20)]
    assert {r.cluster for r in clustering.cluster_vectors(vectors(spark, equal)).collect()} == {0}


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        clustering.cluster_vectors(vectors(spark, [(1, [1e30] * 64, 1)])).collect()


def test_codes_match_plain_rounds(spark, cloud):
    kept = [(i, l, ints(e, 4096)) for i, e, l in cloud if good(e)]  # noqa: E741
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:16]
    index, error, books = [[] for _ in kept], [0] * len(kept), []
    for p in range(8):
        cut = [v[8 * p : 8 * p + 8] for _, _, v in kept]
        centres, near = plain_means(cut, [v[8 * p : 8 * p + 8] for _, _, v in first], 6)
        books += [x for c in centres for x in c]
        for j, n in enumerate(near):
            index[j].append(n)
            error[j] += far(cut[j], centres[n])
    label = defaultdict(int)
    for (_, l, _), e in zip(kept, error, strict=True):  # noqa: E741
        label[l] += e
    digest = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    want = sorted(repr((i, "".join(f"{n:02x}" for n in ix), e, label[l], digest)) for (i, l, _), ix, e in zip(kept, index, error, strict=True))  # noqa: E741
    out = codes.compress_vectors(vectors(spark, cloud).repartition(5)).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    assert sorted(repr(tuple(r)) for r in out) == want


def test_partial_distance_search_is_exact_with_ties():
    r = np.random.default_rng(1)
    for _ in range(20):
        x, book = r.integers(-3, 3, (200, 8)), r.integers(-3, 3, (16, 8))
        book[9] = book[2]
        every = ((x[:, None] - book[None]) ** 2).sum(2)
        index, best = codes.nearest_entry(x, book)
        assert (index == every.argmin(1)).all() and (best == every.min(1)).all()


def test_codes_with_few_or_no_vectors(spark, cloud):
    assert codes.compress_vectors(vectors(spark, [(1, None, 2)])).collect() == []
    out = codes.compress_vectors(vectors(spark, cloud[:2])).collect()
    assert {r.error for r in out} == {0} and {r.code for r in out} == {"00" * 8, "01" * 8}
