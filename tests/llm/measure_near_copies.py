"""Recall of the near-dedup stage against exact similarities of all pairs that share a rare enough shingle: python tests/llm/measure_near_copies.py FOLDER."""

import sys
import tempfile
from collections import Counter, defaultdict

from pyspark.sql import SparkSession

from quantloom.llm import simhash


def exact_pairs(texts, size=5, similarity=0.8):
    """Pairs of different classes of at least ``similarity``, by prefix filtering: a pair shares one of the rarest shingles of each."""
    sets = {}
    for i, t in texts:
        words = simhash.simhash_words(t)
        sets.setdefault(b" ".join(words), (i, frozenset(simhash.shingle_set(words, size).tolist())))
    sets = dict(sets.values())
    seen = Counter(x for s in sets.values() for x in s)
    index, out = defaultdict(list), []
    for i, s in sorted(sets.items(), key=lambda x: len(x[1])):
        order = sorted(s, key=lambda x: (seen[x], x))
        prefix = order[: len(order) - int(-(-similarity * len(order) // 1)) + 1]
        for j in {j for x in prefix for j in index[x]}:
            both = len(s & sets[j])
            if both >= similarity * (len(s) + len(sets[j]) - both):
                out.append((i, j))
        for x in prefix:
            index[x].append(i)
    return out


def main(folder):
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    want = exact_pairs([(r.doc_id, r.text) for r in docs.collect()])
    root = {r.doc_id: bytes(r.root) for r in simhash.near_copies(docs).collect()}
    got = sum(root[a] == root[b] for a, b in want)
    print(f"{got} of {len(want)} pairs of different texts joined")
    for a, b in want:
        if root[a] != root[b]:
            print("  apart:", a, b)


if __name__ == "__main__":
    main(sys.argv[1])
