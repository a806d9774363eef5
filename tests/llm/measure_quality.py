"""Decisions of the quality classifier on labels that it was not fitted on: python tests/llm/measure_quality.py [DIR]."""

import sys
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quantloom.llm import quality


def main(folder: str) -> None:
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "6g").config("spark.ui.enabled", "false").getOrCreate()
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    fitted = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)) == 0
    model = quality.fit(docs, labels.where(fitted))
    got = quality.score_documents(docs, model).join(labels.where(~fitted), "doc_id").collect()
    n = Counter(("toxic" if r.toxic else "good" if r.quality else "poor", r.kept) for r in got)
    for kind in ("toxic", "poor", "good"):
        print(f"{kind}: {n[kind, False]} of {n[kind, False] + n[kind, True]} rejected")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
