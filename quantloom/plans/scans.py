"""Scans and sinks S01-S15."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantloom import sources as S
from quantloom.sources import commits as C
from quantloom.plans.base import query, table


@query("s01_projected_scan", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 45")
def s01(spark, sf):
    return S.read_table(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_quantity"]).where("l_quantity > 45")


@query("s01_missing_path", "SELECT l_orderkey FROM lineitem WHERE false")
def s01b(spark, sf):
    return S.read_table(spark, f"{sf}/no_such.parquet", schema="l_orderkey long")


@query("s02_directory_union", "SELECT s_suppkey AS id, s_acctbal AS bal, NULL::VARCHAR AS c_mktsegment FROM supplier UNION ALL SELECT n_nationkey, NULL, n_name FROM nation")
def s02(spark, sf):
    got = S.read_directory(spark, [f"{sf}/supplier.parquet", f"{sf}/nation.parquet"])
    return got.select(F.coalesce(F.col("s_suppkey"), F.col("n_nationkey").cast("long")).alias("id"), F.col("s_acctbal").alias("bal"), F.col("n_name").alias("c_mktsegment"))


@query("s03_available_columns", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'")
def s03(spark, sf):
    return S.read_table(spark, f"{sf}/orders.parquet", ["o_orderkey", "absent", "o_orderstatus"]).where("o_orderstatus = 'P'")


@query("s04_footer_metadata", "SELECT column_name AS \"column\", row_number() OVER () - 1 AS place, (SELECT count(*) FROM lineitem) AS n FROM (DESCRIBE lineitem)")
def s04(spark, sf):
    """Columns from the schema, rows from the footers of the files: no column is read."""
    path = f"{sf}/lineitem.parquet"
    rows = C.file_statistics(spark, path).agg(F.sum("rows").alias("n"))
    return C.columns_of(spark.read.parquet(path)).join(F.broadcast(rows), how="cross").select("column", F.col("place").cast("long").alias("place"), "n")


@query("s06_append_distinct", "SELECT o_orderkey, o_custkey, o_totalprice, year(o_orderdate)::BIGINT AS year FROM orders")
def s06(spark, sf):
    """A table by years gets rows it has and rows it has not, twice, and holds each once."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").cast("long").alias("year"))
    path = S.scratch_path(spark, "appended")
    for part in ("o_orderkey % 10 < 7", "o_orderkey % 10 >= 4", "o_orderkey % 10 >= 4"):
        out = C.append_distinct(spark, path, o.where(part), ["year"])
    return out.select("o_orderkey", "o_custkey", "o_totalprice", F.col("year").cast("long").alias("year"))


@query("s08_small_file_union", "SELECT 'customers' AS unit, c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT 'suppliers', s_suppkey, s_name FROM supplier UNION ALL SELECT 'nations', n_nationkey, n_name FROM nation")
def s08(spark, sf):
    """Folders of many small files, two of other types, become one table each; a second run finds nothing to do."""
    from functools import reduce

    path, out, manifest = (S.scratch_path(spark, x) for x in ("small", "compacted", "manifest"))
    sources = {"customers": ("customer", "c_custkey", "c_name"), "suppliers": ("supplier", "s_suppkey", "s_name"), "nations": ("nation", "n_nationkey", "n_name")}
    folders = {}
    for name, (source, k, text) in sources.items():
        t = table(spark, sf, source, k, text).select(F.col(k).cast("long").alias("k"), F.col(text).alias("name"))
        folders[name] = [f"{path}/{name}/{i}" for i in range(2)]
        t.where("k % 2 = 0").repartition(4).write.parquet(folders[name][0])
        t.where("k % 2 = 1").withColumn("k", F.col("k").cast("int")).repartition(4).write.parquet(folders[name][1])
    first, second = (C.compact(spark, folders, out, manifest, run) for run in ("one", "two"))
    if second.count() or first.count() != len(folders):
        raise ValueError("a folder was compacted twice, or not at all")
    parts = [spark.read.parquet(f"{out}/{name}").select(F.lit(name).alias("unit"), F.col("k").cast("long").alias("k"), "name") for name in folders]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("s09_month_partitions", "SELECT o_orderkey, year(o_orderdate)::BIGINT AS year, month(o_orderdate)::BIGINT AS month FROM orders WHERE year(o_orderdate) = 1997")
def s09(spark, sf):
    o = S.by_month(table(spark, sf, "orders", "o_orderkey", "o_orderdate"), "o_orderdate").where("year = 1997")
    return o.select("o_orderkey", F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"))


@query("s10_reference_loader", "SELECT o_custkey AS code, CAST(o_orderdate AS DATE) + 1 AS usable, o_totalprice AS weight FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')")
def s10(spark, sf):
    o = table(spark, sf, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW"))
    return o.select(F.col("o_custkey").alias("code"), F.date_add(F.col("o_orderdate").cast("date"), 1).alias("usable"), F.col("o_totalprice").alias("weight"))


@query("s11_resume", "SELECT doc_id, coalesce(source, '__null__') AS source, length(coalesce(text, '')) AS n, CASE WHEN source < 'src15' THEN 'first' ELSE 'second' END AS run FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def s11(spark, sf):
    """Documents without a label, by source: a run that ends early, and one that goes on with the sources that are left."""
    docs = S.pending(table(spark, sf, "documents", "doc_id", "source", "text"), table(spark, sf, "labels"), "doc_id")
    out, manifest = S.scratch_path(spark, "units"), S.scratch_path(spark, "manifest")
    work = lambda df: df.select("doc_id", "source", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n"))
    C.process_units(docs.where("source < 'src15'"), "source", work, out, manifest, "first")
    for _ in range(2):  # the second time there is nothing left
        C.process_units(docs, "source", work, out, manifest, "second")
    runs = C.finished(spark, manifest).select(F.col("unit").alias("source"), "run")
    return spark.read.parquet(out).select("doc_id", F.col("source").cast("string").alias("source"), "n").join(F.broadcast(runs), "source")


@query("s05_parquet_sink", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'")
def s05(spark, sf):
    path = S.scratch_path(spark, "sink")
    S.write_table(table(spark, sf, "orders").where("o_orderstatus = 'P'").select("o_orderkey", "o_totalprice"), path)
    return spark.read.parquet(path)


@query("s07_split_sink", "SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def s07(spark, sf):
    path = S.scratch_path(spark, "split")
    S.split_table(table(spark, sf, "orders", "o_orderstatus", "o_totalprice"), path, "o_orderstatus")
    return spark.read.parquet(path).groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("s12_report_lines", """WITH c AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)
SELECT 0 AS line, '| o_orderstatus | n |' AS content UNION ALL SELECT 1, '| - | - |' UNION ALL SELECT (row_number() OVER (ORDER BY o_orderstatus) + 1)::INTEGER, '| ' || o_orderstatus || ' | ' || n || ' |' FROM c""")
def s12(spark, sf):
    counts = table(spark, sf, "orders", "o_orderstatus").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return C.markdown(counts, ["o_orderstatus"])


@query("s12_report_json", "SELECT o_orderstatus, '{\"o_orderstatus\":\"' || o_orderstatus || '\",\"n\":' || count(*) || '}' AS content FROM orders GROUP BY 1")
def s12_json(spark, sf):
    path = S.scratch_path(spark, "json")
    counts = table(spark, sf, "orders", "o_orderstatus").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    counts.write.json(path)
    return spark.read.text(path).select(F.get_json_object("value", "$.o_orderstatus").alias("o_orderstatus"), F.col("value").alias("content"))


@query("s14_csv_sink", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def s14(spark, sf):
    path, c = S.scratch_path(spark, "csv"), table(spark, sf, "customer", "c_custkey", "c_name", "c_acctbal")
    S.write_csv(c, path)
    return spark.read.schema(c.schema).option("header", True).csv(path)


@query("s15_model_artifact", "SELECT count(*) AS n, 0::BIGINT AS differ FROM part")
def s15(spark, sf):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression, LinearRegressionModel

    part = table(spark, sf, "part", "p_size", "p_retailprice")
    rows = VectorAssembler(inputCols=["p_size"], outputCol="x").transform(part)
    model, path = LinearRegression(featuresCol="x", labelCol="p_retailprice", predictionCol="before").fit(rows), S.scratch_path(spark, "model")
    S.save_model(model, path)
    again = LinearRegressionModel.load(path).setPredictionCol("after")
    both = again.transform(model.transform(rows))
    return both.agg(F.count("*").alias("n"), F.count_if(F.col("before") != F.col("after")).alias("differ"))
