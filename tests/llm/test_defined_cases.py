"""The pipeline on odd rows, and URL classes against brute force."""

import random
import re

import pytest

from quantloom.llm import url_filter

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, class string, root int, key string, row_hash string, fp double"


def pipeline_tables(spark, folder, rows, benchmark=(), labels=()):
    spark.createDataFrame([(i, t, "en", s, 1, "c", 2, "k", "h", 0.5) for i, t, s in rows], EXTRA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(benchmark), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_takes_odd_rows(spark, tmp_path):
    import corpus_pipeline as P

    r = random.Random(3)
    say = lambda n: " ".join("".join(r.choice("aeionrst") for _ in range(r.randint(2, 7))) for _ in range(n)) + "."
    twice, long = say(80), "\n".join(say(40) for _ in range(800))
    rows = [(None, None, None), (1, None, "s1"), (2, "", "s2"), (None, say(60), "s3"), (5, twice, "s1"), (5, twice, "s1"), (6, twice, None), (7, long, "s4"), *[(10 + i, say(50), f"s{i % 9}") for i in range(20)]]
    sf = pipeline_tables(spark, tmp_path, rows, [(1, say(12)), (2, None), (3, "")], [(10 + i, 1, 0) for i in range(12)] + [(None, 0, 1), (999, 0, 1)])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for k, (name, stage) in enumerate(P.STAGES[:-1]):
        before, docs = docs, stage(spark, docs, sf)
        assert docs.columns == before.columns, name
        docs.write.parquet(f"{sf}/stage{k}")
        docs = spark.read.parquet(f"{sf}/stage{k}")
        got = docs.select("doc_id", "text").collect()
        assert all(t is None or isinstance(t, str) for _, t in got) and docs.count() <= before.count()
        if name.startswith("simhash"):
            assert sum(not t for _, t in got) <= 1 and sum(t == twice for _, t in got) <= 1 and all(d == 5 for d, t in got if t == twice)
    assert any(t == long for _, t in got) and sum(d is not None and d >= 10 for d, _ in got) >= 15
    assert P.STAGES[-1][1](spark, docs, sf).where("length < 1 or length > 1024").count() == 0


def test_pipeline_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline as P

    sf = pipeline_tables(spark, tmp_path, [], [(1, "one two three four five six seven eight nine ten")])
    assert P.run(spark, sf).collect() == []


def brute_verdicts(pages):
    """Host, path and verdict of each page by lists and sets alone."""

    def parts(url):
        rest = (url or "").partition("://")[2] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        tail = rest[len(host) :]
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = re.match(r"[^?#]*", tail)[0]
        node = low + re.match(r"[^#]*", tail if path else "/" + tail)[0] if low else None
        return low, path, node

    def rule(host, path):
        fits = [(len(h) + len(p), len(h), v == "allow", v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[-1] if fits else None

    label = {}

    def top(n):
        while label.setdefault(n, n) != n:
            n = label[n]
        return n

    for url, href in pages:
        a, b = parts(url)[2], parts(href)[2] if href else None
        if a and b and a != b:
            label[top(a)] = top(b)
    fate = {}
    for n in list(label):
        host, path, _ = parts("http://" + n)
        fate.setdefault(top(n), set()).add(rule(host, path))
    out = []
    for url, _ in pages:
        host, path, node = parts(url)
        own = rule(host, path)
        seen = fate.get(top(node), set()) if node in label else set()
        out.append((host, path, own or ("block" if "block" in seen and "allow" not in seen else "allow")))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_url_classes_against_brute_force(spark, seed):
    r = random.Random(seed)
    hosts = ["a.com", "Example.com", "b.example.com", "x.net", "example.net", "y.org", "z.io"]
    paths = ["/en/1", "/en/7", "/en/77?x=1", "/de/1", "/de/8", "/de/88#f", "/es/2", "/fr/", "", "?q", "/"]
    url = lambda: f"{r.choice(('http', 'https'))}://{r.choice(hosts)}{r.choice(paths)}"
    pages = [(url(), url() if r.random() < 0.4 else None) for _ in range(60)]
    pages += [pages[0], (None, url()), ("no scheme", url()), (pages[1][0], pages[2][0]), (pages[2][0], pages[1][0])]
    rows = [(i, u, f'<html><head><link rel="canonical" href="{h}"></head>' if h else "<p>no link") for i, (u, h) in enumerate(pages)]
    got = {x.page_id: (x.host, x.path, x.verdict) for x in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(len(pages))] == brute_verdicts(pages)
