"""Corpus operators against brute force on small fixtures, and their defined cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quantloom.llm import _kernels as K
from quantloom.llm import decontaminate, exact_dedup, html_extract, line_dedup, packing, pii, quality, simhash, substring, url_filter
from quantloom.llm._spark import connected_components, join_counted
from quantloom.llm.queries import tokenizer_path

SPACE = re.compile(r"[\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, n_chars long, row_hash string, anchor int"


def words(t):
    return [w for w in SPACE.split(t or "") if w]


def texts(seed=1, n=40):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 6))) for _ in range(60)]
    say = lambda k: " ".join(r.choice(vocab) for _ in range(k))
    shared = [say(k) for k in (20, 35, 36, 80)]
    out = [None, "", " \t\n", "one", "na " * 120, "na " * 34, say(34), say(3000)]
    while len(out) < n:
        t = say(r.randint(1, 150))
        for s in shared:
            if r.random() < 0.3:
                t = f"{t} {s}\n{say(r.randint(0, 9))}"
        out.append(t)
    return [*out, out[-1], out[-2] + " end", out[-3].upper()]


def frame(spark, rows):
    """Rows with extra columns whose names clash with those the operators make."""
    return spark.createDataFrame([(i, t, f"s{(i or 0) % 9}", len(t or ""), "x", 1) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def corpus():
    t = texts()
    return [*enumerate(t), (5, t[5]), (None, t[9])]  # a repeated row, and one without id


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return frame(spark, corpus)


def test_word_kernel_matches_a_regex():
    import pyarrow as pa

    t = texts(3, 20)
    data, at = K.texts(pa.array(t))
    starts, ends, first = K.words(data, at)
    got = [[bytes(data[starts[i] : ends[i]]).decode() for i in range(first[r], first[r + 1])] for r in range(len(t))]
    assert got == [words(x) for x in t]
    h = K.word_hashes(data, starts, ends)
    assert len(set(h.tolist())) == len({w for x in t for w in words(x)})


def test_substring_against_brute_force(spark, docs, corpus):
    n = Counter()
    split = [words(t) for _, t in corpus]
    for w in split:
        n.update(tuple(w[i : i + 35]) for i in range(len(w) - 34))
    want = []
    for (i, _), w in zip(corpus, split, strict=True):
        hit = {p for k in range(len(w) - 34) if n[tuple(w[k : k + 35])] > 1 for p in range(k, k + 35)}
        kept = [x for p, x in enumerate(w) if p not in hit]
        want.append((i, len(w), len(hit), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    got = [tuple(r)[:4] for r in substring.remove_repeats(docs).collect()]
    assert Counter(got) == Counter(want)
    crowded = substring.repeated_windows(docs, crowd=1).selectExpr("doc_id", "row_hash", "explode(sequence(pos, pos + n - 1)) AS p").distinct().collect()
    assert set(map(tuple, crowded)) == set(map(tuple, substring.repeated_windows(docs).selectExpr("doc_id", "row_hash", "explode(sequence(pos, pos + n - 1)) AS p").distinct().collect()))
    assert substring.remove_repeats(docs.limit(0)).collect() == []


def test_crowded_anchors_give_few_rows(spark, monkeypatch):
    """400 near copies of 100 words with a word of their own each: their anchors are crowded, and no table holds a row for each of their windows."""
    r = random.Random(11)
    base = [f"b{i}" for i in range(100)]
    docs = []
    for i in range(400):
        w = list(base)
        w[r.randrange(100)] = f"own{i}"
        docs.append((i, " ".join(w)))
    made, write = [], substring.materialise
    monkeypatch.setattr(substring, "materialise", lambda df, name: made.append((name, write(df, name))) or made[-1][1])
    found = substring.repeated_windows(spark.createDataFrame(docs, "doc_id long, text string"), crowd=16)
    n = Counter(tuple(w.split()[k : k + 35]) for _, w in docs for k in range(66))
    want = {(i, k) for i, w in docs for k in range(66) if n[tuple(w.split()[k : k + 35])] > 1}
    assert {(x.doc_id, x.p) for x in found.selectExpr("doc_id", "explode(sequence(pos, pos + n - 1)) AS p").collect()} == want
    phrases = next(df.count() for name, df in made if name == "segments")
    assert phrases > 400
    assert max(df.count() for name, df in made if name not in ("phrases", "met")) <= 2 * phrases


def test_words_of_equal_hash_are_told_apart(spark):
    """Two words of 1,024 letters whose polynomial hashes modulo 2**64 agree whatever the base (Thue-Morse)."""
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    one, two = ("".join("ab"[b ^ f] for b in bits) for f in (0, 1))
    w = [f"w{i}" for i in range(20)]
    docs = [(1, " ".join([*w, one, *w])), (2, " ".join([*w, two, *w]))]
    data = np.frombuffer(f"{one} {two}".encode(), np.uint8)
    starts, ends, _ = K.words(data, np.array([0, len(data)]))
    assert len(set(K.word_hashes(data, starts, ends).tolist())) == 1
    got = substring.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert [r.n_removed for r in got] == [0, 0]


def test_longest_matches_against_brute_force():
    r = random.Random(7)
    x = [r.choice((1, 2)) for _ in range(120)] + [-1] + [r.choice((1, 2, 3)) for _ in range(60)] + [-2]

    def common(i, j):
        n = 0
        while max(i, j) + n < len(x) and x[i + n] == x[j + n] and n < 16:
            n += 1
        return n

    want = [max(common(i, j) for j in range(len(x)) if j != i) for i in range(len(x))]
    assert np.minimum(substring.longest_matches(np.array(x), 9), 16).tolist() == want


def brute_fingerprint(t):
    w = [x for x in SPACE.split((t or "").translate({c: c + 32 for c in range(65, 91)})) if x]
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_against_brute_force(spark, docs, corpus):
    fp = [brute_fingerprint(t) for _, t in corpus]
    comp = list(range(len(fp)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in range(len(fp)):
        for b in range(a):
            if (fp[a] ^ fp[b]).bit_count() <= 3:
                comp[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(corpus):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    want = Counter((i, f"{fp[k]:016x}", least[find(k)]) for k, (i, _) in enumerate(corpus))
    assert Counter(map(tuple, simhash.near_duplicates(docs).collect())) == want
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def shingles_of(t):
    w = [x for x in SPACE.split((t or "").translate({c: c + 32 for c in range(65, 91)})) if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_groups(rows, least=0.8):
    """Components of (doc_id, text) rows by Jaccard similarity, texts without words being equal: index of a representative for each row."""
    sets = [shingles_of(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] == sets[b] or len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                comp[find(a)] = find(b)
    return [find(k) for k in range(len(rows))]


def near_texts():
    r = random.Random(21)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(500)]
    out = [None, "", " ", "a b c", "a b c", "A  b\nc", "a b d"]
    for _ in range(25):
        base = [r.choice(vocab) for _ in range(r.randint(60, 400))]
        out.append(" ".join(base))
        for _ in range(r.randint(1, 6)):
            w = list(base)
            for _ in range(r.randint(1, max(1, len(w) // 60))):
                w[r.randrange(len(w))] = r.choice(vocab)
            out.append(" ".join(w))
    return out


def test_near_copies_against_brute_force(spark):
    rows = [*enumerate(near_texts()), (None, "a b c"), (9, near_texts()[9]), (None, "by itself")]
    clash = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, class int, best_doc int, own_hash int")
    groups = brute_groups(rows)
    want = {}
    for k, (i, _) in enumerate(rows):
        want.setdefault(groups[k], []).append(i)
    kept = simhash.drop_near_duplicates(clash)
    assert kept.columns == clash.columns
    best = lambda ids: min((i is None, i or 0) for i in ids)
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == Counter(best(ids) for ids in want.values())
    roots = Counter(bytes(r.root) for r in simhash.near_copies(clash).collect())
    assert sorted(roots.values()) == sorted(map(len, want.values()))
    assert simhash.drop_near_duplicates(clash.limit(0)).collect() == []


def test_links_of_near_fingerprints_in_slices(spark):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(30)]
    fps = sorted({b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 3))) for b in base for _ in range(12)})
    comp = {f: f for f in fps}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= 3:
                comp[find(b)] = find(a)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    reps = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    for slice_rows in (4, 4096):
        roots = {r.node: r.root for r in connected_components(simhash.fingerprint_links(reps, slice_rows=slice_rows)).collect()}
        got = [roots.get(signed(f), signed(f)) for f in fps]
        want = [find(f) for f in fps]
        assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_components_of_long_chain(spark):
    e = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(e, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[101] == got[100] == 100


def test_lines_with_and_without_sites(spark):
    rows = [(i, f"own line {i}\nshared by all\n\n nine sites \nrest {i}", f"s{i}", 9, "x", 1) for i in range(9)]
    rows += [(20, "nine sites\nfew", "s1", 9, "x", 1), (21, "few", None, 9, "x", 1), (22, None, "s3", None, "x", 1), (23, "", None, 0, "x", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in line_dedup.remove_boilerplate(docs, min_sites=8).collect()}
    assert got[0].text == rows[0][1] and got[0].n_removed == 0
    assert got[3].text == "own line 3\n\nrest 3" and got[3].n_chars == len(got[3].text) and got[3].n_removed == 2
    assert got[20].text == "few" and got[21].text == "few" and got[22].text is None and got[23].text == ""
    edge = {r.doc_id: r.n_removed for r in line_dedup.remove_boilerplate(docs, min_sites=9).collect()}
    assert edge[3] == 2 and edge[20] == 1
    assert sum(r.n_removed for r in line_dedup.remove_boilerplate(docs, min_sites=10).collect()) == 0
    assert line_dedup.remove_boilerplate(docs.limit(0)).collect() == []


def test_url_rules_and_aliases(spark):
    link = lambda u: f'<head><link rel="canonical" href="{u}"></head>'
    pages = [
        (1, "http://a.Example.com/en/5?x#y", None),
        (2, "https://example.com/en/77", None),
        (3, "http://x.net/de/8", None),
        (4, "http://m.example.net/de/81", None),
        (5, None, None),
        (6, "no scheme/en/", "<p>"),
        (7, "http://alias.info/1", link("http://b.com/en/1")),
        (8, "http://alias.info/2", '<meta http-equiv="refresh" content="0; url=http://alias.info/1">'),
        (9, "http://alias.info/3", link("http://example.com/en/7") + link("http://b.com/en/9")),
        (10, "http://notcom/en/", ""),
        (11, "http://alias.info/4#f", link("/2")),
    ]
    got = {r.page_id: r for r in url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    verdict = {k: (r.rule, r.verdict) for k, r in got.items()}
    assert verdict[1] == ("com/en/", "block") and got[1].host == "a.example.com" and got[1].path == "/en/5"
    assert verdict[2] == ("example.com/en/7", "allow") and verdict[3] == ("net/de/", "allow") and verdict[4] == ("example.net/de/8", "block")
    assert verdict[5] == (None, "allow") and got[5].host == "" and verdict[6] == (None, "allow") and verdict[10] == (None, "allow")
    assert [verdict[k][1] for k in (7, 8, 9, 11)] == ["block", "block", "allow", "block"]
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_expectation_maximisation_finds_the_worse_labeller():
    r = np.random.default_rng(3)
    truth = r.random(4000) < 0.3
    votes = [np.where(r.random(4000) < a, truth, ~truth) + 1 for a in (0.95, 0.9, 0.6)]
    prior, table = quality.expectation_maximisation(Counter(zip(*[v.tolist() for v in votes], strict=True)), [0.8] * 3, prior=0.4)
    right = [table[j, 1, 2] for j in range(3)]
    assert right[0] > right[2] and right[1] > right[2] and abs(prior - 0.3) < 0.05


def test_quality_on_held_out_rows(spark):
    r = random.Random(2)
    vocab = ["".join(r.choice("aeiostrnl") for _ in range(r.randint(2, 8))) for _ in range(400)]
    say = lambda k: " ".join(r.choice(vocab) for _ in range(k)).capitalize() + "."
    rows, labels = [], []
    for i in range(600):
        kind = i % 6
        t = " ".join(say(r.randint(4, 14)) for _ in range(r.randint(3, 9)))
        if kind == 1:
            t = " ".join(w + r.choice(["%%%", "&&&"]) for w in t.split())
        elif kind == 2:
            t = t.replace(". ", f". {r.choice(['blorg', 'zworp'])} {r.choice(['grux' + w for w in vocab])} gruxly ")
        rows.append((i, t, "s", len(t), "x", 1))
        if i < 400:
            labels.append((i, 0 if kind == 1 else 1, 1 if kind == 2 else 0))
    docs = spark.createDataFrame([*rows, (900, None, "s", 0, "x", 1), (901, "", "s", 0, "x", 1)], DOCS)
    model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {x.doc_id: x.kept for x in quality.score_documents(docs, model).collect()}
    wrong = sum(got[i] != (i % 6 not in (1, 2)) for i in range(400, 600))
    assert wrong <= 6 and got[900] is not None and got[901] is not None
    assert quality.keep_good(docs, model).columns == docs.columns
    plain = quality.fit(docs, None)
    assert quality.score_documents(docs.limit(0), plain).collect() == []


def test_relative_links_are_resolved_against_the_page(spark):
    hrefs = {"index.html": "a.b/x/index.html", "./q": "a.b/x/q", "../r": "a.b/r", "?id=3": "a.b/x/y?id=3", "/s": "a.b/s", "//c.d/t": "c.d/t", "http://e.f/u": "e.f/u", "mailto:x": None}
    pages = [("https://a.b/x/y", f'<link rel="canonical" href="{h}">') for h in hrefs]
    got = url_filter.page_links(spark.createDataFrame(pages, "url string, html string")).collect()
    assert sorted(r["target"].partition("://")[2] for r in got) == sorted(t for t in hrefs.values() if t)


@pytest.mark.parametrize(
    ("attributes", "hidden"),
    [(' style="overflow:hidden"', False), (' href="/hidden/x"', False), (" href=/hidden", False), (' title="The hidden cost"', False), (' class="hidden"', False), (' data-hidden="1"', False), (' title="aria-hidden=true"', False), (' data-x="display:none"', False), (' style="--display:none"', False), (' aria-hidden="false"', False), (' title="a > hidden b"', False)]
    + [(" hidden", True), (' id="a"hidden', True), (" HIDDEN=''", True), (' hidden="until-found"/', True), (" aria-hidden=true", True), (' style="color:red; Display : none"', True), (" style=display:none", True), (' style="display:none !important;"', True)],
)
def test_only_hidden_elements_are_dropped(attributes, hidden):
    page = f"<body><article><p>One.</p><div{attributes}><p>Two.</p></div><p>Three.</p></article></body>"
    assert [b.text for b in html_extract.blocks_of(page)] == (["One.", "Three."] if hidden else ["One.", "Two.", "Three."])


def test_formulas_are_part_of_their_line():
    page = "<p>Let <math><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow></math> be given.</p>"
    assert [b.text for b in html_extract.blocks_of(page)] == ["Let x=2 be given."]


def test_lines_go_on_behind_scripts_and_fields():
    page = "<p>One <script>x('</p>')</script>two <select><option>no</option></select>three <textarea>no</textarea>four.</p><p>Five.</p>"
    assert [b.text for b in html_extract.blocks_of(page)] == ["One two three four.", "Five."]


def test_open_quotes_and_deep_pages_take_linear_time():
    import time

    began = time.time()
    assert html_extract.blocks_of("<a '<a \"" * 120_000 + "<p>End.</p>")[-1].text == "End."
    assert html_extract.blocks_of('<p>Start.</p>' + '<a "' * 250_000)[0].text == "Start."
    assert len(html_extract.blocks_of("<div>x" * 60_000)) == 60_000
    assert len(html_extract.blocks_of("<b>" * 60_000 + "<p>x</p></span>" * 20_000)) == 20_000
    assert time.time() - began < 20


#: Pages in the manner of common publishing tools, and their article.
PAGES = [
    ("""<!doctype html><html><head><title>Tides</title></head><body class="single post"><div id="page"><header id="masthead" class="site-header"><a href="/">The Coast</a><nav id="site-navigation" class="main-navigation"><ul id="menu"><li><a href="/a">Home</a></li><li><a href="/b">About</a></li></ul></nav></header>
<div id="content" class="site-content"><main id="main"><article id="post-7" class="post"><h1 class="entry-title">Why tides come twice</h1><div class="entry-content"><p>The moon pulls the near side of the sea more strongly than the far side.</p><p>So there are <em>two</em> bulges,&nbsp;and the earth turns beneath both.</p><blockquote><p>Time and tide wait for no man.</p></blockquote></div></article></main>
<aside id="secondary" class="widget-area"><h2>Recent posts</h2><ul><li><a href="/x">Sand</a></li><li><a href="/y">Salt</a></li></ul></aside></div><footer id="colophon" class="site-footer">&copy; The Coast</footer></div></body></html>""",
     ["Why tides come twice", "The moon pulls the near side of the sea more strongly than the far side.", "So there are two bulges, and the earth turns beneath both.", "Time and tide wait for no man."]),
    ("""<html><body><div class="cookie-banner"><p>We use cookies to improve this site.</p><button>Accept</button></div><div class="topbar"><a href="/">News</a> <a href="/sport">Sport</a></div><div class="story"><h1>Bridge opens after nine years</h1><p>The bridge over the river opened on Monday, nine years after work began.</p><div class="advert"><p>Buy our umbrellas today!</p></div><p>Traffic was light in the morning, the mayor said.</p></div>
<div class="comments"><h3>Comments</h3><p>About time too!</p></div><div class="footer"><a href="/imprint">Imprint</a></div></body></html>""",
     ["Bridge opens after nine years", "The bridge over the river opened on Monday, nine years after work began.", "Traffic was light in the morning, the mayor said."]),
]


@pytest.mark.parametrize("k", range(len(PAGES)))
def test_pages_of_other_makers(k):
    page, want = PAGES[k]
    assert html_extract.main_text(html_extract.default_model(), page) == "\n\n".join(want)


def test_packing_fills_sequences_with_many_pieces_over_half(spark):
    r = random.Random(11)
    sizes = [r.choice((1024, r.randint(513, 1023), r.randint(20, 512))) for _ in range(6000)]
    rows = packing.pack(spark.createDataFrame(list(enumerate(sizes)), "doc_id long, length long"), partitions=1).collect()
    assert sorted(x["length"] for x in rows) == sorted(sizes)
    held = {}
    for x in rows:
        held.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for parts in held.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False)) and sum(parts[-1]) <= 1024
    assert sum(n > 512 for n in sizes) > 10 * packing.OPEN_BINS
    assert len(held) <= 1.02 * max(sum(sizes) / 1024, sum(n > 512 for n in sizes))


def test_packing_ids_and_bounds(spark, docs, corpus):
    from tokenizers import Tokenizer

    path = tokenizer_path()
    plain = Tokenizer.from_file(path)
    extra = [(70, "a  b \n c <|endoftext|> don't  "), (71, "word " * 1500), (72, "tab\there  x")]
    rows = packing.pack_documents(frame(spark, [*corpus, *extra]), path, with_ids=True).collect()
    want = Counter()
    for i, t in [*corpus, *extra]:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or min(len(ids), 1024)
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 1024
    assert packing.pack_documents(frame(spark, corpus).limit(0), path).collect() == []


def test_open_bins_close_the_fullest():
    b = packing.OpenBins(10, 2)
    assert [b.put(6), b.put(7), b.put(8)] == [(0, 0), (1, 0), (2, 0)]  # the bin with 3 free closes
    assert b.put(2) == (2, 8) and b.put(4) == (0, 6)


def brute_overlaps(docs, bench, window=10):
    low = str.maketrans({c: c + 32 for c in range(65, 91)})
    split = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(low)) if w]
    wins = {}
    for item, t in bench:
        w = split(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = Counter()
    for i, t in docs:
        w, hit, items = split(t), set(), set()
        for n in {len(k) for k in wins}:
            for a in range(len(w) - n + 1):
                if found := wins.get(tuple(w[a : a + n])):
                    hit |= set(range(a, a + n))
                    items |= found
        out[(i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit))] += 1
    return out


@pytest.mark.parametrize("block_words", [30, 400_000])
def test_decontamination_against_brute_force(spark, corpus, block_words):
    bench = [(1, texts()[10]), (2, "Na na, na!"), (3, None), (4, ""), (5, " ".join(texts()[7].split()[50:75])), (6, "one"), (10, "na na na")]
    plain = [(i, t) for i, t in corpus if i is not None]
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = decontaminate.contamination_report(frame(spark, plain), b, block_words=block_words)
    assert Counter(tuple(r)[:6] for r in got.collect()) == brute_overlaps(plain, bench)
    cut = decontaminate.decontaminate(frame(spark, plain), b, block_words=block_words)
    assert cut.columns == frame(spark, plain).columns
    after = decontaminate.contamination_report(cut, b.where("item_id = 5"), block_words=block_words)
    assert after.where("contaminated").count() == 0
    assert decontaminate.contamination_report(frame(spark, plain), b.limit(0)).where("contaminated").count() == 0


def test_decontamination_does_not_depend_on_the_blocks(spark):
    w = [f"w{i}" for i in range(200)]
    bench = [(1, " ".join(w[:12])), (2, " ".join(w[12:24])), (3, " ".join(w[60:75])), (4, " ".join(w[68:83])), (5, " ".join([*w[100:105], *w[117:122]]))]
    plain = [
        (1, " ".join(w[:40])),  # two items of 12 words each: 24 of 40, over half only together
        (2, " ".join(w[50:130])),  # spans of two items overlap
        (3, " ".join([*w[100:105], *w[60:75], *w[117:122], *w[150:190]])),  # the words beside a cut are no window
        (4, None), (2, " ".join(w[50:130])), (None, " ".join(w[50:130])),
    ]
    b = spark.createDataFrame(bench, "item_id long, text string")
    one, many = (Counter(map(tuple, decontaminate.decontaminate(frame(spark, plain), b, block_words=n).collect())) for n in (400_000, 15))
    assert many == one
    left = {r[0]: r[1] for r in one}
    assert 1 not in left and left[2] == " ".join([*w[50:60], "", *w[83:130]]) and left[3] == " ".join([*w[100:105], "", *w[117:122], *w[150:190]])


def test_automaton_matches_longest_suffix():
    r = random.Random(4)
    a = decontaminate.Automaton(3)
    items = [[r.choice("abc").encode() for _ in range(r.randint(1, 12))] for _ in range(8)]
    for k, w in enumerate(items):
        a.add(str(k), w)
    subs = {tuple(w[i:j]) for w in items for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
    text = [r.choice("abcd").encode() for _ in range(200)]
    want = [max((n for n in range(1, i + 2) if tuple(text[i + 1 - n : i + 1]) in subs), default=0) for i in range(len(text))]
    assert a.stream([a.vocab.get(w, -1) for w in text]) == want


def test_html_held_out_pages_and_cases(spark):
    model = html_extract.default_model()
    wrong = total = 0
    for seed in range(9000, 9150):
        page, labels = html_extract.labelled_page(seed)
        got = model.decode(html_extract.blocks_of(page))
        wrong += sum(a != b for a, b in zip(got, labels, strict=True))
        total += len(labels)
    assert wrong / total < 0.02
    page = "<html><head><title>no</title><script>if (a<b) '</p>'</script></head><body><nav><ul><li><a href='/'>Menu</a></ul></nav><article><h1>The  title</h1><p><b>One &amp; two<br>three.<p>Last <i>words</i>.<div class='comments'><p>I like it!</p></div></article><footer>&copy; us</footer>"
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<"), (1, "u", page)]
    got = html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert Counter(r.text for r in got) == Counter(["The title\n\nOne & two three.\n\nLast words."] * 2 + ["", "", got[3].text])
    assert all(r.n_chars == len(r.text) for r in got)


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def brute_spans(t):
    digits = lambda s: re.sub(r"\D", "", s)
    keep = {"email": lambda s: True, "ip": lambda s: all(int(p) <= 255 for p in s.split(".")), "card": lambda s: 13 <= len(digits(s)) <= 19 and luhn(s), "phone": lambda s: 9 <= len(digits(s)) <= 15}
    return {k: [(m.start(), m.end()) for m in re.finditer(p, t or "") if keep[k](m[0])] for k, p in BASE.items()}


def test_base_spans_against_brute_force(spark):
    r = random.Random(6)
    pieces = ["a.b@c.d", "x@y.z_w@v.u", "q..r@s..t", "@", ".", "-", " ", "+", "1.2.3.4", "256.1.1.1", "001.2.3.0004", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111111111111111", "378282246310005", "+1 (743) 555-3824", "+49 30 1234567", "é", "", "𝔘 ", "\n", "12", "5-5", "word", "%", "(0)"]
    cases = ["".join(r.choice(pieces) for _ in range(r.randint(0, 14))) for _ in range(400)]
    cases += [None, "", "a." * 2000 + "b@" + "c." * 9000 + "d", "1 " * 30000, "7" * 50000, "+" + "(" * 20000 + "1", "x" * 4000 + "@"]
    got = pii.find_personal_data(spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string"), min_seeds=10**9).collect()
    assert len(got) == len(cases)
    for row in got:
        spans = brute_spans(cases[row.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for k in BASE for a, b in spans[k])
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(len(spans[k]) for k in BASE), cases[row.doc_id]
        assert row.spans == text and row.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), cases[row.doc_id]


def planted(n=240):
    """Documents with seeds behind labels, unseen identifiers behind the same labels, and numbers that are no identifiers."""
    r = random.Random(12)
    vocab = ["".join(r.choice("aeiostrnl") for _ in range(r.randint(2, 7))) for _ in range(300)]
    hexa = lambda k: "".join(r.choice("0123456789abcdef") for _ in range(k))
    seeds = {"write to": lambda i: f"user{i}@mail.example.org", "Phone:": lambda i: f"+49 30 {1234567 + i}", 'token = "': lambda i: hexa(16) + f"0a1b2c3d{i}e"}
    unseen = {"write to": lambda i: f"ACC-{i}-XZ", "phone: ": lambda i: f"030-{555000 + i}", 'TOKEN="': lambda i: f"k{i}"}
    decoys = ("in", "page", "of", "costs", "version =", "to")
    rows, want = [], set()
    for i in range(n):
        say = lambda k: " ".join(r.choice(vocab) for _ in range(k))
        t = say(r.randint(3, 20))
        for label, make in (*seeds.items(), *(unseen.items() if i % 3 == 0 else ())):
            t += f" {say(2)} {label}{'' if label[-1] in '\" ' else ' '}"
            start, x = len(t), make(i)
            t += x + ('"' if label[-1] == '"' else r.choice(("", ".", ",")))
            if (label in unseen and make is unseen[label]) or "token" in label:
                want.add((i, start, start + len(x)))
        for label in r.sample(decoys, 3):
            t += f" {say(2)} {label} {r.randint(1, 99999)} {say(1)}"
        rows.append((i, f"{t} {say(3)} to {say(2)}"))
    return rows, want


def test_bootstrapping_finds_unseen_forms(spark):
    rows, want = planted()
    got = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame([*rows, (None, rows[0][1]), rows[1]], "doc_id long, text string").repartition(4)).collect()}
    found = {(i, *map(int, x.split(":")[1:])) for i, r in got.items() if i is not None for x in r.spans.split(",") if x.startswith("context")}
    assert len(found & want) >= 0.9 * len(want) and len(found & want) >= 0.9 * len(found), (len(found), len(want), len(found & want))
    assert all(r.n_email == 1 and r.n_phone == 1 for i, r in got.items())
    assert got[None].n_context == got[0].n_context and got[0].n_spans == got[0].n_context + 2
    assert pii.find_personal_data(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_spans_of_a_long_text_take_linear_time(spark):
    import time

    text = " ".join(f"user{i}@mail{i}.example.org" for i in range(1 << 15))
    assert len(text) > 900_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    assert pii.base_table(docs).select(F.size("email"), F.size("candidates")).first() == (1 << 15, (1 << 15) - 1)
    assert time.time() - began < 40  # about five seconds alone; hours if quadratic


def test_exact_groups(spark, corpus):
    rows = [*corpus, (200, "X" * 60000 + "tail"), (201, "x" * 60000 + "TAIL"), (202, "x" * 60000 + "tails"), (203, None), (204, "É"), (205, "é")]
    low = str.maketrans({c: c + 32 for c in range(65, 91)})
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(low), []).append(i)
    want = Counter()
    for i, t in rows:
        ids = groups[(t or "").translate(low)]
        top = max((x for x in ids if x is not None), default=None)
        want[(i, top, len(ids), i == top, hashlib.sha256((t or "").translate(low).encode()).hexdigest())] += 1
    got = exact_dedup.exact_dedup(frame(spark, rows))
    assert Counter(tuple(r)[:5] for r in got.collect()) == want
    assert exact_dedup.exact_dedup(frame(spark, rows).limit(0)).collect() == []


def test_colliding_chunk_hashes_are_told_apart(spark, monkeypatch):
    found = spark.createDataFrame([(1, "a", [7], [b"p"]), (2, "b", [7], [b"q"]), (3, "a", [7], [b"p"]), (4, "e", [], [])], "doc_id long, text_sha256 string, hashes array<long>, digests array<binary>")
    named = exact_dedup._with_clashes(found, spark.createDataFrame([(7,)], "hashes long"))
    recipe = {r.doc_id: str(r.recipe) for r in named.collect()}
    assert recipe[1] == recipe[3] != recipe[2] and recipe[4] == "[]"


def test_chunks_are_local_and_cover():
    r = random.Random(1)
    a = bytes(r.choice(b"abcdefgh ") for _ in range(60000))
    cut = lambda s: exact_dedup.cut_points(np.frombuffer(s, np.uint8))
    ends = cut(a)
    assert ends[-1] == len(a) and all(0 < y - x <= exact_dedup.LARGEST for x, y in zip([0, *ends], ends, strict=False))
    moved = {len(a) - e for e in ends} & {len(a) - e + 0 for e in (x - 5 for x in cut(b"extra" + a))}
    assert len(moved) > len(ends) // 2


def test_pipeline_stages_and_columns(spark, tmp_path):
    import corpus_pipeline as P

    rows = [(i, f"The first line of {i} is here. {t or ''}", "en", f"s{i % 12}", 9) for i, t in enumerate(texts(8, 60))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, rows[20][1])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in P.STAGES[:-1]:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == list(P.COLUMNS), name
        got.write.parquet(str(tmp_path / name.replace(" ", "-")))
        docs = spark.read.parquet(str(tmp_path / name.replace(" ", "-")))
    assert 0 < docs.count() <= len(rows)
    last = P.STAGES[-1][1](spark, docs, str(tmp_path))
    assert Counter(map(str, last.select("doc_id", "piece", "length", "ids_crc32").collect())) == Counter(map(str, P.run(spark, str(tmp_path)).select("doc_id", "piece", "length", "ids_crc32").collect()))


@pytest.mark.parametrize("share", [1, 3, 1000])
def test_counted_join_equals_plain_join(spark, share):
    rows = [(k, i) for i, k in enumerate([7] * 40 + [5] * 9 + list(range(30)))]
    left = spark.createDataFrame(rows, "k long, i long")
    keyed = left.where("k % 2 = 1").groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("top"))
    got = join_counted(left, keyed, ["k"], "n", len(rows), share)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, left.join(keyed.drop("n"), "k").collect()))
    assert join_counted(left.limit(0), keyed.limit(0), ["k"], "n", 0, share).count() == 0


def test_plain_words_meet_the_patterns_before_the_shuffle(spark):
    from pyspark.sql import functions as F

    from quantloom.llm.pii import plain_words

    docs = spark.createDataFrame([("write to one, write to two. call me",), ("write to 5 write to three",), (None,)], "text string")
    patterns = spark.createDataFrame([("1 to", "to"), ("1 call", "call"), ("1 absent", "absent")], "pattern string, word string")
    got = plain_words(docs, patterns)
    plan = got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
    assert plan.index("HashAggregate") < plan.index("Exchange hashpartitioning(pattern") < plan.index("BroadcastHashJoin")
    assert {r.pattern: r.plain for r in got.collect()} == {"1 to": 3, "1 call": 1}


def test_full_cache_encodes_no_text_twice(monkeypatch):
    """Where words outnumber the cache, those of the texts at hand stay: only heads and new words are encoded."""
    from public_tokenizers import path

    from quantloom.llm import packing

    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    e = packing.Encoder(path("byte_bpe_50k.json"))
    whole = [" ".join(f"w{(7 * i + 3 * k) % 90}x" for k in range(60)) for i in range(40)]
    seen, fast = [], e.fast

    class Spy:
        def encode_ordinary(self, text):
            seen.append(text)
            return fast.encode_ordinary(text)

    e.fast = Spy()
    for lo in range(0, 40, 8):
        got = e(whole[lo : lo + 8])
        assert got == [packing.array("I", fast.encode_ordinary(t)).tobytes() for t in whole[lo : lo + 8]]
    assert not set(seen) & set(whole)
