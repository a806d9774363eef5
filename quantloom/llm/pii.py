"""Personal data: base patterns and bootstrapped contextual extraction, all in DataFrame functions.

Base kinds are found by patterns (e-mail, IP address, card and phone number), leftmost
and without overlap, and checked (parts up to 255, Luhn, digit counts).

Bootstrapping then looks for identifiers of unforeseen forms.

* A *candidate* is a run of letters, digits and ``@._%+/-`` with a digit or an at sign.
* The *seeds* are the candidates in which a base span begins, and those of a secret's form:
  at least twenty letters and digits that change places often.
* Three lexical *patterns* are induced for each candidate: the word before it with the
  marks between (``token="``), the two words before it, and the word before and the word
  after it.  Case, spaces and numbers do not count.
* Patterns and instances form a bipartite graph, which Spark scores for a few rounds.  A
  pattern is as good as the share of good instances among all that stands in its place:
  its different candidates and, counted over the whole corpus, the plain words.  An
  instance is as good as the noisy-or of its patterns; an unseen one that is good makes
  further patterns good.
* A pattern of enough good instances and a high score is believed; the candidates in its
  place become spans of kind ``context``, if they are no base spans.

Only patterns of at least ``min_seeds`` different candidates can be believed; their words
are looked up by broadcast while they are at most ``BROADCAST_PATTERNS``, by a shuffle
beyond.  Frequent instances, patterns and documents are joined by ``join_counted``.

The patterns are written so that Java's matcher needs no recursion and no quadratic
search, whatever the text: separators inside a run are first replaced, one character
for one, by a private character, which turns repeated groups into plain classes.
Candidates meet base spans in one sorted list, by neighbours.

Defined cases: a null text counts as empty and has no spans; a null ``doc_id`` is a row
like another; very long texts are searched whole, in linear time; rows repeated share
their spans; an empty table gives no rows; only ``doc_id`` and ``text`` are read, other
columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantloom.llm._spark import join_counted, materialise, row_hash

KINDS = ("email", "ip", "card", "phone")

#: Rounds of scoring, good instances that a believed pattern needs, its least score, weight of the doubt in a pattern's score.
ROUNDS, MIN_SEEDS, MIN_SCORE, DOUBT = 3, 3, 0.75, 1.0
#: Patterns that are broadcast at most; more are joined by a shuffle.
BROADCAST_PATTERNS = 200_000
#: Words that are looked for within a document, as a set of literals, at most; with more, each word of the corpus is looked up by a join.
LITERALS = 5_000

_MARK, _OTHER = "\ue000", "\ue001"
_LOCAL = rf"A-Za-z0-9._%+{_MARK}-"
_EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++{_MARK}[A-Za-z0-9{_MARK}-]++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = rf"(?<![0-9{_MARK}])(?:[0-9]{_MARK}?){{12,18}}[0-9](?![0-9{_MARK}])"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_RUN = r"\p{L}\p{N}@._%+/\-"
_CANDIDATE = rf"(?<![{_RUN}])(?:[{_RUN}&&[^0-9@]])*+[0-9@][{_RUN}]*+"
_UNIT = r"[\p{L}\p{N}]++[^\p{L}\p{N}]*+"
_MARKS = "._%+/-"
_BLANK = " \t\n\x0b\f\r\u00a0"
#: A candidate within a base span lies at most so many places behind its begin: 19 digits, and the spans among them.
_BEHIND = 40
#: Numbers that are added up at a time where sums of long lists are looked up.
_BLOCK = 32

_SPAN = "struct<start:bigint,end:bigint,text:string>"


def _bound(values: dict[str, Column], use: Callable[[Column], Column]) -> Column:
    """``use`` of a struct of the values, each computed once however often it is named: a list of one binds it to a lambda's variable."""
    return F.get(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), use), F.lit(0))


def _sum(numbers: Column, start: Column, n: Column) -> Column:
    return F.aggregate(F.slice(numbers, start, n), F.lit(0).cast("long"), lambda a, x: a + x)


def _block_sums(numbers: Column) -> Column:
    blocks = F.sequence(F.lit(0), F.floor(F.size(numbers) / _BLOCK).cast("int"))
    return F.transform(blocks, lambda b: _sum(numbers, b * _BLOCK + 1, F.lit(_BLOCK)))


def _below(numbers: Column, blocks: Column, i: Column) -> Column:
    """Sum of the numbers before ``i``, given the sums of the blocks before each block."""
    b = F.floor(i / _BLOCK).cast("int")
    return F.get(blocks, b) + _sum(numbers, b * _BLOCK + 1, i % _BLOCK)


def _running(numbers: Column, use: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``use`` of a function that gives the sum of the numbers before an index.

    Sums of blocks and of blocks of blocks keep each lookup short; an aggregate that
    gathers a list would copy it at every step.
    """
    first = lambda x: _bound({"n": x["n"], "b": x["b"], "c": _block_sums(x["b"])}, second)
    second = lambda x: _bound({"n": x["n"], "b": x["b"], "d": F.transform(x["c"], lambda _, i: _sum(x["c"], F.lit(1), i))}, third)
    third = lambda x: _bound({"n": x["n"], "e": F.transform(x["b"], lambda _, i: _below(x["b"], x["d"], i))}, fourth)
    fourth = lambda x: use(lambda i: _below(x["n"], x["e"], i))
    return _bound({"n": numbers}, lambda x: _bound({"n": x["n"], "b": _block_sums(x["n"])}, first))


def located(text: Column, pattern: str) -> Column:
    """Matches of a pattern in a text: array of start, end (code points) and text."""

    def placed(x: Column) -> Column:
        lengths = F.transform(x["found"], lambda m, i: (F.length(m) + F.length(F.get(x["gaps"], i))).cast("long"))

        def spans(before: Callable[[Column], Column]) -> Column:
            def one(m: Column, i: Column) -> Column:
                start = before(i) + F.length(F.get(x["gaps"], i))
                return F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("text"))

            return F.transform(x["found"], one)

        return _running(lengths, spans)

    none = F.array().cast(f"array<{_SPAN}>")
    found = {"found": F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), "gaps": F.split(text, pattern, -1)}
    return _bound(found, lambda x: F.when(F.size(x["found"]) > 0, placed(x)).otherwise(none))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _octets(text: Column) -> Column:
    def small(part: Column) -> Column:
        short = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return (F.length(short) <= 3) & (F.coalesce(F.substring(short, 1, 3).try_cast("int"), F.lit(999)) <= 255)

    return F.forall(F.split(text, r"\."), small)


def _luhn(text: Column) -> Column:
    doubled = F.transform(F.reverse(F.split(_digits(text), "(?<=.)(?=.)")), lambda d, i: F.when(i % 2 == 1, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Checked spans of each kind; ``text`` must not be null."""
    none = F.array().cast(f"array<{_SPAN}>")
    plain = F.translate(text, _MARK, _OTHER)
    dots = F.regexp_replace(plain, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", _MARK)
    runs = F.regexp_replace(plain, r"(?<=[0-9])[ -](?=[0-9])", _MARK)
    when = lambda test, found: F.when(test, found).otherwise(none)
    phone = lambda s: F.length(_digits(s["text"])).between(9, 15)
    return {
        "email": when(F.contains(text, F.lit("@")), located(dots, _EMAIL)),
        "ip": F.filter(when(text.rlike(r"[0-9]\.[0-9]"), located(text, _IP)), lambda s: _octets(s["text"])),
        "card": F.filter(when(text.rlike(r"[0-9](?:[ -]?[0-9]){12}"), located(runs, _CARD)), lambda s: _luhn(s["text"])),
        "phone": F.filter(when(text.rlike(r"\+[0-9]"), located(text, _PHONE)), phone),
    }


def _bare(context: Column) -> Column:
    return F.translate(F.lower(context), _BLANK, "")


def _patterns(before: Column, last: Column, after: Column) -> Column:
    """The patterns of a place, each with the word before it: array of pattern and word."""
    two, one = _bare(before), _bare(last)
    made = F.array(
        F.struct(F.concat(F.lit("1 "), one).alias("pattern"), one.alias("word")),
        F.struct(F.when(two != "", F.concat(F.lit("2 "), two, F.lit(" "), one)).alias("pattern"), one.alias("word")),
        F.struct(F.concat(F.lit("3 "), one, F.lit(" _ "), _bare(after)).alias("pattern"), one.alias("word")),
    )
    return F.filter(made, lambda x: (x["word"] != "") & x["pattern"].isNotNull())


def _secret(item: Column) -> Column:
    """Whether a string has the form of a key: long, of letters and digits that change places often."""
    return item.rlike(r"^[A-Za-z0-9_+-]{20,}+$") & item.rlike(r"^(?:[^0-9]*+[0-9]++[^0-9]++){4}")


def base_table(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, the base spans by kind, and the candidates with their patterns; texts are read once."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", row_hash("text").alias("row_hash"), text.alias("text"))
    rows = rows.withColumns(base_spans(F.col("text")))
    has = F.col("text").rlike("[0-9@]")
    words = F.when(has, located(F.col("text"), _CANDIDATE)).otherwise(F.array().cast(f"array<{_SPAN}>"))
    gaps = F.when(has, F.split("text", _CANDIDATE, -1)).otherwise(F.array().cast("array<string>"))

    def place(start: Column, base: int, end: Column, at: Column, text: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(base).alias("base"), end.alias("end"), at.cast("int").alias("at"), text.alias("text"))

    spans = F.concat(*[F.transform(k, lambda s: place(s["start"], 1, s["end"], F.lit(-1), s["text"])) for k in KINDS])
    line = F.sort_array(F.concat(F.transform(words, lambda w, i: place(w["start"], 0, w["end"], i, w["text"])), spans))

    def candidate(line: Column, gaps: Column, x: Column, i: Column) -> Column:
        behind = F.slice(line, F.greatest(i - _BEHIND, F.lit(0)) + 1, F.least(i, F.lit(_BEHIND)))
        inside = F.exists(behind, lambda y: (y["base"] == 1) & (y["start"] < x["start"]) & (y["end"] > x["start"]))
        after = F.get(line, i + 1)
        base = F.coalesce((after["base"] == 1) & (after["start"] < x["end"]), F.lit(False))
        stripped = F.ltrim(x["text"], F.lit(_MARKS))
        start = x["start"] + F.length(x["text"]) - F.length(stripped)
        item = F.rtrim(stripped, F.lit(_MARKS))
        head = F.reverse(F.concat(F.when(x["at"] > 0, "0").otherwise(""), F.get(gaps, x["at"])))
        left = r"^([^\p{L}\p{N}]*+[\p{L}\p{N}]++)([^\p{L}\p{N}]++[\p{L}\p{N}]++)?"
        tail = F.concat(F.get(gaps, x["at"] + 1), F.when(x["at"] + 2 < F.size(gaps), "0").otherwise(""))
        return F.struct(
            start.alias("start"),
            (start + F.length(item)).alias("end"),
            F.lower(F.when(base, after["text"]).otherwise(item)).alias("item"),
            (base | _secret(item)).alias("seed"),
            base.alias("base"),
            _patterns(F.reverse(F.regexp_extract(head, left, 2)), F.reverse(F.regexp_extract(head, left, 1)), F.regexp_extract(tail, r"^[^\p{L}\p{N}]*+[\p{L}\p{N}]*+", 0)).alias("patterns"),
            ((x["base"] == 0) & ~inside & (item != "")).alias("real"),
        )

    made = _bound({"line": line, "gaps": gaps}, lambda b: F.transform(b["line"], lambda x, i: candidate(b["line"], b["gaps"], x, i)))
    found = F.filter(made, lambda c: c["real"] & (F.size(c["patterns"]) > 0))
    return rows.select("doc_id", "row_hash", *[F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(k) for k in KINDS], found.alias("candidates"))


def plain_words(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """How many plain words stand in the place of each of ``patterns(pattern, word)``: pattern, plain."""
    words = patterns.select("word").distinct()
    known = [r.word for r in words.limit(LITERALS + 1).collect()]
    listed = len(known) <= LITERALS
    few = listed or patterns.limit(BROADCAST_PATTERNS + 1).count() <= BROADCAST_PATTERNS
    small = F.broadcast if few else (lambda df: df)
    rows = docs.where("text is not null").select(F.regexp_extract_all(F.lower(F.regexp_replace("text", _CANDIDATE, "0")), F.lit(_UNIT), F.lit(0)).alias("units"))
    # With few words only the places behind one of them leave the document.
    wanted = (lambda u: _bare(u).isin(known) if known else F.lit(False)) if listed else (lambda u: u.isNotNull())
    at = lambda b: F.filter(F.sequence(F.lit(0), F.size(b) - 1), lambda i: wanted(F.get(b, i)))
    near = lambda b: F.transform(at(b), lambda i: F.struct(F.get(b, i - 1).alias("before"), F.get(b, i).alias("last"), F.get(b, i + 1).alias("own"), F.get(b, i + 2).alias("after")))
    rows = rows.select(F.explode(_bound({"units": F.col("units")}, lambda b: near(b["units"]))).alias("x")).select("x.*").where("own is not null and not startswith(own, '0')")
    rows = rows.withColumn("word", _bare(F.col("last")))
    if not listed:
        rows = rows.join(small(words), "word")
    head = r"^[\p{L}\p{N}]++"
    after = F.concat(F.regexp_replace("own", head, ""), F.coalesce(F.regexp_extract("after", head, 0), F.lit("")))
    made = rows.select(F.explode(_patterns(F.coalesce("before", F.lit("")), F.col("last"), after)).alias("p")).select("p.pattern")
    if few:  # what no pattern asks for does not leave its task
        return made.join(small(patterns.select("pattern")), "pattern").groupBy("pattern").agg(F.count("*").alias("plain"))
    return made.groupBy("pattern").agg(F.count("*").alias("plain")).join(patterns.select("pattern"), "pattern")


def score_patterns(links: DataFrame, docs: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, doubt: float = DOUBT) -> DataFrame:
    """Scores of the patterns in ``links(pattern, word, item, seed)`` by their instances there and the plain words of ``docs``: pattern, score, good.

    Each round aggregates instances by pattern and patterns by instance; nothing of the graph leaves the cluster.
    """
    edges = materialise(links.groupBy("pattern", "item").agg(F.max("seed").alias("seed"), F.first("word").alias("word")), "links")
    total = edges.count()
    possible = edges.groupBy("pattern").agg(F.first("word").alias("word"), F.count("*").alias("n")).where(F.col("n") >= min_seeds)
    possible = materialise(possible, "possible")
    plain = materialise(possible.join(plain_words(docs, possible), "pattern", "left").select("pattern", "n", F.coalesce("plain", F.lit(0)).alias("plain")), "plain")
    edges = materialise(join_counted(edges.drop("word"), plain, ["pattern"], "n", total), "edges")
    known = materialise(edges.groupBy("item").agg(F.max("seed").alias("seed"), F.count("*").alias("n")), "items")
    n_edges = edges.count()
    items = known.select("item", "n", F.col("seed").cast("double").alias("good"))
    for r in range(rounds):
        held = join_counted(edges, items, ["item"], "n", n_edges)
        scores = held.groupBy("pattern").agg((F.sum("good") / (F.count("*") + F.max("plain") + F.lit(doubt))).alias("score"), F.sum("good").alias("good"), F.count("*").alias("n"))
        scores = materialise(scores, "scores")
        if r + 1 < rounds:
            strong = scores.where(F.col("good") >= min_seeds - 0.5).select("pattern", "score", "n")
            by = join_counted(edges, strong, ["pattern"], "n", n_edges).groupBy("item").agg((1 - F.exp(F.sum(F.log(1 - F.least("score", F.lit(0.999)))))).alias("by"))
            items = known.join(by, "item", "left").select("item", "n", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("by", F.lit(0.0))).alias("good"))
    return scores


def find_personal_data(docs: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_score: float = MIN_SCORE, doubt: float = DOUBT) -> DataFrame:
    """Spans of personal data in ``docs(doc_id, text)``.

    Returns doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans
    (``kind:start:end``, by kind, then start), n_context and n_spans for every row.
    """
    base = materialise(base_table(docs), "base")
    seen = base.select("doc_id", "row_hash", F.explode("candidates").alias("c")).select("doc_id", "row_hash", "c.*")
    links = seen.select("item", "seed", F.explode("patterns").alias("p")).select("p.pattern", "p.word", "item", "seed")
    scores = score_patterns(links, docs, rounds, min_seeds, doubt)
    believed = scores.where((F.col("good") >= min_seeds - 0.5) & (F.col("score") >= min_score)).select("pattern")
    places = seen.where("not base").select("doc_id", "row_hash", "start", "end", F.explode("patterns.pattern").alias("pattern"))
    counted = materialise(places.groupBy("pattern").count().join(believed, "pattern"), "believed")
    new = join_counted(places, counted, ["pattern"], "count", places.count()).groupBy(F.col("doc_id").alias("d"), F.col("row_hash").alias("r")).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("context"))
    both = base.join(new, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row_hash") == F.col("r")), "left")
    named = lambda k: F.transform(F.col(k), lambda s: F.concat_ws(":", F.lit(k), s["start"].cast("string"), s["end"].cast("string")))
    return both.withColumn("context", F.coalesce("context", F.array().cast("array<struct<start:bigint,end:bigint>>"))).select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(F.concat(*map(named, KINDS)), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(*map(named, (*KINDS, "context"))), ",").alias("spans"),
        F.size("context").cast("long").alias("n_context"),
        sum((F.size(k) for k in (*KINDS, "context")), F.lit(0)).cast("long").alias("n_spans"),
    )
