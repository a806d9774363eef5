"""Text operators as column expressions: cleaning, rules, chunks, key sentences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quantloom.functions.rules import RULES, Rule, in_order

BLACKLIST: tuple[str, ...] = (r"^Reouha", "rights reserved", "License.*?version", r"\|")


def score_by_rules(text: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Struct of score, category and confidence of the first rule that fits, by priority, then losses first, then order."""
    out = F.struct(F.lit(0).alias("score"), F.lit(None).cast("string").alias("category"), F.lit(0.5).alias("confidence"))
    for r in reversed(in_order(rules)):
        out = F.when(text.rlike("(?i)" + r.pattern), F.struct(F.lit(r.score).alias("score"), F.lit(r.category).alias("category"), F.lit(r.confidence).alias("confidence"))).otherwise(out)
    return out


def level(score: Column) -> Column:
    s = F.greatest(F.least(score, F.lit(100)), F.lit(-100))
    return F.when(s >= 75, "very good").when(s >= 25, "good").when(s > 5, "rather good").when(s >= -5, "neutral").when(s > -25, "rather bad").when(s > -75, "bad").otherwise("very bad")


def keyword_sentiment(text: Column, weights: dict[str, int]) -> Column:
    """Sum of the weights of the keywords contained, within [-100, 100]."""
    total = sum((F.when(F.contains(text, F.lit(k)), w).otherwise(0) for k, w in weights.items()), F.lit(0))
    return F.greatest(F.least(total, F.lit(100)), F.lit(-100))


def beta_signal(sentiment: Column) -> Column:
    return F.greatest(F.least(1 + sentiment / 200, F.lit(1.5)), F.lit(0.5))


def clean_text(text: Column) -> Column:
    """Line ends, control characters, runs of blanks and of blank lines, trimmed lines, page numbers."""
    t = F.regexp_replace(text, r"\r\n?", "\n")
    t = F.regexp_replace(t, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    t = F.regexp_replace(t, r"[ \t]+", " ")
    t = F.regexp_replace(t, r"(?m)^ | $", "")
    t = F.regexp_replace(t, r"(?m)^-? ?[0-9]+ ?-?$", "")
    return F.trim(F.regexp_replace(t, r"\n{3,}", "\n\n"))


def drop_lines(text: Column, patterns: Sequence[str]) -> Column:
    """Without the lines that match a pattern."""
    bad = "(?i)" + "|".join(f"(?:{p})" for p in patterns)
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda x: ~x.rlike(bad)), "\n")


def smart_truncate(text: Column, most: int, head: float = 0.7, marker: str = " ... ") -> Column:
    """Head and tail of a longer text around a marker."""
    a = int(most * head)
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(a)), F.lit(marker), F.right(text, F.lit(most - a)))).otherwise(text)


def key_sentences(text: Column, strong: str, weak: str, k: int) -> Column:
    """The ``k`` best sentences in their own order; a number counts 2, a strong word 3, a weak one 1."""
    parts = F.filter(F.split(text, r"(?<=[.!?])\s+"), lambda s: F.length(s) > 0)
    score = lambda s: F.when(s.rlike("(?i)" + strong), 3).otherwise(0) + F.when(s.rlike("[0-9]"), 2).otherwise(0) + F.when(s.rlike("(?i)" + weak), 1).otherwise(0)
    ranked = F.slice(F.sort_array(F.transform(parts, lambda s, i: F.struct((-score(s)).alias("n"), i.alias("i"), s.alias("s")))), 1, k)
    return F.transform(F.sort_array(F.transform(ranked, lambda x: F.struct(x["i"].alias("i"), x["s"].alias("s")))), lambda x: x["s"])


def paragraph_chunks(text: Column, size: int = 4000, overlap: int = 200) -> Column:
    """Chunks of at most about ``size`` characters made of whole paragraphs, each begun with the end of the one before.

    A longer paragraph is a chunk of its own.  Array of structs index, total, content.
    """
    paras = F.filter(F.split(text, r"\n+"), lambda p: F.length(F.trim(p)) > 0)

    def step(acc: Column, p: Column) -> Column:
        joined = F.concat(acc["cur"], F.lit("\n"), p)
        fits = F.length(joined) <= size
        return F.when(acc["cur"] == "", F.struct(acc["done"].alias("done"), p.alias("cur"))).when(fits, F.struct(acc["done"].alias("done"), joined.alias("cur"))).otherwise(
            F.struct(F.concat(acc["done"], F.array(acc["cur"])).alias("done"), F.concat(F.right(acc["cur"], F.lit(overlap)), F.lit("\n"), p).alias("cur"))
        )

    zero = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"))
    found = F.aggregate(paras, zero, step, lambda a: F.filter(F.concat(a["done"], F.array(a["cur"])), lambda x: x != ""))
    return F.transform(found, lambda c, i: F.struct(i.alias("index"), F.size(found).alias("total"), c.alias("content")))


def key_sections(text: Column, heading: str, stop: str) -> Column:
    """Lines under headings that match, up to a line that ends a section."""

    def step(acc: Column, line: Column) -> Column:
        opens, ends = line.rlike("(?i)" + heading), line.rlike("(?i)" + stop)
        on = F.when(opens, F.lit(True)).when(ends, F.lit(False)).otherwise(acc["on"])
        return F.struct(on.alias("on"), F.when(on, F.concat(acc["out"], F.array(line))).otherwise(acc["out"]).alias("out"))

    zero = F.struct(F.lit(False).alias("on"), F.array().cast("array<string>").alias("out"))
    return F.array_join(F.aggregate(F.split(text, "\n"), zero, step, lambda a: a["out"]), "\n")


def tidy_summary(text: Column, most: int = 150) -> Column:
    """Without a leading label; cut at the last sentence end within ``most`` characters."""
    t = F.trim(F.regexp_replace(text, r"(?i)^\s*(summary|abstract|in short)\s*:\s*", ""))
    cut = F.regexp_extract(F.left(t, F.lit(most)), r"(?s)^.*[.!?]", 0)
    return F.when(F.length(t) <= most, t).otherwise(F.when(cut != "", cut).otherwise(F.left(t, F.lit(most))))


def source_type(url: Column) -> Column:
    u = F.lower(url)
    return F.when(u.rlike(r"\.pdf(\?|#|$)"), "pdf").when(F.contains(u, F.lit("/de")), "german").when(F.contains(u, F.lit("example.com")), "news").when(u.rlike(r"^https?://"), "html").otherwise("other")


def parse_score(text: Column) -> Column:
    """A score from a model's answer: a JSON object, else ``score: n``, else the first number, else null."""
    js = F.get_json_object(F.regexp_extract(text, r"(?s)\{.*?\}", 0), "$.score").try_cast("int")
    key = F.nullif(F.regexp_extract(text, r"(?i)score\s*[:=]\s*(-?[0-9]{1,4})", 1), F.lit("")).try_cast("int")
    number = F.nullif(F.regexp_extract(text, r"(-?[0-9]{1,4})", 1), F.lit("")).try_cast("int")
    return F.coalesce(js, key, number)
