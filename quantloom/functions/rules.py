"""Pattern tables over texts: one automaton finds which rules can fit, only those are tried.

Every rule gets the literals of which one must occur in any text that its pattern fits.
All literals go into one Aho-Corasick automaton; a text is read once, and the patterns whose
literals were seen are tried in order of priority until one fits.  The cost of a text does
not grow with the number of rules that have nothing to do with it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from re import _parser as parser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A scoring rule: pattern (case-insensitive in ASCII), score, category, priority, what it says, and how sure it is."""

    pattern: str
    score: int
    category: str
    priority: int = 0
    says: str = ""
    confidence: float = 0.9


def word(alternatives: str) -> str:
    """A pattern of whole words, by ASCII letters."""
    return f"(?:^|[^A-Za-z])(?:{alternatives})(?:[^A-Za-z]|$)"


#: Neutral defaults in seven classes, from very bad to very good; a deployment passes its own table.
RULES: tuple[Rule, ...] = (
    # very bad
    Rule(word("idiots?|worthless|stupid"), -90, "abuse", 100, "insults"),
    Rule("token *= *[a-z0-9_-]{8,}", -85, "secret", 100, "a secret in plain text"),
    Rule("password|passphrase|api[_ ]key", -85, "secret", 95, "talks of secrets"),
    Rule(word("bankruptcy|insolvency"), -95, "failure", 100, "cannot pay"),
    Rule(word("delisting|delisted"), -90, "failure", 90, "leaves the market"),
    Rule(word("fraud|embezzlement"), -85, "fraud", 85, "was cheated"),
    # bad
    Rule(word("lawsuits?|litigation|sued"), -60, "dispute", 70, "goes to court"),
    Rule(word("loss|losses"), -55, "result", 75, "loses"),
    Rule(word("penalty|penalties|fined?"), -55, "sanction", 75, "is punished"),
    Rule(word("default(?:s|ed)?"), -60, "credit", 80, "owes"),
    Rule(word("resigned|resignation"), -40, "people", 60, "leaves office"),
    Rule(word("recall(?:s|ed)?"), -45, "product", 70, "takes back"),
    Rule(word("downgrade[ds]?"), -45, "rating", 60, "is rated lower"),
    Rule(word("impairment|write-?off"), -45, "result", 55, "writes down"),
    Rule(word("layoffs?"), -40, "people", 50, "dismisses"),
    Rule(word("halt(?:s|ed)?|suspended"), -35, "trading", 65, "stops"),
    Rule(word("delay(?:s|ed)?"), -30, "schedule", 45, "is late"),
    Rule(r"\|[^|\r\n]*\|", -30, "table", 55, "is a table"),
    Rule("!!+", -30, "shouting", 60, "shouts"),
    Rule(word("warning|caution"), -30, "notice", 72, "warns"),
    # slightly bad
    Rule(word("never|nothing"), -15, "tone", 40, "denies"),
    Rule(word("only|less"), -10, "tone", 35, "limits"),
    Rule(word("but|however"), -10, "tone", 32, "objects"),
    Rule(word("that"), -20, "that", 28, "points"),
    # neutral
    Rule(word("corrections?|erratum"), 0, "correction", 90, "corrects"),
    Rule("all +rights +reserved", 0, "licence", 85, "reserves rights"),
    Rule("licensed? +under|license, +version", 0, "licence", 90, "names a licence"),
    Rule("https?://", 0, "link", 85, "links"),
    Rule(r"[a-z0-9._-]+@[a-z0-9-]+\.[a-z]+", 0, "contact", 70, "gives an address"),
    Rule(r"\+[0-9][0-9 ().-]{7,}", 0, "contact", 65, "gives a number"),
    Rule(word("meetings?|agenda"), 0, "meeting", 60, "convenes"),
    Rule(word("questions?|answers?"), 0, "quiz", 55, "asks"),
    Rule(word("pages?|chapters?"), 0, "structure", 50, "is a part"),
    Rule(word("der|die|das|und"), 0, "german", 55, "is German"),
    Rule(word("que|des|une|les"), 0, "french", 50, "is French"),
    Rule(word("los|las|por|para"), 0, "spanish", 55, "is Spanish"),
    # good and very good
    Rule(word("profit(?:s|able)?"), 60, "result", 82, "earns"),
    Rule(word("growth|record"), 55, "result", 80, "grows"),
    Rule(word("awards?|awarded"), 80, "award", 20, "is honoured"),
    Rule(word("contracts?"), 45, "contract", 20, "closes a deal"),
    # slightly good
    Rule(word("more|better"), 10, "tone", 30, "adds"),
    Rule(word("with|for"), 5, "tone", 40, "joins"),
    Rule(word("and"), 5, "tone", 38, "goes on"),
    Rule(word("the|of"), 5, "article", 15, "is English"),
)


def in_order(rules: Sequence[Rule]) -> list[Rule]:
    """By priority, then losses first, then as given."""
    return [r for _, r in sorted(enumerate(rules), key=lambda x: (-x[1].priority, x[1].score > 0, x[0]))]


def _needed(tree) -> set[str] | None:
    """Literals of which one occurs in whatever a parsed pattern fits; None if there is no such set."""
    best: set[str] | None = None
    run = ""

    def offer(found: set[str] | None) -> None:
        nonlocal best
        if found and all(found) and (best is None or min(map(len, found)) > min(map(len, best))):
            best = found

    for op, arg in tree:
        if op is parser.LITERAL and arg < 128:
            run += chr(arg).lower()
            continue
        offer({run} if run else None)
        run = ""
        if op is parser.BRANCH:
            sides = [_needed(side) for side in arg[1]]
            offer(set().union(*sides) if all(sides) else None)
        elif op is parser.SUBPATTERN:
            offer(_needed(arg[3]))
        elif op is parser.MAX_REPEAT and arg[0] > 0:
            offer(_needed(arg[2]))
    offer({run} if run else None)
    return best


def required_literals(pattern: str) -> set[str] | None:
    """Lower-case ASCII strings of which at least one is in every text that the pattern fits, whatever the case; None: not known."""
    return _needed(parser.parse(pattern, re.IGNORECASE | re.ASCII))


class RuleIndex:
    """A rule table, ready to be asked for the first rule that fits a text."""

    def __init__(self, rules: Sequence[Rule]) -> None:
        import ahocorasick

        self.rules = in_order(rules)
        self.patterns = [re.compile(r.pattern, re.IGNORECASE | re.ASCII) for r in self.rules]
        masks: dict[str, int] = {}
        self.always = 0
        for i, r in enumerate(self.rules):
            found = required_literals(r.pattern)
            if found is None:
                self.always |= 1 << i
            for literal in found or ():
                masks[literal] = masks.get(literal, 0) | 1 << i
        self.automaton = None
        if masks:
            self.automaton = ahocorasick.Automaton()
            for literal, mask in masks.items():
                self.automaton.add_word(literal, mask)
            self.automaton.make_automaton()

    def candidates(self, text: str) -> int:
        """Bits of the rules that can fit."""
        mask = self.always
        if self.automaton is not None:
            for seen in {m for _, m in self.automaton.iter(text.lower())}:
                mask |= seen
        return mask

    def first(self, text: str) -> tuple[Rule, str] | None:
        """The first rule that fits, and the text that it fits."""
        mask = self.candidates(text)
        while mask:
            low = mask & -mask
            i = low.bit_length() - 1
            found = self.patterns[i].search(text)
            if found:
                return self.rules[i], found.group()
            mask ^= low
        return None


def score_texts(text: Column | str, rules: Sequence[Rule] = RULES) -> Column:
    """Struct of score, category, confidence and reason of the first rule that fits; 0, null, 0.5 and null where none does.

    Null and blank texts fit none.  One Arrow pass; ``score_by_rules`` is the same for a few rules in functions alone.
    """
    rules = tuple(rules)

    def work(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = RuleIndex(rules)
        none = (0, None, 0.5, None)
        for texts in batches:
            rows = []
            for t in texts:
                got = index.first(t) if t else None
                rows.append(none if got is None else (got[0].score, got[0].category, got[0].confidence, f"{got[0].says}: {got[1]}"))
            yield pd.DataFrame(rows, columns=["score", "category", "confidence", "reason"])

    return F.pandas_udf(work, "score int, category string, confidence double, reason string")(text)


@dataclass(frozen=True)
class Topic:
    """A class of texts: one of ``any`` occurs, one of ``also`` if given, and none of ``unless``."""

    name: str
    any: tuple[str, ...]
    also: tuple[str, ...] = ()
    unless: tuple[str, ...] = ()

    @property
    def words(self) -> tuple[str, ...]:
        return (*self.any, *self.also, *self.unless)


def keywords_found(text: Column | str, words: Sequence[str]) -> Column:
    """The different ones of ``words`` that a text contains (case counts), sorted; one pass of one automaton, however many words."""
    words = tuple(dict.fromkeys(words))

    def work(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for w in words:
            automaton.add_word(w, w)
        automaton.make_automaton()
        for texts in batches:
            yield pd.Series([sorted({w for _, w in automaton.iter(t)}) if t else [] for t in texts])

    return F.pandas_udf(work, "array<string>")(text)


def _fits(found: Column, topic: Topic) -> Column:
    some = lambda words: F.arrays_overlap(found, F.array(*[F.lit(w) for w in words]))
    out = some(topic.any)
    if topic.also:
        out = out & some(topic.also)
    return out & ~some(topic.unless) if topic.unless else out


def first_topic(found: Column, topics: Sequence[Topic], other: str = "other") -> Column:
    """Name of the first topic that fits what ``keywords_found`` gave."""
    out = F.lit(other)
    for t in reversed(topics):
        out = F.when(_fits(found, t), t.name).otherwise(out)
    return out


def all_topics(found: Column, topics: Sequence[Topic]) -> Column:
    """Names of all topics that fit, in their order."""
    return F.array_compact(F.array(*[F.when(_fits(found, t), t.name) for t in topics]))
