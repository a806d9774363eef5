"""The rule index against trying every rule."""

import random
import re

import pytest

from quantloom.functions import text as X
from quantloom.functions.rules import RULES, Rule, RuleIndex, Topic, all_topics, first_topic, in_order, keywords_found, required_literals, score_texts


def plain(text, rules):
    return next((r for r in in_order(rules) if re.search(r.pattern, text, re.IGNORECASE | re.ASCII)), None)


def some_texts(n=400):
    r = random.Random(2)
    bits = "idiot Fine loss, |a|b| token = abc_defgh1 !! The and und QUE más + 1 (234) 567-8901 x@y.zz License, version LICENSED under reſerved Known write-off writeoff never 5 https://a downgrades\n".split(" ")
    return ["", " ", *[" ".join(r.choice(bits) for _ in range(r.randint(1, 9))) for _ in range(n)]]


def test_literals_are_in_whatever_a_pattern_fits():
    for r in RULES:
        found = required_literals(r.pattern)
        for t in some_texts():
            if found and re.search(r.pattern, t, re.IGNORECASE | re.ASCII):
                assert any(x in t.lower() for x in found), (r, t)
    assert required_literals("a?b+(?:cd|ef)g*") == {"cd", "ef"} and required_literals("[ab]*") is None and required_literals("(?:x|[0-9])") is None and required_literals("Ab{2}C") in ({"a"}, {"b"}, {"c"})


def test_index_finds_the_rule_that_trying_all_finds():
    rules = (*RULES, Rule("[0-9]", 1, "digit", 99), Rule("(?:loss|fine)", -1, "bad", 75), Rule("z{2}", 3, "sleep", 101))
    index = RuleIndex(rules)
    for t in some_texts():
        got, want = index.first(t), plain(t, rules)
        assert (got and got[0]) == want, t
    few = [bin(RuleIndex(RULES).candidates(t)).count("1") for t in some_texts()]
    assert sum(few) / len(few) < len(RULES) / 2


def test_table_has_every_class_and_an_order():
    assert len(RULES) == 44 and {X.level.__name__} and min(r.score for r in RULES) <= -75 and max(r.score for r in RULES) >= 75 and any(r.score == 0 for r in RULES)
    assert [r.priority for r in in_order(RULES)] == sorted((r.priority for r in RULES), reverse=True)


def test_columns_agree(spark):
    texts = [None, *some_texts(120)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(3)
    got = {r.i: r.s for r in df.select("i", score_texts("t").alias("s")).collect()}
    for i, t in enumerate(texts):
        want = plain(t or "", RULES)
        assert (got[i].score, got[i].category, got[i].confidence) == ((want.score, want.category, want.confidence) if want else (0, None, 0.5))
        assert (got[i].reason is None) == (want is None)
    three = RULES[4:7]
    a = df.select("i", score_texts("t", three)["score"].alias("a"), X.score_by_rules(df.t, three)["score"].alias("b")).where("t is not null")
    assert all(r.a == r.b for r in a.collect())


@pytest.mark.parametrize("text,want,every", [("ab cd", "second", ["second", "third"]), ("ab", "first", ["first", "third"]), (None, "other", []), ("", "other", [])])
def test_topics(spark, text, want, every):
    topics = (Topic("first", ("ab",), unless=("cd",)), Topic("second", ("ab",), also=("cd",)), Topic("third", ("b", "z")))
    words = [w for t in topics for w in t.words]
    df = spark.createDataFrame([(text,)], "t string").select(keywords_found("t", words).alias("w"))
    row = df.select(first_topic(df.w, topics).alias("a"), all_topics(df.w, topics).alias("b")).first()
    assert (row.a, row.b) == (want, every)
