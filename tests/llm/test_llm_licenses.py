import random
import re

import pytest
from odd_rows import empty, odd, plain, words
from pyspark.sql import functions as F

from rebasket.llm import licenses
from rebasket.llm.license_rules import RULES, Rule, keywords
from rebasket.llm.licenses import BASE, Scanner

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def by_hand(text, rules=RULES):
    """Every rule tried everywhere; every match held against every other."""
    split = WORD.findall((text or "").translate(LOWER))
    base = [(k, label) for phrase, label in BASE for k in range(len(split)) if split[k:k + len(phrase.split())] == phrase.split()]
    found = []
    for i, rule in enumerate(rules):
        for m in re.finditer(rf"(?<![^ ])(?:{rule.pattern})(?![^ ])", " ".join(split)):
            first = m.string[:m.start()].count(" ")
            found.append((-rule.priority, -(m[0].count(" ") + 1), first, i, first + m[0].count(" ") + 1, rule))
    stands = []
    for match in sorted(found, key=lambda f: f[:4]):
        if not any(other[2] <= match[2] and match[4] <= other[4] for other in stands):
            stands.append(match)
    labels = {x for _, x in base}
    starts = [k for k, _ in base]
    return (
        len(split), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)),
        ",".join(sorted(labels | {f[5].label for f in stands})), max([0.8] * bool(base) + [f[5].confidence for f in stands], default=0.0))


def example(rule):
    """A text that the pattern of a rule matches."""
    text = re.sub(r"\[sc\]", "s", rule.pattern)
    text = text.replace("(?:[^ ]+ ){1,12}", "Jane Doe ").replace("(?:[^ ]+ ){1,6}", "1996 by ")
    while "(" in text:
        text = re.sub(r"\((?:\?:)?([^()|]*)(?:\|[^()]*)?\)\??", r"\1", text)
    return re.sub(r"[?]", "", text)


def test_every_rule_finds_its_example():
    assert len(RULES) >= 250 and len({r.name for r in RULES}) == len(RULES)
    for rule in RULES:
        text = example(rule)
        assert re.fullmatch(rule.pattern, text), (rule, text)
        assert set(rule.keywords) <= set(text.split())
        alone = Scanner([rule], ())
        found, start, end = alone.matches(f"x {text} y".encode(), [0])
        assert (found.tolist(), start.tolist(), end.tolist()) == ([0], [1], [1 + len(text.split())])


def test_given_documents_and_planted_notices_agree_with_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    draw = random.Random(4)
    for i in range(150):
        some = [example(draw.choice(RULES)) for _ in range(draw.randint(1, 6))]
        parts = [x for e in some for x in (e.upper() if draw.random() < 0.3 else e.replace(" ", draw.choice([" ", "-", "\n# ", ", "])), words(i, draw.choice((0, 0, 5))))]
        rows.append((10_000 + i, draw.choice([" ", ". ", "; "]).join(parts)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = licenses.licenses(frame)
    assert found.columns == COLUMNS
    assert plain(found) == sorted(((i, *by_hand(t)) for i, t in rows), key=repr)


@pytest.mark.parametrize("text,labels,base", [
    ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0", "apache"),
    ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3.0-or-later", ""),
    ("SPDX-License-Identifier: MIT-0", "mit-0", ""),
    ("under CC BY-SA 4.0", "cc-by,cc-by-sa-4.0", "cc-by"),
    ("The MIT License. See the LICENSE file.", "mit,unknown", "mit"),
    ("GNU General Public License v2", "gpl,gpl-2.0", "gpl"),
    ("er kommt mit license", "mit", "mit"), ("permit license", "", ""), ("mité license", "", ""), ("mit0 licenseX", "", ""),
])
def test_stronger_and_longer_matches_suppress_those_within(text, labels, base):
    assert by_hand(text)[4:6] == (base, labels)


def test_suppression_by_priority_length_and_order():
    rules = [Rule("a", "long", 2, 1.0, ("b",), "a b c"), Rule("b", "short", 2, 1.0, ("b",), "b"), Rule("c", "same", 2, 1.0, ("b",), "a b c"),
             Rule("d", "low", 1, 1.0, ("d",), "a b c d"), Rule("e", "lower", 1, 1.0, ("d",), "d")]
    scanner = Scanner(rules, ())
    rule, start, end = scanner.matches(b"a b c d e b", list(range(5)))
    keep = scanner.kept(rule, start, end)
    assert sorted(zip(rule[keep].tolist(), start[keep].tolist(), end[keep].tolist())) == [(0, 0, 3), (1, 5, 6), (3, 0, 4)]


def test_keywords_are_in_every_match():
    assert keywords("(?:gnu )?gpl (?:version |v )?3(?: 0)?") == ("gpl", "3")
    assert keywords("a share ?alike licen[sc]e(?: v)? 4") == ("4",)
    with pytest.raises(ValueError):
        keywords("(?:a|b)")


def test_odd_rows_long_texts_and_empty_tables(spark):
    many = "MIT License " * 30_000 + words(3, 50_000) + " cc-by"
    rows = [(r.doc_id, r.text) for r in odd(spark).collect()]
    found = licenses.licenses(odd(spark))
    assert plain(found) == sorted(((i, *by_hand(t)) for i, t in rows), key=repr)
    assert plain(licenses.licenses(empty(spark))) == []
    one = licenses.licenses(spark.createDataFrame([(1, many), (None, "cc by"), (1, "İ CC BY cc by")], "doc_id long, text string"))
    assert plain(one)[:2] == [
        (1, 110_002, 30_001, 0, 110_000, "cc-by,mit", "cc-by,mit", 0.8), (1, 4, 1, 2, 2, "cc-by", "cc-by", 0.8)]
    clash = odd(spark).withColumns({"text_": F.lit(0), "places": F.lit(1)})
    kept = licenses.scan(clash, ["doc_id", "text", "text_", "places"])
    assert kept.columns == ["doc_id", "text", "text_", "places", "n_words", "places_"] and kept.count() == len(rows)


def test_places_carry_the_words(spark):
    found = licenses.scan(spark.createDataFrame([(1, "x: the Apache-License 2.0!")], "doc_id long, text string"), ["doc_id"]).first()
    assert [(p.label, p.base, p.start, p.end, p.words) for p in found.places] == [
        ("apache", True, 2, 4, "apache license"), ("apache-2.0", False, 2, 6, "apache license 2 0")]
