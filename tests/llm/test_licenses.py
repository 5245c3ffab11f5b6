"""License scans against SQL and plain Python."""

import random
import re
from re import _parser as parser

import pytest

from freight.llm import licenses
from freight.llm.license_rules import OPENERS, PHRASES, RULES, STEMS, WINDOW
from freight.llm.queries import ORACLES, QUERIES
from tests.llm.sql_check import same, sql_rows

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

PATTERNS = [(rule, re.compile(rule.pattern)) for rule in {rule.number: rule for rule in RULES}.values()]


def plain(text):
    """Every rule at every word."""
    words = re.findall(licenses.WORD, (text or "").translate(_LOWER))
    base = [(i, label) for i in range(len(words)) for phrase, label in PHRASES.items() if words[i : i + len(phrase.split())] == phrase.split()]
    found = []
    for i in range(len(words)):
        window = " ".join(words[i : i + WINDOW]) + " "
        for rule, pattern in PATTERNS:
            if match := pattern.match(window):
                found.append((i, i + match.group().count(" "), rule.number, rule.label, rule.strength))
    kept = [d for d in found if not any(e[0] <= d[0] and e[1] >= d[1] and e[2] < d[2] for e in found)]
    labels = {label for _, label in base}
    return (
        len(words), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None),
        ",".join(sorted(labels)), ",".join(sorted(labels | {d[3] for d in kept})), max([0.0, *(0.5 for _ in base), *(d[4] for d in kept)]),
    )


def sample(tree, pick):
    """A text that a rule's expression matches; choices and optional parts by chance."""
    out = ""
    for kind, value in tree:
        name = str(kind)
        if name == "LITERAL":
            out += chr(value)
        elif name == "IN":
            out += chr(pick.choice([x for _, x in value]))
        elif name == "BRANCH":
            out += sample(pick.choice(value[1]), pick)
        elif name == "SUBPATTERN":
            out += sample(value[3], pick)
        elif name == "MAX_REPEAT":
            assert value[:2] == (0, 1), "rules match a bounded number of words"
            out += sample(value[2], pick) if pick.random() < 0.5 else ""
        else:
            assert name == "AT"
    return out


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    same(QUERIES["op11_licenses"](spark, folder), *sql_rows(folder, ORACLES["op11_licenses"]))


def test_every_rule_is_reached():
    """Gate, first word and keyword never pass over a text that the expression matches."""
    pick = random.Random(1)
    assert len({rule.number for rule in RULES}) > 300
    for rule in RULES:
        for _ in range(12):
            text = sample(parser.parse(rule.pattern), pick)
            words = text.split()
            assert re.match(rule.pattern, text) and len(words) <= WINDOW
            firsts = {other.first for other in RULES if other.number == rule.number}
            assert words[0] in (OPENERS if rule.first == OPENERS[0] else firsts)
            assert rule.keyword in words and any(stem in text for stem in STEMS), (rule, text)


def test_samples_of_every_rule(spark):
    pick = random.Random(2)
    noise = ["the", "CC", "by", "License", "café", "gnu", "General", "public", "2.0", "rights", "all", "under", "the", "mit"]
    rows = []
    for i in range(0, len(RULES), 3):
        parts = [" ".join(pick.choices(noise, k=pick.randint(0, 6)))]
        for rule in RULES[i : i + 3]:
            text = sample(parser.parse(rule.pattern), pick).strip()
            parts.append(pick.choice([text, text.upper(), text.replace(" ", "-"), text.title().replace(" ", ",\n")]))
            parts.append(" ".join(pick.choices(noise, k=pick.randint(0, 4))))
        rows.append((i, pick.choice([" ", " (", "; "]).join(parts)))
    found = licenses.summaries(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in found) == sorted((key, *plain(text)) for key, text in rows)


def test_detections(spark):
    text = "Copyright. Released under the terms of the GNU General Public License, version 3 or any later version; docs under CC BY-NC-SA 4.0, all rights reserved."
    row = licenses.scan_documents(spark.createDataFrame([(text,)], "text string")).first().licenses
    assert [(d.first, d.past, d.label) for d in row.found] == [(1, 16, "gpl-3.0-or-later"), (19, 25, "cc-by-nc-sa-4.0"), (25, 28, "reserved")]
    assert [(b.first, b.label) for b in row.base] == [(8, "gpl"), (19, "cc-by"), (25, "reserved")]


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "cc by"), (None, "cc by"), (3, "!?"), (4, "cc-BY cc by CC,by"), (5, "Kelvin K lİcense LICENSE mit license"), (6, "cc0"),
            (7, "\x00cc\x00by\x7fall rights\nreserved"), (8, "x " * 9000 + "MIT License" + " y" * 9000), (9, "mit licence " * 500), (10, "général public license ſcc by")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'l' as Licenses", "1 as n_words", "2 as words", "3 as found", "4 as base")
    found = licenses.summaries(frame).collect()
    assert sorted(map(str, (tuple(r) for r in found))) == sorted(str((key, *plain(text))) for key, text in rows)
    assert licenses.scan_documents(frame).columns == ["doc_id", "text", "licenses", "n_words", "words", "found", "base"]
    assert licenses.summaries(frame.limit(0)).count() == 0
