"""License scans by ordered signature rules.

Hundreds of regular expressions (``license_rules``) run over the words of a text.  A text without any stem is passed
over after counting its words.  In the others a rule is tried only where its first word stands, and only if its keyword is
among the words that follow, so almost every rule is ruled out by comparing words.  Detections are
intervals of words.  One that lies within the interval of an earlier rule's detection is suppressed; others may
overlap.

All of it is expressions of built-in functions in one projection: no shuffle, no join.  A text's detections start at
different words and reach at most ``WINDOW`` words, so each is compared with a bounded number of others.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freight.llm.license_rules import OPENERS, PHRASES, RULES, STEMS, WINDOW, Rule

#: A word, once A-Z are lower-cased; and before.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RULE = "array<struct<keyword:string,pattern:string,rule:int,label:string,strength:double>>"
_BASE = "array<struct<first:int,label:string>>"
_FOUND = "array<struct<first:int,past:int,rule:int,label:string,strength:double>>"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _rule_table(rules: list[Rule]) -> Column:
    """First word to its rules: one constant."""
    by_first: dict[str, list[dict]] = {}
    for rule in rules:
        fields = {"keyword": rule.keyword, "pattern": rule.pattern, "rule": rule.number, "label": rule.label, "strength": rule.strength}
        by_first.setdefault(rule.first, []).append(fields)
    return F.from_json(F.lit(json.dumps(by_first)), f"map<string,{_RULE}>")


def _detections(words: Column, places: Column, rules: list[Rule]) -> Column:
    """An array for each place where a rule matches, in order, of the detections that start there."""
    table = _rule_table(rules)
    openers = [opener for opener in OPENERS if opener != OPENERS[0]]

    def at(place: Column) -> Column:
        first = F.get(words, place)
        own = F.element_at(table, F.when(first.isin(openers), F.lit(OPENERS[0])).otherwise(first))

        def matched(window: Column) -> Column:
            text = F.concat(F.array_join(window, " "), F.lit(" "))
            fitting = F.filter(own, lambda rule: F.array_contains(window, rule["keyword"]) & F.rlike(text, rule["pattern"]))

            def detection(rule: Column) -> Column:
                length = F.size(F.split(F.regexp_substr(text, rule["pattern"]), " ")) - 1
                return F.struct(
                    place.alias("first"), (place + length).alias("past"), rule["rule"].alias("rule"), rule["label"].alias("label"), rule["strength"].alias("strength")
                )

            return F.transform(fitting, detection)

        return _let(F.slice(words, place + 1, WINDOW), matched)

    return F.filter(F.transform(places, at), lambda found: F.size(found) > 0)


def _kept(found: Column) -> Column:
    """The detections that no earlier rule's interval contains."""

    def one(group: Column, i: Column) -> Column:
        near = F.flatten(F.slice(found, F.greatest(i + 2 - WINDOW, F.lit(1)), F.least(i + 1, F.lit(WINDOW))))

        def free(detection: Column) -> Column:
            return ~F.exists(
                near, lambda other: (other["first"] <= detection["first"]) & (other["past"] >= detection["past"]) & (other["rule"] < detection["rule"])
            )

        return F.filter(group, free)

    return F.flatten(F.transform(found, one))


def scan(text: Column, rules: list[Rule] = RULES) -> Column:
    """``struct<n_words, base:array<first, label>, found:array<first, past, rule, label, strength>>`` of a text.

    ``base`` has every place where the words of a phrase of ``PHRASES`` stand, ``found`` the detections that are left;
    places are numbers of words from 0, ``past`` the one behind the last.
    """
    text = F.coalesce(text, F.lit(""))
    lowered = F.lower(text)
    gate = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(stem)) for stem in STEMS])
    phrases = {tuple(phrase.split()): label for phrase, label in PHRASES.items()}
    starts = sorted({rule.first for rule in rules} | set(OPENERS) | {phrase[0] for phrase in phrases})

    def scanned(words: Column) -> Column:
        # a text that passed the gate has a word
        numbers = F.sequence(F.lit(0), F.size(words) - 1)

        def base(places: Column) -> Column:
            def label(place: Column) -> Column:
                choices = [
                    F.when(reduce(lambda a, b: a & b, [F.get(words, place + i) == word for i, word in enumerate(phrase)]), F.lit(label))
                    for phrase, label in phrases.items()
                ]
                return F.struct(place.alias("first"), F.coalesce(*choices).alias("label"))

            return F.filter(F.transform(places, label), lambda found: found["label"].isNotNull())

        def results(places: Column) -> Column:
            kept = _let(_detections(words, places, rules), _kept)
            return F.struct(F.size(words).cast("long").alias("n_words"), base(places).cast(_BASE).alias("base"), kept.cast(_FOUND).alias("found"))

        return _let(F.filter(numbers, lambda i: F.get(words, i).isin(starts)), results)

    nothing = F.struct(
        F.regexp_count(text, F.lit(_ANY_CASE)).cast("long").alias("n_words"), F.array().cast(_BASE).alias("base"), F.array().cast(_FOUND).alias("found")
    )
    words = F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(WORD), F.lit(0))
    return F.when(gate, _let(words, scanned)).otherwise(nothing)


def scan_documents(documents: DataFrame, text: str = "text", into: str = "licenses", rules: list[Rule] = RULES) -> DataFrame:
    """``documents`` with a column ``into`` (see ``scan``), in place of one of that name; every row is kept.

    Null and empty texts have no words and no detections; repeated rows are scanned alike.  Columns of other names play
    no part.
    """
    return documents.withColumn(into, scan(F.col(text), rules))


def summaries(documents: DataFrame) -> DataFrame:
    """Of each document the counts and places of phrases, the labels, and how sure the surest detection makes (a phrase alone: 0.5)."""
    rows = scan_documents(documents.select("doc_id", "text")).select("doc_id", "licenses.*")
    places, phrase_labels = F.transform("base", lambda x: x["first"]), F.transform("base", lambda x: x["label"])
    labels = F.concat(phrase_labels, F.transform("found", lambda x: x["label"]))

    def joined(values: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(values)), ",")

    strengths = F.concat(F.array(F.lit(0.0)), F.transform("base", lambda x: F.lit(0.5)), F.transform("found", lambda x: x["strength"]))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        joined(phrase_labels).alias("base_labels"),
        joined(labels).alias("labels"),
        F.array_max(strengths).alias("score"),
    )


def oracle(rules: list[Rule] = RULES) -> str:
    """The summaries in SQL for DuckDB, by a join of all windows and rules."""
    table = ",\n".join(f"('{r.first}', '{r.keyword}', '{r.pattern}', '{r.label}', {r.strength}, {r.number})" for r in rules)
    openers = ", ".join(f"'{opener}'" for opener in OPENERS[1:])
    phrases = ",\n".join(f"('{phrase}', {len(phrase.split())}, '{label}')" for phrase, label in PHRASES.items())
    return f"""
with rules(first, keyword, pattern, label, strength, number) as (values {table}),
phrases(phrase, n, label) as (values {phrases}),
texts as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') as w from documents),
places as (select r, unnest(w) as word, generate_subscripts(w, 1) - 1 as i from texts),
bases as (select r, i, label from places join phrases on word = split_part(phrase, ' ', 1) join texts using (r) where array_to_string(w[i + 1 : i + n], ' ') = phrase),
windows as (select r, i, w[i + 1 : i + {WINDOW}] as near, case when word in ({openers}) then '{OPENERS[0]}' else word end as word
  from (select * from places where word in (select first from rules) or word in ({openers})) join texts using (r)),
found as (select r, i as first, i + len(string_split(regexp_extract(array_to_string(near, ' ') || ' ', pattern), ' ')) - 1 as past, number, label, strength
  from windows join rules on word = rules.first and list_contains(near, keyword) and regexp_matches(array_to_string(near, ' ') || ' ', pattern)),
kept as (select * from found d where not exists (select 1 from found e where e.r = d.r and e.first <= d.first and e.past >= d.past and e.number < d.number)),
base as (select r, count(*) as n, min(i) as first_word, max(i) as last_word, string_agg(distinct label, ',' order by label) as labels from bases group by r),
every as (select r, string_agg(distinct label, ',' order by label) as labels, max(strength) as score
  from (select r, label, strength from kept union all select r, label, 0.5 from bases) group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(base.n, 0) as n_base, cast(first_word as bigint) as first_word, cast(last_word as bigint) as last_word,
  coalesce(base.labels, '') as base_labels, coalesce(every.labels, '') as labels, cast(coalesce(score, 0) as double) as score
from texts left join base using (r) left join every using (r)
"""


ORACLE = oracle()
