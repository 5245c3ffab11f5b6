"""The rules of the license scan: regular expressions over words in lower case, joined by single spaces.

A rule is tried where its first word stands, and only if its keyword is among the next ``WINDOW`` words.  Rules are
ordered: of two detections one inside the other, the one of the earlier rule stays.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: Words that a rule may look at.
WINDOW = 24
#: Phrases whose places are counted, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Every rule and phrase holds one of these, so a text without any is passed over.
STEMS = ("licen", "lizenz", "rights", "rechte", "droits", "derechos", "copyleft", "copyright", "permission", "warrant", "redistribut", "spdx", "cc", "dedicat", "commons", "gpl", "gfdl", "permitted", "unencumber", "reproduc", "endorse")

_L = "licen[cs]e"
_V = "(?:version |v |v)?"
#: How sure a tag, a full text, a grant, a title with a version and one without make.
TAG, TEXT, GRANT, TITLE, FAMILY = 1.0, 0.95, 0.9, 0.7, 0.5

#: Openers of a grant; the first words are treated alike.
OPENERS = ("licensed", "released", "distributed", "published", "available", "provided", "redistributed", "covered", "offered")
_OPENER = f"(?:{'|'.join(OPENERS)}) under (?:the |a |an )?(?:terms (?:and conditions )?of |conditions of )?(?:the |a |an )?"

#: Titles of licenses: label, keyword, expression; special ones before general ones.
TITLES = [
    ("apache-2.0", "apache", f"apache (?:software |public )?{_L} {_V}2(?: 0)?"),
    ("apache-1.1", "apache", f"apache (?:software |public )?{_L} {_V}1 1"),
    ("apache-1.0", "apache", f"apache (?:software |public )?{_L} {_V}1(?: 0)?"),
    ("apache", "apache", f"apache (?:software |public )?{_L}"),
    ("mit-0", "mit", f"mit no attribution {_L}"),
    ("mit-modern", "mit", f"mit {_L} modern variant"),
    ("mit", "mit", f"mit(?: x11| expat)?(?: style| type)? {_L}"),
    ("mit", "expat", f"expat {_L}"),
    ("x11", "x11", f"x11 {_L}"),
    ("bsd-0", "bsd", f"(?:0|zero) clause bsd(?: style)? {_L}"),
    ("bsd-1-clause", "bsd", f"(?:1|one) clause bsd(?: style)? {_L}"),
    ("bsd-2-clause-patent", "bsd", f"bsd (?:2|two) clause(?: plus)? patent {_L}"),
    ("bsd-2-clause", "bsd", f"(?:2|two) clause bsd(?: style)? {_L}"),
    ("bsd-2-clause", "bsd", f"bsd (?:2|two) clause(?: simplified)? {_L}"),
    ("bsd-2-clause", "bsd", f"simplified bsd {_L}"),
    ("bsd-2-clause", "freebsd", f"freebsd {_L}"),
    ("bsd-3-clause-clear", "bsd", f"bsd (?:3|three) clause clear {_L}"),
    ("bsd-3-clause", "bsd", f"(?:3|three) clause bsd(?: style)? {_L}"),
    ("bsd-3-clause", "bsd", f"bsd (?:3|three) clause(?: new| revised| new or revised)? {_L}"),
    ("bsd-3-clause", "bsd", f"(?:new|revised|modified) bsd {_L}"),
    ("bsd-4-clause", "bsd", f"(?:4|four) clause bsd(?: style)? {_L}"),
    ("bsd-4-clause", "bsd", f"bsd (?:4|four) clause(?: original| old)? {_L}"),
    ("bsd-4-clause", "bsd", f"original bsd {_L}"),
    ("bsd", "bsd", f"bsd(?: style| type)? {_L}"),
    ("mpl-2.0", "mozilla", f"mozilla public {_L} {_V}2(?: 0)?"),
    ("mpl-1.1", "mozilla", f"mozilla public {_L} {_V}1 1"),
    ("mpl-1.0", "mozilla", f"mozilla public {_L} {_V}1(?: 0)?"),
    ("mpl", "mozilla", f"mozilla public {_L}"),
    ("epl-2.0", "eclipse", f"eclipse public {_L} {_V}2(?: 0)?"),
    ("epl-1.0", "eclipse", f"eclipse public {_L} {_V}1(?: 0)?"),
    ("epl", "eclipse", f"eclipse public {_L}"),
    ("edl-1.0", "eclipse", f"eclipse distribution {_L} {_V}1(?: 0)?"),
    ("cpl-1.0", "common", f"common public {_L}(?: {_V}1(?: 0)?)?"),
    ("ipl-1.0", "ibm", f"ibm public {_L}(?: {_V}1(?: 0)?)?"),
    ("cddl-1.1", "cddl", f"common development and distribution {_L} cddl {_V}1 1"),
    ("cddl-1.1", "development", f"common development and distribution {_L} {_V}1 1"),
    ("cddl-1.0", "development", f"common development and distribution {_L}(?: cddl)? {_V}1(?: 0)?"),
    ("cddl", "development", f"common development and distribution {_L}"),
    ("cpal-1.0", "attribution", f"common public attribution {_L}(?: {_V}1(?: 0)?)?"),
    ("eupl-1.2", "european", f"european union public {_L} {_V}1 2"),
    ("eupl-1.1", "european", f"european union public {_L} {_V}1 1"),
    ("eupl", "european", f"european union public {_L}"),
    ("artistic-2.0", "artistic", f"artistic {_L} {_V}2(?: 0)?"),
    ("artistic-1.0", "artistic", f"artistic {_L} {_V}1(?: 0)?"),
    ("artistic", "artistic", f"(?:perl )?artistic {_L}"),
    ("isc", "isc", f"isc(?: style)? {_L}"),
    ("isc", "internet", f"internet (?:systems|software) consortium {_L}"),
    ("zlib", "zlib", f"zlib(?: libpng)?(?: style)? {_L}"),
    ("libpng", "libpng", f"libpng {_L}(?: {_V}2(?: 0)?)?"),
    ("libpng", "png", f"png reference library {_L}(?: {_V}2(?: 0)?)?"),
    ("bsl-1.0", "boost", f"boost software {_L}(?: {_V}1(?: 0)?)?"),
    ("busl-1.1", "business", f"business source {_L}(?: {_V}1 1)?"),
    ("sspl-1.0", "server", f"server side public {_L}(?: {_V}1(?: 0)?)?"),
    ("elastic-2.0", "elastic", f"elastic {_L}(?: {_V}2(?: 0)?)?"),
    ("unlicense", "unlicense", "the unlicense"),
    ("wtfpl", "want", f"do what the (?:fuck|f|hell) you want to public {_L}"),
    ("beerware", "beerware", f"beerware {_L}"),
    ("beerware", "beer", f"beer ware {_L}"),
    ("psf-2.0", "python", f"python software foundation {_L}(?: {_V}2(?: 0)?)?"),
    ("python", "python", f"python {_L}"),
    ("php-3.01", "php", f"php {_L} {_V}3 01"),
    ("php-3.0", "php", f"php {_L} {_V}3(?: 0)?"),
    ("php", "php", f"php {_L}"),
    ("ruby", "ruby", f"ruby {_L}"),
    ("postgresql", "postgresql", f"postgresql {_L}"),
    ("openssl", "openssl", f"openssl {_L}"),
    ("openldap", "openldap", f"openldap public {_L}"),
    ("w3c", "w3c", f"w3c (?:software (?:notice and )?|document )?{_L}"),
    ("unicode", "unicode", f"unicode (?:data files and software )?{_L}(?: agreement)?"),
    ("ofl-1.1", "font", f"(?:sil )?open font {_L}(?: {_V}1 1)?"),
    ("ofl-1.0", "font", f"(?:sil )?open font {_L} {_V}1 0"),
    ("odbl-1.0", "database", f"open database {_L}(?: odbl)?(?: {_V}1(?: 0)?)?"),
    ("odc-by-1.0", "commons", f"open data commons attribution {_L}(?: {_V}1(?: 0)?)?"),
    ("pddl-1.0", "dedication", f"(?:open data commons )?public domain dedication and {_L}(?: {_V}1(?: 0)?)?"),
    ("cdla-permissive-2.0", "community", f"community data {_L} agreement permissive {_V}2(?: 0)?"),
    ("cdla-permissive-1.0", "community", f"community data {_L} agreement permissive(?: {_V}1(?: 0)?)?"),
    ("cdla-sharing-1.0", "community", f"community data {_L} agreement sharing(?: {_V}1(?: 0)?)?"),
    ("ogl-uk-3.0", "government", f"open government {_L} {_V}3(?: 0)?"),
    ("ogl-uk-2.0", "government", f"open government {_L} {_V}2(?: 0)?"),
    ("ogl-uk", "government", f"open government {_L}"),
    ("etalab-2.0", "ouverte", "licence ouverte (?:open licence )?(?:etalab )?(?:version |v |v)?2(?: 0)?"),
    ("etalab", "ouverte", "licence ouverte"),
    ("dl-de-by-2.0", "datenlizenz", "datenlizenz deutschland namensnennung (?:version )?2 0"),
    ("dl-de-zero-2.0", "datenlizenz", "datenlizenz deutschland zero (?:version )?2 0"),
    ("cecill-2.1", "cecill", f"cecill (?:free software )?{_L}(?: agreement)? {_V}2 1"),
    ("cecill", "cecill", f"cecill (?:free software )?{_L}"),
    ("ms-pl", "microsoft", f"microsoft public {_L}"),
    ("ms-rl", "microsoft", f"microsoft reciprocal {_L}"),
    ("apsl-2.0", "apple", f"apple public source {_L}(?: {_V}2(?: 0)?)?"),
    ("afl-3.0", "academic", f"academic free {_L}(?: {_V}3(?: 0)?)?"),
    ("osl-3.0", "open", f"open software {_L}(?: {_V}3(?: 0)?)?"),
    ("qpl-1.0", "q", f"q public {_L}(?: {_V}1(?: 0)?)?"),
    ("lppl-1.3c", "latex", f"latex project public {_L} {_V}1 3(?:c| c)?"),
    ("lppl", "latex", f"latex project public {_L}"),
    ("ncsa", "illinois", f"university of illinois(?: ncsa)? open source {_L}"),
    ("upl-1.0", "universal", f"universal permissive {_L}(?: {_V}1(?: 0)?)?"),
    ("vim", "vim", f"vim {_L}"),
    ("tcl", "tcl", f"tcl(?: tk)? {_L}"),
    ("zpl-2.1", "zope", f"zope public {_L}(?: {_V}2 1)?"),
    ("ecl-2.0", "educational", f"educational community {_L}(?: {_V}2(?: 0)?)?"),
    ("mulan-2.0", "mulan", f"mulan permissive software {_L} {_V}2(?: 0)?"),
    ("openrail-m", "openrail", f"(?:bigscience |creativeml )?openrail(?: m| rail)? {_L}"),
    ("llama-3", "llama", f"(?:meta )?llama 3(?: 1| 2| 3)? community {_L}"),
    ("llama-2", "llama", f"(?:meta )?llama 2 community {_L}"),
    ("gfdl", "documentation", f"(?:gnu )?free documentation {_L}"),
    ("proprietary", "proprietary", f"proprietary (?:software )?{_L}(?: agreement)?"),
    ("eula", "end", f"end user {_L} agreement"),
]

#: Passages of license texts and notices: label, keyword, expression.
PASSAGES = [
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "warranty", "the software is provided as is without warranty of any kind"),
    ("isc", "purpose", "permission to use copy modify and or distribute this software for any purpose"),
    ("hpnd", "documentation", "permission to use copy modify and distribute this software and its documentation"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-2-clause", "redistributions", "redistributions of source code must retain the above copyright notice"),
    ("bsd-3-clause", "endorse", "neither the name of (?:the )?(?:copyright holder|author|authors) nor the names of its contributors may be used to endorse"),
    ("apache-2.0", "compliance", f"you may not use this file except in compliance with the {_L}"),
    ("apache-2.0", "express", "warranties or conditions of any kind either express or implied"),
    ("gpl", "redistribute", f"you can redistribute it and or modify it under the terms of the gnu general public {_L}"),
    ("lgpl", "redistribute", f"you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public {_L}"),
    ("agpl", "affero", f"you can redistribute it and or modify it under the terms of the gnu affero general public {_L}"),
    ("copyleft", "verbatim", f"everyone is permitted to copy and distribute verbatim copies of this {_L} document"),
    ("zlib", "anyone", "permission is granted to anyone to use this software for any purpose"),
    ("unlicense", "unencumbered", "free and unencumbered software released into the public domain"),
    ("cc0-1.0", "dedicated", "dedicated to the public domain under (?:the )?(?:cc0|creative commons zero)"),
    ("public-domain", "dedicated", "dedicated to the public domain"),
    ("no-derivatives", "permission", "may not be (?:reproduced|copied|distributed)(?: or (?:reproduced|copied|distributed))? without (?:prior |express )?(?:written )?permission"),
    ("reserved", "reproduced", "no part of this (?:publication|book|work|website|document) may be reproduced"),
    ("reserved", "rights", "all rights reserved(?: worldwide)?"),
    ("some-reserved", "rights", "some rights reserved"),
    ("no-rights-reserved", "rights", "no rights reserved"),
    ("reserved", "rechte", "alle rechte vorbehalten"),
    ("reserved", "droits", "tous droits réservés"),
    ("reserved", "derechos", "todos los derechos reservados"),
    ("unlicensed", "unlicensed", "unlicensed proprietary"),
    ("copyleft", "copyleft", f"copyleft {_L}"),
]


def _gnu() -> list[tuple[str, str, str]]:
    """The GNU family: names, versions, and whether later ones may be chosen."""
    names = [
        ("agpl", "affero", f"(?:gnu )?affero general public {_L}", ["3"]),
        ("lgpl", "general", f"(?:gnu )?(?:lesser|library) general public {_L}", ["2 1", "3", "2"]),
        ("gfdl", "documentation", f"(?:gnu )?free documentation {_L}", ["1 1", "1 2", "1 3"]),
        ("gpl", "general", f"(?:gnu )?general public {_L}", ["1", "2", "3"]),
    ]
    rules = []
    for label, keyword, name, versions in names:
        for version in versions:
            dotted = version.replace(" ", ".") if " " in version else f"{version}.0"
            text = version if " " in version else f"{version}(?: 0)?"
            rules.append((f"{label}-{dotted}-or-later", keyword, f"{name} {_V}{text}(?: of the {_L})? or (?:at your option )?(?:any )?(?:later|newer)"))
            rules.append((f"{label}-{dotted}-only", keyword, f"{name} {_V}{text} only"))
            rules.append((f"{label}-{dotted}", keyword, f"{name} {_V}{text}"))
            rules.append((f"{label}-{dotted}", label, f"{label} {_V}{text}"))
            rules.append((f"{label}-{dotted}", f"{label}v{version[0]}", f"{label}v{text}"))
        rules.append((label, keyword, name))
    return rules


def _creative_commons() -> list[tuple[str, str, str]]:
    """The Creative Commons family: conditions and versions, in short and in words."""
    words = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(?:s|ative|atives)(?: works)?", "sa": "share ?alike"}
    rules = []
    for conditions in ("by nc nd", "by nc sa", "by nc", "by nd", "by sa", "by"):
        long = "creative commons " + " ".join(words[c] for c in conditions.split())
        for version in ("4 0", "3 0", "2 5", "2 0", "1 0", ""):
            label = "-".join(["cc", *conditions.split(), *([version.replace(" ", ".")] if version else [])])
            ported = f" {_V}{version}(?: international| unported| generic)?" if version else ""
            rules.append((label, "cc", f"cc {conditions}{ported}"))
            rules.append((label, "commons", f"{long}{ported}(?: (?:public )?{_L})?"))
    rules.append(("cc0-1.0", "cc0", "cc0(?: 1 0)?(?: universal)?"))
    rules.append(("cc0-1.0", "zero", "creative commons zero(?: 1 0)?"))
    rules.append(("creative-commons", "commons", f"creative commons {_L}"))
    return rules


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches from the start of a window of words, each followed by a space."""

    first: str
    keyword: str
    pattern: str
    label: str
    strength: float
    number: int


def _first_words(pattern: str) -> list[str]:
    """The words with which a match can start: a plain word, a choice of words, or either after an optional one."""
    if not pattern.startswith("(?:"):
        return [re.match(r"[^\W_]+", pattern).group()]
    inside, rest = pattern[3:].split(")", 1)
    words = [choice.split(" ")[0] for choice in inside.split("|")]
    return words + (_first_words(rest[1:]) if rest.startswith("?") else [])


def _rules() -> list[Rule]:
    titles = [*_creative_commons(), *_gnu(), *TITLES]
    ordered = [(label, "spdx", f"spdx {_L} identifier {re.sub('[-.]', ' ', label)}", TAG) for label in dict.fromkeys(t[0] for t in titles)]
    # a longer identifier before those that are its beginning
    ordered.sort(key=lambda rule: -len(rule[2]))
    ordered += [(label, keyword, pattern, TEXT) for label, keyword, pattern in PASSAGES]
    ordered += [(label, keyword, _OPENER + pattern, GRANT) for label, keyword, pattern in titles]
    ordered += [(label, keyword, pattern, TITLE if label[-1].isdigit() else FAMILY) for label, keyword, pattern in titles]
    return [
        Rule(first, keyword, f"^(?:{pattern}) ", label, strength, number)
        for number, (label, keyword, pattern, strength) in enumerate(ordered)
        for first in (["licensed"] if pattern.startswith(_OPENER) else dict.fromkeys(_first_words(pattern)))
    ]


#: All rules, in their order; those of a grant stand under the first opener.
RULES = _rules()
