"""License names and sentences, from which the ordered signature rules are made.

Patterns match texts reduced to lower-case words with one blank between them;
keywords are beginnings of words. ``{n}`` in a template is the license's name
pattern.
"""

from __future__ import annotations

from dataclasses import dataclass

#: label, name patterns, keywords of which the text must hold one.
NAMES = [
    ("agpl-3.0", [r"(?:gnu )?affero general public license(?: agpl)?(?: (?:v(?:ersion)? ?)?3(?: 0)?)?", r"agpl ?v?3(?: 0)?(?: only| or later)?", r"agpl"], ("affero", "agpl")),
    ("lgpl-2.1", [r"(?:gnu )?lesser general public license (?:v(?:ersion)? ?)?2 1", r"lgpl ?v?2 1(?: only| or later)?"], ("lesser", "lgpl")),
    ("lgpl-3.0", [r"(?:gnu )?lesser general public license (?:v(?:ersion)? ?)?3(?: 0)?", r"lgpl ?v?3(?: 0)?(?: only| or later)?"], ("lesser", "lgpl")),
    ("lgpl", [r"(?:gnu )?(?:lesser|library) general public license", r"lgpl"], ("lesser", "library general", "lgpl")),
    ("gpl-2.0", [r"(?:gnu )?general public license (?:v(?:ersion)? ?)?2(?: 0)?", r"gnu gpl v?2", r"gpl ?v?2(?: 0)?(?: only| or later)?"], ("general", "gpl")),
    ("gpl-3.0", [r"(?:gnu )?general public license (?:v(?:ersion)? ?)?3(?: 0)?", r"gnu gpl v?3", r"gpl ?v?3(?: 0)?(?: only| or later)?"], ("general", "gpl")),
    ("gpl", [r"gnu general public license", r"gnu gpl", r"gpl"], ("gnu", "gpl")),
    ("gfdl-1.3", [r"gnu free documentation license(?: (?:v(?:ersion)? ?)?1 [123])?", r"gfdl(?: 1 [123])?"], ("documentation", "gfdl")),
    ("apache-1.1", [r"apache(?: software)? license (?:v(?:ersion)? ?)?1 1", r"apache 1 1"], ("apache",)),
    ("apache-2.0", [r"apache(?: software)? license (?:v(?:ersion)? ?)?2(?: 0)?", r"apache ?v?2(?: 0)?", r"asl 2 0", r"apl 2 0"], ("apache", "asl 2", "apl 2")),
    ("apache", [r"apache(?: software)? license"], ("apache",)),
    ("mit-0", [r"mit no attribution(?: license)?", r"mit 0"], ("mit",)),
    ("mit", [r"mit license", r"mit x11 license", r"expat license", r"x11 license"], ("mit", "expat", "x11")),
    ("bsd-4-clause", [r"(?:4|four) clause bsd(?: license)?", r"bsd 4 clause(?: license)?", r"original bsd license"], ("bsd",)),
    ("bsd-3-clause", [r"(?:3|three) clause bsd(?: license)?", r"bsd 3 clause(?: license)?", r"(?:new|modified|revised) bsd license"], ("bsd",)),
    ("bsd-2-clause", [r"(?:2|two) clause bsd(?: license)?", r"bsd 2 clause(?: license)?", r"(?:simplified|freebsd) (?:bsd )?license"], ("bsd", "simplified", "freebsd")),
    ("0bsd", [r"zero clause bsd(?: license)?", r"0bsd", r"bsd zero clause"], ("bsd", "0bsd")),
    ("bsd", [r"bsd(?: style)? license", r"berkeley software distribution license"], ("bsd", "berkeley")),
    ("isc", [r"isc license", r"internet (?:systems|software) consortium license"], ("isc", "consortium")),
    ("mpl-1.1", [r"mozilla public license (?:v(?:ersion)? ?)?1 1", r"mpl ?v?1 1"], ("mozilla", "mpl")),
    ("mpl-2.0", [r"mozilla public license (?:v(?:ersion)? ?)?2(?: 0)?", r"mpl ?v?2(?: 0)?"], ("mozilla", "mpl")),
    ("mpl", [r"mozilla public license"], ("mozilla",)),
    ("epl-1.0", [r"eclipse public license (?:v(?:ersion)? ?)?1(?: 0)?", r"epl ?v?1(?: 0)?"], ("eclipse", "epl")),
    ("epl-2.0", [r"eclipse public license (?:v(?:ersion)? ?)?2(?: 0)?", r"epl ?v?2(?: 0)?"], ("eclipse", "epl")),
    ("edl-1.0", [r"eclipse distribution license(?: v?1(?: 0)?)?"], ("eclipse",)),
    ("cddl-1.0", [r"common development and distribution license(?: (?:v(?:ersion)? ?)?1(?: 0)?)?", r"cddl(?: 1 0)?"], ("common development", "cddl")),
    ("cpl-1.0", [r"common public license(?: (?:v(?:ersion)? ?)?1(?: 0)?)?"], ("common public",)),
    ("eupl-1.2", [r"european union public licen[cs]e(?: (?:v(?:ersion)? ?)?1 [12])?", r"eupl(?: 1 [12])?"], ("european", "eupl")),
    ("artistic-1.0", [r"artistic license (?:v(?:ersion)? ?)?1(?: 0)?", r"perl artistic license"], ("artistic",)),
    ("artistic-2.0", [r"artistic license (?:v(?:ersion)? ?)?2(?: 0)?"], ("artistic",)),
    ("artistic", [r"artistic license"], ("artistic",)),
    ("bsl-1.0", [r"boost software license(?: (?:v(?:ersion)? ?)?1(?: 0)?)?"], ("boost",)),
    ("busl-1.1", [r"business source license(?: v?1 1)?", r"busl 1 1"], ("business", "busl")),
    ("sspl-1.0", [r"server side public license(?: v?1)?", r"sspl(?: v?1)?"], ("server side", "sspl")),
    ("elastic-2.0", [r"elastic license(?: v?2(?: 0)?)?"], ("elastic",)),
    ("unlicense", [r"unlicense"], ("unlicense",)),
    ("wtfpl", [r"wtfpl", r"do what the f\w* you want to public license"], ("wtfpl", "do what the")),
    ("zlib", [r"zlib(?: libpng)? license"], ("zlib",)),
    ("libpng", [r"libpng license", r"png reference library license"], ("libpng", "png")),
    ("openssl", [r"openssl license", r"ssleay license"], ("openssl", "ssleay")),
    ("psf-2.0", [r"python software foundation license(?: (?:v(?:ersion)? ?)?2)?", r"psf license"], ("python", "psf")),
    ("php-3.01", [r"php license(?: (?:v(?:ersion)? ?)?3(?: 01)?)?"], ("php",)),
    ("ruby", [r"ruby license"], ("ruby",)),
    ("postgresql", [r"postgresql licen[cs]e"], ("postgresql",)),
    ("vim", [r"vim license"], ("vim",)),
    ("curl", [r"curl license"], ("curl",)),
    ("ncsa", [r"(?:university of illinois )?ncsa open source license"], ("ncsa",)),
    ("w3c", [r"w3c software (?:notice and )?license"], ("w3c",)),
    ("unicode", [r"unicode license(?: agreement)?"], ("unicode",)),
    ("icu", [r"icu license"], ("icu",)),
    ("ofl-1.1", [r"sil open font license(?: (?:v(?:ersion)? ?)?1 [01])?", r"ofl 1 [01]"], ("font", "ofl")),
    ("ms-pl", [r"microsoft public license", r"ms pl"], ("microsoft", "ms pl")),
    ("ms-rl", [r"microsoft reciprocal license", r"ms rl"], ("microsoft", "ms rl")),
    ("afl-3.0", [r"academic free license(?: (?:v(?:ersion)? ?)?3(?: 0)?)?"], ("academic",)),
    ("osl-3.0", [r"open software license(?: (?:v(?:ersion)? ?)?3(?: 0)?)?"], ("open software",)),
    ("qpl-1.0", [r"q public license(?: v?1(?: 0)?)?"], ("q public",)),
    ("sleepycat", [r"sleepycat license"], ("sleepycat",)),
    ("watcom-1.0", [r"sybase open watcom public license"], ("watcom",)),
    ("ecl-2.0", [r"educational community license(?: (?:v(?:ersion)? ?)?2(?: 0)?)?"], ("educational",)),
    ("upl-1.0", [r"universal permissive license(?: v?1(?: 0)?)?"], ("universal",)),
    ("mulan-psl-2.0", [r"mulan psl(?: v?2)?", r"mulan permissive software license(?: v?2)?"], ("mulan",)),
    ("blueoak-1.0.0", [r"blue oak model license(?: 1 0 0)?"], ("blue oak",)),
    ("odbl-1.0", [r"open (?:data commons )?(?:open )?database license", r"odbl(?: 1 0)?"], ("database", "odbl")),
    ("odc-by-1.0", [r"open data commons attribution license", r"odc by(?: 1 0)?"], ("data commons", "odc")),
    ("pddl-1.0", [r"public domain dedication and license", r"pddl"], ("public domain", "pddl")),
    ("cdla-permissive-2.0", [r"community data license agreement permissive(?: v?2(?: 0)?)?"], ("community data",)),
    ("cdla-sharing-1.0", [r"community data license agreement sharing"], ("community data",)),
    ("cc0-1.0", [r"cc0(?: 1 0)?", r"creative commons zero(?: v?1 0)?", r"cc zero"], ("cc0", "zero")),
    ("cc-by-nc-nd-4.0", [r"cc by nc nd 4 0", r"creative commons attribution non ?commercial no ?deriv\w* 4 0(?: international)?"], ("cc", "creative")),
    ("cc-by-nc-sa-4.0", [r"cc by nc sa 4 0", r"creative commons attribution non ?commercial share ?alike 4 0(?: international)?"], ("cc", "creative")),
    ("cc-by-nc-4.0", [r"cc by nc 4 0", r"creative commons attribution non ?commercial 4 0(?: international)?"], ("cc", "creative")),
    ("cc-by-nd-4.0", [r"cc by nd 4 0", r"creative commons attribution no ?deriv\w* 4 0(?: international)?"], ("cc", "creative")),
    ("cc-by-sa-4.0", [r"cc by sa 4 0", r"creative commons attribution share ?alike 4 0(?: international)?"], ("cc", "creative")),
    ("cc-by-4.0", [r"cc by 4 0", r"creative commons attribution 4 0(?: international)?"], ("cc", "creative")),
    ("cc-by-nc-nd-3.0", [r"cc by nc nd 3 0", r"creative commons attribution non ?commercial no ?deriv\w* 3 0(?: unported)?"], ("cc", "creative")),
    ("cc-by-nc-sa-3.0", [r"cc by nc sa 3 0", r"creative commons attribution non ?commercial share ?alike 3 0(?: unported)?"], ("cc", "creative")),
    ("cc-by-nc-3.0", [r"cc by nc 3 0", r"creative commons attribution non ?commercial 3 0(?: unported)?"], ("cc", "creative")),
    ("cc-by-sa-3.0", [r"cc by sa 3 0", r"creative commons attribution share ?alike 3 0(?: unported)?"], ("cc", "creative")),
    ("cc-by-3.0", [r"cc by 3 0", r"creative commons attribution 3 0(?: unported)?"], ("cc", "creative")),
    ("cc-by-nc", [r"cc by nc", r"creative commons attribution non ?commercial"], ("cc", "creative")),
    ("cc-by-sa", [r"cc by sa", r"creative commons attribution share ?alike"], ("cc", "creative")),
    ("cc-by", [r"cc by", r"creative commons attribution"], ("cc", "creative")),
    ("cc", [r"creative commons license"], ("creative",)),
    ("openrail", [r"(?:creativeml |bigscience )?open ?rail(?: m)?(?: license)?"], ("openrail", "open rail")),
]

#: Ways in which a name stands in a text: pattern, priority, confidence, keyword needed besides the name's.
TEMPLATES = [
    (r"spdx license identifier {n}", 100, 1.0, "spdx"),
    (r"licen[cs]ed (?:to you )?under(?: the)?(?: terms(?: and conditions)? of)?(?: the)? {n}", 80, 0.95, "licen"),
    (r"(?:released|distributed|published|available|made available|covered|governed|provided|shared) (?:under|by)(?: the)?(?: terms(?: and conditions)? of)?(?: the)? {n}", 75, 0.9, ""),
    (r"(?:terms(?: and conditions)?|copy|version|text) of(?: the)? {n}", 70, 0.85, ""),
    (r"{n}", 50, 0.7, ""),
]
#: The first so many of them also hold the license's short name, which alone says too little ("MIT", "ISC").
SHORT_FORMS = 3

#: Sentences of license texts and notices: label, pattern, priority, confidence, keyword.
SENTENCES = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", 90, 0.95, "hereby granted"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies", 85, 0.9, "permission notice"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee", 90, 0.95, "with or without fee"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification", 88, 0.9, "redistribution"),
    ("bsd-3-clause", r"neither the name of .{1,80}? nor the names of its contributors may be used to endorse", 92, 0.95, "neither the name"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software", 93, 0.95, "advertising materials"),
    ("bsd", r"redistributions of source code must retain the above copyright notice", 86, 0.9, "redistributions"),
    ("apache-2.0", r"you may not use this file except in compliance with the license", 90, 0.9, "in compliance"),
    ("apache-2.0", r"unless required by applicable law or agreed to in writing software distributed under the license", 89, 0.9, "applicable law"),
    ("gpl", r"this program is free software you can redistribute it and or modify it", 85, 0.9, "free software"),
    ("gpl", r"either version [23] of the license or (?:at your option )?any later version", 84, 0.85, "later version"),
    ("lgpl", r"this library is free software you can redistribute it", 87, 0.9, "free software"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license", 92, 0.95, "source code form"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", 95, 1.0, "unencumbered"),
    ("bsl-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy", 95, 0.95, "organization"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors", 88, 0.9, "in no event"),
    ("zlib", r"altered source versions must be plainly marked as such", 88, 0.9, "plainly marked"),
    ("public-domain", r"(?:dedicated|released|placed) (?:in|in ?to|to) the public domain", 80, 0.9, "public domain"),
    ("public-domain", r"public domain", 40, 0.6, "public domain"),
    ("proprietary", r"all rights reserved", 30, 0.5, "all rights"),
    ("proprietary", r"proprietary and confidential", 60, 0.8, "proprietary"),
    ("proprietary", r"unauthori[sz]ed (?:copying|use|distribution) .{0,40}?(?:is )?(?:strictly )?prohibited", 60, 0.8, "prohibited"),
    ("non-commercial", r"for non ?commercial (?:use|purposes) only", 60, 0.8, "non"),
    ("non-commercial", r"not (?:be used )?for commercial (?:use|purposes)", 60, 0.8, "commercial"),
    ("no-derivatives", r"no derivative works", 55, 0.7, "derivative"),
    ("no-training", r"may not be used (?:to|for) train(?:ing)?", 65, 0.9, "train"),
    ("free-unknown", r"free for (?:personal|any|all) (?:use|purposes?)", 45, 0.6, "free for"),
    ("permission", r"(?:used|reprinted|reproduced) (?:with|by) permission", 45, 0.6, "permission"),
    ("copyright", r"copyright (?:c )?(?:19|20)\d\d", 20, 0.4, "copyright"),
    ("copyright", r"(?:licen[cs]e|copyright) (?:notice|agreement|terms)", 15, 0.3, "licen|copyright"),
    ("mit", r"the software is provided as is without warranty of any kind express or implied", 84, 0.85, "provided as is"),
    ("bsd", r"this software is provided by the (?:copyright holders|regents|author)(?: and contributors)? as is", 84, 0.85, "provided by"),
    ("isc", r"the software is provided as is and the author disclaims all warranties", 90, 0.95, "disclaims all"),
    ("apache-2.0", r"grant of patent license subject to the terms and conditions of this license", 91, 0.95, "patent license"),
    ("gpl-3.0", r"you may convey verbatim copies of the program s source code", 91, 0.95, "convey verbatim"),
    ("gpl-2.0", r"you may copy and distribute verbatim copies of the program s source code", 91, 0.95, "distribute verbatim"),
    ("gpl", r"this program is distributed in the hope that it will be useful", 83, 0.85, "hope that"),
    ("lgpl", r"this library is distributed in the hope that it will be useful", 86, 0.9, "hope that"),
    ("agpl-3.0", r"offer all users interacting with it remotely through a computer network", 93, 0.95, "interacting with"),
    ("epl-2.0", r"this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", 92, 0.95, "accompanying materials"),
    ("cddl-1.0", r"the contents of this file are subject to the terms of the common development and distribution license", 92, 0.95, "common development"),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public license version 1 1", 92, 0.95, "mozilla public"),
    ("wtfpl", r"you just do what the f\w* you want to", 90, 0.95, "do what the"),
    ("cc-by", r"you are free to share copy and redistribute the material in any medium or format", 80, 0.85, "free to share"),
    ("cc", r"this work is licensed under a creative commons", 60, 0.75, "creative commons"),
    ("ofl-1.1", r"the font software may be sold as part of a larger software package", 90, 0.9, "font software"),
    ("proprietary", r"may not be (?:copied|reproduced|distributed|disclosed) .{0,60}?without (?:the )?(?:prior |express )?(?:written )?(?:permission|consent)", 60, 0.8, "without"),
    ("proprietary", r"for internal use only", 55, 0.7, "internal use"),
    ("evaluation", r"(?:for )?evaluation (?:purposes|use) only", 60, 0.8, "evaluation"),
    ("no-derivatives", r"may not (?:alter transform or build upon|be modified)", 55, 0.7, "may not"),
    ("no-training", r"no (?:text and data mining|data mining|machine learning|ai training)", 65, 0.9, "text and data|data mining|machine learning|ai training"),
    ("shareware", r"this is shareware", 60, 0.8, "shareware"),
    ("freeware", r"this (?:program|software) is freeware", 60, 0.8, "freeware"),
]


@dataclass(frozen=True)
class Signature:
    """One rule: what to find, its label, and what it yields to (the larger priority wins, then the earlier rule)."""

    order: int
    label: str
    pattern: str
    also: str
    priority: int
    confidence: float


@dataclass(frozen=True)
class Family:
    """Rules that can match only where ``name`` does, and only in texts with one of the keywords."""

    keywords: tuple[str, ...]
    name: str
    rules: tuple[Signature, ...]


def short(label: str) -> str:
    """The short name of a license as it stands in a reduced text."""
    return label.replace("-", " ").replace(".", " ") + "(?: only| or later)?"


def families() -> list[Family]:
    """Every name in every template, short names in the first ones, then the sentences; rules are numbered template by
    template, so that fuller forms come first."""
    names = [(label, name, keywords, len(TEMPLATES)) for label, patterns, keywords in NAMES for name in patterns]
    names += [(label, short(label), (label.partition("-")[0],), SHORT_FORMS) for label, _, _ in NAMES]
    out = []
    for i, (label, name, keywords, forms) in enumerate(names):
        rules = tuple(
            Signature(t * len(names) + i, label, pattern.replace("{n}", name), also, priority, confidence)
            for t, (pattern, priority, confidence, also) in enumerate(TEMPLATES[:forms]))
        out.append(Family(keywords, name, rules))
    first = len(names) * len(TEMPLATES)
    for i, (label, pattern, priority, confidence, keyword) in enumerate(SENTENCES):
        out.append(Family(tuple(keyword.split("|")), pattern, (Signature(first + i, label, pattern, "", priority, confidence),)))
    return out
