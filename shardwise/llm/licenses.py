"""License scan with ordered signature rules, in DataFrame expressions only.

Texts become words: A-Z lower-cased, every run of other ASCII characters than
letters and digits one blank.  Two kinds of detections are made on them:

* base phrases, counted at every place where their words stand consecutively;
* signature rules: hand-written texts and names of licenses, and templates over
  license families and versions (some hundreds of regular expressions), each gated
  by a keyword that must occur in the text.  A detection is suppressed if one with
  higher priority (or the same priority and more words) covers its whole interval
  of words, or an equal one comes earlier in the rule order.

Everything happens inside the row (no shuffle, no Python): the gated rules are a
filtered array literal, places come from splitting the text at the matches and
adding up words, and suppression is a sweep over the row's own detections in the
order of their places.  Sums and running maxima are made by doubling steps, so m
matches cost about m log m operations.

Defined results: a null text counts as empty; texts are read whole; equal rows
give equal results; input columns are kept, and those called like an output
column are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardwise.llm.common import text_or_empty

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: fixed values of the contract: phrase -> label
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

MARK, CLOSE = "\x01", "\x02"


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[str, ...]  # whole words; every match contains one of them
    regex: str  # over blank-separated lower-case words, without outer blanks
    priority: int
    weight: float  # confidence that the text is under the license
    named: bool = False  # every match also holds the word license (or licence)


#: family: label, words of its name, versions, keyword
FAMILIES = (
    ("apache", r"apache(?: software)?(?: license)?", ("1 0", "1 1", "2 0"), "apache"),
    ("gpl", r"(?:gnu )?(?:general public license|gpl)", ("1 0", "2 0", "2", "3 0", "3"), "gpl|general public"),
    ("lgpl", r"(?:gnu )?(?:(?:lesser|library) general public license|lgpl)", ("2 0", "2 1", "3 0", "3"), "lgpl|lesser general|library general"),
    ("agpl", r"(?:gnu )?(?:affero general public license|agpl)", ("1 0", "3 0", "3"), "agpl|affero"),
    ("mpl", r"(?:mozilla public license|mpl)", ("1 0", "1 1", "2 0"), "mozilla|mpl"),
    ("epl", r"(?:eclipse public license|epl)", ("1 0", "2 0"), "eclipse|epl"),
    ("cddl", r"(?:common development and distribution license|cddl)", ("1 0", "1 1"), "common development|cddl"),
    ("eupl", r"(?:european union public licen[cs]e|eupl)", ("1 0", "1 1", "1 2"), "european union|eupl"),
    ("artistic", r"artistic(?: license)?", ("1 0", "2 0"), "artistic"),
    ("osl", r"open software license", ("1 0", "2 0", "2 1", "3 0"), "open software"),
    ("odbl", r"open (?:data commons open )?database license", ("1 0",), "database license"),
    ("gfdl", r"(?:gnu )?(?:free documentation license|gfdl)", ("1 1", "1 2", "1 3"), "free documentation|gfdl"),
    ("cc-by", r"(?:cc by|creative commons attribution)", ("1 0", "2 0", "2 5", "3 0", "4 0"), "cc by|creative commons"),
    ("cc-by-sa", r"(?:cc by sa|creative commons attribution share ?alike)", ("1 0", "2 0", "2 5", "3 0", "4 0"), "cc by sa|creative commons"),
    ("cc-by-nd", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)", ("1 0", "2 0", "2 5", "3 0", "4 0"), "cc by nd|creative commons"),
    ("cc-by-nc", r"(?:cc by nc|creative commons attribution non ?commercial)", ("1 0", "2 0", "2 5", "3 0", "4 0"), "cc by nc|creative commons"),
    ("cc-by-nc-sa", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)", ("1 0", "2 0", "2 5", "3 0", "4 0"), "cc by nc sa|creative commons"),
    ("cc-by-nc-nd", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)", ("1 0", "2 0", "2 5", "3 0", "4 0"), "cc by nc nd|creative commons"),
    ("mit", r"(?:mit|expat|x11) license", (), "mit license|expat license|x11 license"),
    ("bsd", r"(?:(?:[234]|two|three|four) clause )?(?:new |simplified |modified )?bsd(?: (?:[234]|two|three|four) clause)?(?: license)?", (), "bsd"),
    ("isc", r"isc license", (), "isc license"),
    ("zlib", r"zlib(?: libpng)? license", (), "zlib"),
    ("boost", r"boost software license", ("1 0",), "boost software"),
    ("wtfpl", r"(?:do what the fuck you want to public license|wtfpl)", ("2",), "public license|wtfpl"),
    ("unlicense", r"unlicense", (), "unlicense"),
    ("cc0", r"(?:cc0|cc zero|creative commons zero)", ("1 0",), "cc0|cc zero|creative commons zero"),
)
#: ways to name a license, from the surest: template ({n}: its name and version), priority, weight
TEMPLATES = (
    (r"(?:this (?:work|file|program|software|text|document|library) is )?(?:released|distributed|made available|available) under (?:the )?(?:terms of )?(?:the )?{n}", 90, 0.95),
    (r"(?:this (?:work|file|program|software|text|document|library) is )?licen[cs]ed under (?:the )?(?:terms of )?(?:the )?{n}", 90, 0.97),
    (r"spdx license identifier {n}", 95, 0.99),
    (r"under (?:the )?{n}", 60, 0.7),
)
#: families whose versions are given with "only" or "or later"
SCOPED = ("gpl", "lgpl", "agpl", "gfdl")
#: other licenses by name: label, regex; looked for where the word license (or licence) occurs
NAMES = (
    ("0bsd", r"(?:0bsd|zero clause bsd) licen[cs]e"),
    ("afl-3.0", r"academic free licen[cs]e(?: version| v)? 3 0"),
    ("afl-2.1", r"academic free licen[cs]e(?: version| v)? 2 1"),
    ("aladdin", r"aladdin free public licen[cs]e"),
    ("apsl-2.0", r"apple public source licen[cs]e(?: version| v)? 2 0"),
    ("beerware", r"beer ?ware licen[cs]e"),
    ("blueoak-1.0.0", r"blue oak model licen[cs]e(?: version| v)?(?: 1 0 0)?"),
    ("bsd-2-clause", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd) licen[cs]e"),
    ("bsd-3-clause", r"(?:bsd 3 clause|3 clause bsd|new bsd|revised bsd|modified bsd) licen[cs]e"),
    ("bsd-4-clause", r"(?:bsd 4 clause|4 clause bsd|original bsd|old bsd) licen[cs]e"),
    ("bsd-3-clause-clear", r"(?:bsd 3 clause clear|clear bsd) licen[cs]e"),
    ("bsl-1.1", r"(?:business source|mariadb business source) licen[cs]e(?: version| v)?(?: 1 1)?"),
    ("cecill-2.1", r"cecill(?: free software)? licen[cs]e(?: agreement)?(?: version| v)? 2 1"),
    ("cecill", r"cecill(?: free software)? licen[cs]e"),
    ("clartistic", r"clarified artistic licen[cs]e"),
    ("commons-clause", r"commons clause licen[cs]e(?: condition)?(?: version| v)?(?: 1 0)?"),
    ("cpal-1.0", r"common public attribution licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("cpl-1.0", r"common public licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("curl", r"curl licen[cs]e"),
    ("dpl-1.1", r"debian public licen[cs]e"),
    ("ecl-2.0", r"educational community licen[cs]e(?: version| v)?(?: 2 0)?"),
    ("efl-2.0", r"eiffel forum licen[cs]e(?: version| v)?(?: 2(?: 0)?)?"),
    ("elastic-2.0", r"elastic licen[cs]e(?: version| v)?(?: 2 0)?"),
    ("entessa", r"entessa public licen[cs]e"),
    ("erlang-1.1", r"erlang public licen[cs]e(?: version| v)?(?: 1 1)?"),
    ("eudatagrid", r"eu datagrid software licen[cs]e"),
    ("fair", r"fair licen[cs]e"),
    ("fsl-1.1", r"functional source licen[cs]e(?: version| v)?(?: 1 1)?"),
    ("ftl", r"freetype(?: project)? licen[cs]e"),
    ("gust-font", r"gust font licen[cs]e"),
    ("hippocratic-2.1", r"hippocratic licen[cs]e(?: version| v)?(?: [123] [0-9])?"),
    ("hpnd", r"historical permission notice and disclaimer licen[cs]e"),
    ("ibm-pl-1.0", r"ibm public licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("icu", r"icu licen[cs]e"),
    ("ijg", r"independent jpeg group licen[cs]e"),
    ("imagemagick", r"imagemagick licen[cs]e"),
    ("ipa", r"ipa font licen[cs]e"),
    ("json", r"json licen[cs]e"),
    ("lal-1.3", r"free art licen[cs]e(?: 1 3)?"),
    ("lal-1.3", r"licence art libre(?: 1 3)?"),
    ("libpng", r"libpng licen[cs]e"),
    ("liliq-p-1.1", r"licence libre du quebec(?: permissive)?"),
    ("lppl-1.3c", r"latex project public licen[cs]e(?: version| v)?(?: 1 3c?)?"),
    ("lucent-1.02", r"lucent public licen[cs]e(?: version| v)?(?: 1 02)?"),
    ("llama-2", r"llama 2 community licen[cs]e(?: agreement)?"),
    ("llama-3", r"(?:meta )?llama 3(?: [0-9])? community licen[cs]e(?: agreement)?"),
    ("miros", r"miros licen[cs]e"),
    ("mit-0", r"mit(?: 0| no attribution) licen[cs]e"),
    ("motosoto", r"motosoto open source licen[cs]e"),
    ("ms-pl", r"microsoft public licen[cs]e(?: ms pl)?"),
    ("ms-rl", r"microsoft reciprocal licen[cs]e(?: ms rl)?"),
    ("mulan-psl-2.0", r"mulan permissive software licen[cs]e(?: version| v)?(?: 2)?"),
    ("multics", r"multics licen[cs]e"),
    ("naumen", r"naumen public licen[cs]e"),
    ("nasa-1.3", r"nasa open source(?: agreement)? licen[cs]e"),
    ("ncsa", r"(?:university of illinois )?ncsa open source licen[cs]e"),
    ("ngpl", r"nethack general public licen[cs]e"),
    ("nokia", r"nokia open source licen[cs]e"),
    ("npl-1.1", r"netscape public licen[cs]e(?: version| v)?(?: 1 [01])?"),
    ("ntp", r"ntp licen[cs]e"),
    ("oclc-2.0", r"oclc research public licen[cs]e"),
    ("odc-by-1.0", r"open data commons attribution licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("ofl-1.1", r"(?:sil )?open font licen[cs]e(?: version| v)?(?: 1 1)?"),
    ("ogl-uk-3.0", r"open government licen[cs]e(?: version| v)?(?: 3 0)?"),
    ("ogc-1.0", r"ogc software licen[cs]e"),
    ("openrail-m", r"(?:creativeml |bigscience |bigcode )?open ?rail(?: m)? licen[cs]e"),
    ("openssl", r"openssl licen[cs]e"),
    ("opl-1.0", r"open publication licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("oset-pl-2.1", r"oset public licen[cs]e"),
    ("parity-7.0.0", r"parity public licen[cs]e"),
    ("php-3.01", r"php licen[cs]e(?: version| v)?(?: 3 01?)?"),
    ("polyform-nc-1.0.0", r"polyform noncommercial licen[cs]e(?: 1 0 0)?"),
    ("polyform-small-1.0.0", r"polyform small business licen[cs]e(?: 1 0 0)?"),
    ("postgresql", r"postgresql licen[cs]e"),
    ("prosperity-3.0.0", r"prosperity public licen[cs]e(?: 3 0 0)?"),
    ("psf-2.0", r"(?:python software foundation|psf) licen[cs]e(?: agreement)?(?: version| v)?(?: 2(?: 0)?)?"),
    ("qpl-1.0", r"(?:q|qt) public licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("rpl-1.5", r"reciprocal public licen[cs]e(?: version| v)?(?: 1 5)?"),
    ("rpsl-1.0", r"realnetworks public source licen[cs]e"),
    ("rscpl", r"ricoh source code public licen[cs]e"),
    ("ruby", r"ruby licen[cs]e"),
    ("sgi-b-2.0", r"sgi free software licen[cs]e b"),
    ("simpl-2.0", r"simple public licen[cs]e(?: 2 0)?"),
    ("sissl", r"sun industry standards source licen[cs]e"),
    ("sleepycat", r"sleepycat licen[cs]e"),
    ("spl-1.0", r"sun public licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("sspl-1.0", r"server side public licen[cs]e(?: version| v)?(?: 1(?: 0)?)?"),
    ("tcl", r"tcl(?: tk)? licen[cs]e"),
    ("upl-1.0", r"universal permissive licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("unicode", r"unicode licen[cs]e(?: agreement)?"),
    ("vim", r"vim licen[cs]e"),
    ("vsl-1.0", r"vovida software licen[cs]e"),
    ("w3c", r"w3c software(?: notice and| and document)? licen[cs]e"),
    ("watcom-1.0", r"sybase open watcom public licen[cs]e"),
    ("x11", r"x11 licen[cs]e"),
    ("xnet", r"x net licen[cs]e"),
    ("ypl-1.1", r"yahoo public licen[cs]e"),
    ("zpl-2.1", r"zope public licen[cs]e(?: version| v)?(?: 2 [01])?"),
)
#: identifiers after "SPDX-License-Identifier:" that no family makes: label, words
SPDX = (
    ("mit", "mit"), ("mit-0", "mit 0"), ("isc", "isc"), ("0bsd", "0bsd"), ("bsd-2-clause", "bsd 2 clause"), ("bsd-3-clause", "bsd 3 clause"), ("bsd-4-clause", "bsd 4 clause"),
    ("zlib", "zlib"), ("bsl-1.0", "bsl 1 0"), ("bsl-1.1", "busl 1 1"), ("sspl-1.0", "sspl 1 0"), ("ofl-1.1", "ofl 1 1"), ("psf-2.0", "(?:psf|python) 2 0"), ("ms-pl", "ms pl"),
    ("ms-rl", "ms rl"), ("unlicense", "unlicense"), ("cc0-1.0", "cc0 1 0"), ("wtfpl", "wtfpl"), ("ncsa", "ncsa"), ("postgresql", "postgresql"), ("openssl", "openssl"),
    ("ruby", "ruby"), ("vim", "vim"), ("curl", "curl"), ("x11", "x11"), ("upl-1.0", "upl 1 0"), ("elastic-2.0", "elastic 2 0"), ("blueoak-1.0.0", "blueoak 1 0 0"), ("zpl-2.1", "zpl 2 1"), ("hpnd", "hpnd"),
)
#: texts of their own: label, keyword, regex, priority, weight
TEXTS = (
    ("bsd-3-clause", "endorse or promote", r"neither the name of (?:[a-z0-9]+ ){1,12}?nor the names of its contributors may be used to endorse or promote products", 99, 0.99),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledg?ement", 99, 0.99),
    ("bsd-2-clause", "redistributions of source", r"redistributions of source code must retain the above copyright notice", 97, 0.9),
    ("bsd-2-clause", "redistributions in binary", r"redistributions in binary form must reproduce the above copyright notice", 97, 0.9),
    ("mit", "above copyright notice", r"the above copyright notice and this permission notice shall be included in all copies", 97, 0.98),
    ("mit", "without warranty", r"the software is provided as is without warranty of any kind express or implied", 96, 0.85),
    ("apache-2.0", "apache org", r"you may obtain a copy of the license at https? www apache org licenses license 2 0", 98, 0.99),
    ("apache-2.0", "in compliance with", r"you may not use this file except in compliance with the license", 96, 0.9),
    ("gpl", "any later version", r"either version [0-9](?: [0-9])? of the license or at your option any later version", 97, 0.95),
    ("gpl", "hope that it", r"this program is distributed in the hope that it will be useful but without any warranty", 97, 0.95),
    ("lgpl", "hope that it", r"this library is distributed in the hope that it will be useful but without any warranty", 97, 0.95),
    ("classpath-exception", "special exception", r"as a special exception the copyright holders (?:of this library )?give you permission to link this library", 99, 0.97),
    ("gcc-exception", "runtime library exception", r"gcc runtime library exception(?: version 3 1)?", 99, 0.97),
    ("llvm-exception", "llvm exception", r"(?:with )?llvm exception", 99, 0.97),
    ("font-exception", "font exception", r"(?:with )?font exception", 90, 0.8),
    ("mpl-2.0", "mozilla public license", r"this source code form is subject to the terms of the mozilla public license", 98, 0.99),
    ("mpl-2.0", "incompatible with secondary", r"this source code form is incompatible with secondary licenses", 98, 0.97),
    ("epl", "accompanying materials", r"this program and the accompanying materials are made available under the terms of the eclipse public license", 98, 0.99),
    ("zlib", "altered source versions", r"altered source versions must be plainly marked as such", 97, 0.98),
    ("zlib", "in no event", r"in no event will the authors be held liable for any damages arising from the use of this software", 97, 0.95),
    ("bsl-1.0", "any person or organization", r"permission is hereby granted free of charge to any person or organization obtaining a copy", 98, 0.98),
    ("unlicense", "unencumbered software", r"this is free and unencumbered software released into the public domain", 99, 0.99),
    ("cc0", "neighboring rights", r"(?:has )?waived? all copyright and related or neighboring rights", 97, 0.97),
    ("bsl-1.1", "change date", r"on the change date or the fourth anniversary of the first publicly available distribution", 98, 0.98),
    ("sspl-1.0", "functionality of the program", r"if you make the functionality of the program or a modified version available to third parties as a service", 99, 0.99),
    ("commons-clause", "right to sell", r"the license does not grant to you the right to sell the software", 98, 0.98),
    ("ofl-1.1", "reserved font name", r"with reserved font name", 97, 0.95),
    ("hpnd", "hereby granted without fee", r"permission to use copy modify and distribute this software and its documentation for any purpose is hereby granted without fee", 99, 0.97),
    ("ncsa", "with the software without", r"to deal with the software without restriction", 98, 0.97),
    ("json", "good not evil", r"the software shall be used for good not evil", 99, 0.99),
    ("beerware", "buy me a beer", r"you can buy me a beer in return", 99, 0.99),
    ("no-redistribution", "not for redistribution", r"not for redistribution", 75, 0.7),
    ("trade-secret", "trade secrets", r"(?:contains|constitutes) trade secrets", 80, 0.85),
    ("evaluation", "evaluation purposes", r"for evaluation purposes only", 75, 0.7),
    ("noncommercial", "non commercial", r"for (?:personal and )?non commercial use only", 75, 0.75),
    ("noncommercial", "noncommercial", r"for (?:personal and )?noncommercial use only", 75, 0.75),
    ("research-only", "research purposes", r"for (?:academic and |non commercial )?research purposes only", 75, 0.75),
    ("no-derivatives", "derivative works", r"no derivative works", 60, 0.6),
    ("used-with-permission", "used with permission", r"used with permission", 70, 0.6),
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy", 98, 0.99),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose", 98, 0.98),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted", 98, 0.98),
    ("gpl", "gnu general public license", r"redistribute it and or modify it under the terms of the gnu general public license", 98, 0.99),
    ("public-domain", "public domain", r"(?:released into|dedicated to|placed in|in) the public domain", 70, 0.8),
    ("warranty", "any kind", r"(?:as is )?without warrant(?:y|ies) of any kind", 40, 0.4),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9][0-9]", 30, 0.3),
    ("proprietary", "proprietary", r"(?:confidential and proprietary|proprietary and confidential)", 80, 0.9),
    ("proprietary", "permission", r"(?:reproduced|reproduction|copied|distributed)(?: or [a-z]+)? without (?:prior |written |express )*permission", 80, 0.85),
    ("reserved", "all rights reserved", r"all rights reserved", 20, 0.6),
    ("cc-by", "cc by", r"cc by", 10, 0.5),
    ("gpl", "general public license", r"general public license", 10, 0.5),
)


def name_keywords(name: str) -> tuple[str, ...]:
    """Whole words that every match of a name holds: its first alternatives, or
    the words before its first choice."""
    name = re.sub(r"^\(\?:[^)]*\)\?", "", name)  # an optional beginning
    if first := re.match(r"\(\?:([^)]*)\)", name):
        return tuple(first[1].split("|"))
    if loose := re.match(r"([a-z0-9 ]*) \?([a-z]+)", name):
        return tuple(f"{loose[1]}{gap}{loose[2]}" for gap in ("", " "))
    return (re.match(r"[a-z0-9 ]+?(?= licen\[|\(| [a-z]+\()", name)[0],) if not name.startswith("licence") else (re.match(r"[a-z0-9 ]+", name)[0],)


def signature_rules() -> list[Rule]:
    """Families x versions x templates, other names x two templates, identifiers,
    then the texts."""
    out = []
    for label, name, versions, words in FAMILIES:
        named = [(f"{label}-{v.replace(' ', '.')}", f"{name}(?: license)?(?: international)? (?:version |v)?{v}", 5) for v in versions] + [(label, name, 0)]
        keywords = tuple(words.split("|"))
        for full, regex, extra in named:
            for template, priority, weight in TEMPLATES:
                out.append(Rule(full, keywords, template.format(n=regex), priority + extra, weight))
            if extra:
                out.append(Rule(full, keywords, regex, 50, 0.6))
            if extra and label in SCOPED:
                for suffix, words_ in (("or-later", r"(?: of the license)? or (?:at your option )?(?:any )?later(?: version)?"), ("only", " only")):
                    scoped = regex + words_
                    out += [Rule(f"{full}-{suffix}", keywords, template.format(n=scoped), priority + extra + 2, weight) for template, priority, weight in TEMPLATES]
                    out.append(Rule(f"{full}-{suffix}", keywords, scoped, 57, 0.65))
    for label, name in NAMES:
        gate_ = name_keywords(name)
        out.append(Rule(label, gate_, rf"(?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?{name}", 92, 0.95, named=True))
        out.append(Rule(label, gate_, name, 55, 0.6, named=True))
    out += [Rule(label, ("license identifier",), rf"spdx license identifier {words_}", 96, 0.99) for label, words_ in SPDX]
    return out + [Rule(label, (k,), r, p, w) for label, k, r, p, w in TEXTS]


def _sql(value) -> str:
    """SQL text of a nested constant; the optimiser folds it into one literal."""
    if isinstance(value, dict):
        return "named_struct(" + ", ".join(f"'{k}', {_sql(v)}" for k, v in value.items()) + ")"
    if isinstance(value, list):
        return "array(" + ", ".join(map(_sql, value)) + ")"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value}D" if isinstance(value, float) else str(value)


LICENSE_WORDS = ("license", "licence")


def _gated(padded: Column, rules: list[Rule]) -> Column:
    """The rules with a keyword in the text, each once: every keyword is looked
    for once, however many rules it gates; those of names only where the word
    license occurs."""
    every = F.expr(_sql([{"label": r.label, "regex": f"(?<= )(?:{r.regex})(?= )", "priority": r.priority, "weight": r.weight, "rule": i} for i, r in enumerate(rules)]))

    def ids(named: bool) -> Column:
        by: dict[str, list[int]] = {}
        for i, r in enumerate(rules):
            for k in r.keywords if r.named == named else ():
                by.setdefault(k, []).append(i)
        if not by:
            return F.expr("cast(array() as array<int>)")
        groups = F.expr(_sql([{"keyword": f" {k} ", "ids": ids} for k, ids in by.items()]))
        hit = F.filter(groups, lambda g: F.contains(padded, g["keyword"]))
        return F.flatten(F.transform(hit, lambda g: g["ids"]))

    said = reduce(lambda a, b: a | b, [F.contains(padded, F.lit(f" {w} ")) for w in LICENSE_WORDS])
    named = F.when(said, ids(True)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.transform(F.array_distinct(F.concat(ids(False), named)), lambda i: F.element_at(every, i + 1))


def _blanks(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def words_text(text: str) -> Column:
    """' w1 w2 ... ' (one blank for a text without words)."""
    return F.lower(F.regexp_replace(F.concat(F.lit(" "), text_or_empty(text), F.lit(" ")), SEPARATORS, " "))


def _base_places(padded: Column, n_words: Column, phrase: str) -> Column:
    """count, first and last start of a phrase (null count where absent).  A
    phrase does not overlap itself, so splitting at it finds every place."""
    size = phrase.count(" ") + 1
    pieces = F.split(padded, f" {phrase}(?= )")
    last = n_words - (_blanks(F.element_at(pieces, -1)) - 1) - size
    found = F.struct((F.size(pieces) - 1).cast("long").alias("n"), _blanks(pieces[0]).cast("long").alias("first"), last.cast("long").alias("last"))
    return F.when(F.contains(padded, F.lit(f" {phrase} ")), found)


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _scan(values: Column, empty: Column, combine) -> Column:
    """Running ``combine`` of an array of numbers, by doubling steps: in step s
    every place takes in the one s before it."""
    powers = F.expr("transform(sequence(0, 30), k -> shiftleft(1, k))")
    return _let(values, lambda v: F.aggregate(
        F.slice(powers, 1, F.ceil(F.log2(F.greatest(F.size(v), F.lit(1)).cast("double"))).cast("int")), v,
        lambda a, s: F.transform(a, lambda x, i: combine(x, F.when(i >= s, F.get(a, i - s)).otherwise(empty)))))


def _matches(padded: Column, r: Column) -> Column:
    """All matches of one rule as intervals of words.  A piece after the mark
    holds a match, its end mark and the text up to the next match; a match starts
    behind the words of all pieces before it."""
    marked = F.split(F.regexp_replace(padded, r["regex"], F.lit(f"{MARK}$0{CLOSE}")), MARK)

    def words_of(p: Column) -> Column:
        # blanks between two matches: one more than the words; the first piece has its leading blank
        return F.when(F.contains(p, F.lit(CLOSE)), _blanks(F.substring_index(p, CLOSE, 1)) + _blanks(F.substring_index(p, CLOSE, -1))).otherwise(_blanks(p) - 1)

    def place(pieces: Column, before: Column) -> Column:
        rest = F.slice(pieces, 2, F.size(pieces) - 1)
        return F.transform(rest, lambda p, i: F.struct(
            r["label"].alias("label"), r["priority"].alias("priority"), r["weight"].alias("weight"), r["rule"].alias("rule"),
            F.get(before, i).alias("start"), (F.get(before, i) + _blanks(F.substring_index(p, CLOSE, 1)) + 1).alias("end")))

    found = lambda m: _let(_scan(F.transform(m, words_of), F.lit(0), lambda a, b: a + b), lambda before: place(m, before))
    # most rules that a keyword lets through match nowhere
    return _let(marked, lambda m: F.when(F.size(m) > 1, found(m)).otherwise(F.expr("cast(array() as array<struct<label:string,priority:int,weight:double,rule:int,start:int,end:int>>)")))


def _uncovered(found: Column) -> Column:
    """Detections that no other one suppresses.  In the order of start, then the
    longer, the more important and the earlier rule first, one is suppressed if
    some earlier one of at least its priority reaches its end."""
    order = F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["end"]).alias("a"), (-d["priority"]).alias("b"), d["rule"].alias("rule"), d.alias("d")))
    in_order = F.transform(F.sort_array(order), lambda x: x["d"])

    def of_priority(ds: Column, v: Column) -> Column:
        reach = _scan(F.transform(ds, lambda d: F.when(d["priority"] >= v, d["end"]).otherwise(-1)), F.lit(-1), F.greatest)
        return _let(reach, lambda m: F.filter(ds, lambda d, i: (d["priority"] == v) & ((i == 0) | (F.get(m, i - 1) < d["end"]))))

    levels = lambda ds: F.array_distinct(F.transform(ds, lambda d: d["priority"]))
    return _let(in_order, lambda ds: F.flatten(F.transform(levels(ds), lambda v: of_priority(ds, v))))


def gate(padded: Column, rules: list[Rule]) -> Column:
    """Does any keyword occur?  Plain searches, cheaper than an alternation."""
    keys = sorted({k for r in rules for k in (LICENSE_WORDS if r.named else r.keywords)}, key=len)
    kept: list[str] = []
    for k in keys:
        if not any(f" {x} " in f" {k} " for x in kept):  # a shorter one stands for those that contain it
            kept.append(k)
    return reduce(lambda a, b: a | b, [F.contains(padded, F.lit(f" {k} ")) for k in kept])


def scan(df: DataFrame, text: str = "text", rules: list[Rule] | None = None, base: dict[str, str] | None = None) -> DataFrame:
    """``df`` with n_words, base (array of label, n, first, last), detections
    (array of label, priority, weight, rule, start, end in words) and score."""
    rules, base = rules if rules is not None else signature_rules(), base if base is not None else BASE
    out = df.withColumn("_padded", words_text(text)).withColumn("n_words", (_blanks(F.col("_padded")) - 1).cast("long"))
    padded = F.col("_padded")
    places = [F.struct(F.lit(label).alias("label"), _base_places(padded, F.col("n_words"), phrase).alias("at")) for phrase, label in base.items()]
    out = out.withColumn("base", F.filter(F.array(*places), lambda p: p["at"].isNotNull()))
    found = F.flatten(F.transform(_gated(padded, rules), lambda r: _matches(padded, r)))
    out = out.withColumn("_found", F.when(gate(padded, rules), found))
    kept = F.when(F.size("_found") > 0, _uncovered(F.col("_found")))
    out = out.withColumn("detections", F.coalesce(F.sort_array(F.transform(kept, lambda d: F.struct(d["start"].alias("start"), d["rule"].alias("rule"), d.alias("d")))).getField("d"), F.expr("cast(array() as array<struct<label:string,priority:int,weight:double,rule:int,start:int,end:int>>)")))
    score = F.greatest(F.coalesce(F.array_max(F.transform("detections", lambda d: d["weight"])), F.lit(0.0)), F.when(F.size("base") > 0, 0.5).otherwise(0.0))
    return out.withColumn("score", score).drop("_padded", "_found")
