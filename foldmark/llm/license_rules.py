"""Ordered licence signatures: hand-written name patterns in a few hand-written forms, and sentences of licence texts.

All patterns run on a text's words, lower-cased and joined by single spaces, so
they need not deal with case, punctuation or line breaks. A rule's anchor is a
word that every match holds.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    anchor: str
    pattern: str
    priority: int
    confidence: float
    protected: bool = False  # never suppressed


#: label | anchor | pattern of the name | pattern of the identifier
NAMES = """
mit | mit | (?:the )?mit | mit
mit-0 | mit | mit no attribution | mit 0
apache-1.0 | apache | apache(?: software)?(?: license)? (?:version |v)?1 0 | apache 1 0
apache-1.1 | apache | apache(?: software)?(?: license)? (?:version |v)?1 1 | apache 1 1
apache-2.0 | apache | apache(?: software)?(?: license)? (?:version |v)?2(?: 0)? | apache 2 0
apache | apache | apache(?: software)? | apache
gpl-1.0 | gpl | gpl v?1(?: 0)? | gpl 1 0
gpl-2.0 | gpl | (?:gnu )?gpl(?: version)? v?2(?: 0)? | gpl 2 0(?: only| or later)?
gpl-3.0 | gpl | (?:gnu )?gpl(?: version)? v?3(?: 0)? | gpl 3 0(?: only| or later)?
gpl-2.0 | gplv2 | (?:gnu )?gplv2 | gplv2
gpl-3.0 | gplv3 | (?:gnu )?gplv3 | gplv3
gpl | general | (?:gnu )?general public | gnu general public
gpl-2.0 | general | (?:gnu )?general public license (?:version |v)2(?: 0)? | general public license 2
gpl-3.0 | general | (?:gnu )?general public license (?:version |v)3(?: 0)? | general public license 3
lgpl | lesser | (?:gnu )?lesser general public | gnu lesser
lgpl | library | (?:gnu )?library general public | gnu library
lgpl-2.1 | lgpl | (?:gnu )?lgpl(?: version)? v?2 1 | lgpl 2 1(?: only| or later)?
lgpl-3.0 | lgpl | (?:gnu )?lgpl(?: version)? v?3(?: 0)? | lgpl 3 0(?: only| or later)?
agpl | affero | (?:gnu )?affero general public | gnu affero
agpl-3.0 | agpl | (?:gnu )?agpl(?: version)? v?3(?: 0)? | agpl 3 0(?: only| or later)?
gfdl | documentation | (?:gnu )?free documentation | gfdl
bsd-0-clause | bsd | (?:zero|0) clause bsd | 0bsd
bsd-1-clause | bsd | (?:one|1) clause bsd | bsd 1 clause
bsd-2-clause | bsd | (?:(?:two|2) clause|simplified|freebsd) bsd | bsd 2 clause
bsd-3-clause | bsd | (?:(?:three|3) clause|new|revised|modified) bsd | bsd 3 clause
bsd-4-clause | bsd | (?:(?:four|4) clause|original|old) bsd | bsd 4 clause
bsd | bsd | bsd(?: style)? | bsd
isc | isc | isc | isc
mpl-1.0 | mozilla | mozilla public(?: license)? (?:version |v)?1 0 | mpl 1 0
mpl-1.1 | mozilla | mozilla public(?: license)? (?:version |v)?1 1 | mpl 1 1
mpl-2.0 | mozilla | mozilla public(?: license)? (?:version |v)?2(?: 0)? | mpl 2 0
mpl | mozilla | mozilla public | mpl
epl-1.0 | eclipse | eclipse public(?: license)? (?:version |v)?1(?: 0)? | epl 1 0
epl-2.0 | eclipse | eclipse public(?: license)? (?:version |v)?2(?: 0)? | epl 2 0
epl | eclipse | eclipse public | epl
edl | eclipse | eclipse distribution | edl 1 0
cddl-1.0 | distribution | common development and distribution | cddl 1 0
cpl-1.0 | public | common public | cpl 1 0
eupl | european | european union public | eupl 1 [12]
cecill | cecill | cecill(?: [abc])? | cecill(?: 2 [01])?
artistic-1.0 | artistic | artistic(?: license)? 1(?: 0)? | artistic 1 0
artistic-2.0 | artistic | artistic(?: license)? 2(?: 0)? | artistic 2 0
artistic | artistic | (?:perl )?artistic | artistic
bsl-1.0 | boost | boost software | bsl 1 0
busl-1.1 | business | business source | busl 1 1
elastic-2.0 | elastic | elastic(?: license)?(?: 2 0)? | elastic 2 0
sspl-1.0 | side | server side public | sspl 1 0
zlib | zlib | zlib | zlib
libpng | libpng | libpng | libpng(?: 2 0)?
openssl | openssl | openssl | openssl
ssleay | ssleay | (?:original )?ssleay | ssleay
unlicense | unlicense | (?:the )?unlicense | unlicense
wtfpl | wtfpl | wtfpl | wtfpl
cc0-1.0 | cc0 | cc0(?: 1 0)? | cc0 1 0
cc-by-4.0 | attribution | creative commons attribution 4 0 | cc by 4 0
cc-by-3.0 | attribution | creative commons attribution 3 0 | cc by 3 0
cc-by-sa | attribution | (?:creative commons )?attribution share ?alike | cc by sa [1-4] 0
cc-by-nc | attribution | (?:creative commons )?attribution non ?commercial | cc by nc [1-4] 0
cc-by-nd | attribution | (?:creative commons )?attribution no ?deriv(?:ative)?s? | cc by nd [1-4] 0
cc | creative | creative commons | cc by
odbl-1.0 | database | open(?: data commons)? (?:open )?database | odbl 1 0
pddl-1.0 | dedication | public domain dedication and | pddl 1 0
ofl-1.1 | font | (?:sil )?open font | ofl 1 1
ms-pl | microsoft | microsoft public | ms pl
ms-rl | microsoft | microsoft reciprocal | ms rl
osl-3.0 | open | open software(?: license)? 3 0 | osl 3 0
afl-3.0 | academic | academic free(?: license)?(?: 3 0)? | afl 3 0
ecl-2.0 | educational | educational community | ecl 2 0
python-2.0 | python | python(?: software foundation)? | python 2 0
psf | psf | psf | psf 2 0
php-3.01 | php | php(?: license)?(?: 3 01)? | php 3 01
ruby | ruby | ruby | ruby
tcl | tcl | tcl(?: tk)? | tcl
vim | vim | vim | vim
curl | curl | curl | curl
postgresql | postgresql | postgresql | postgresql
sleepycat | sleepycat | sleepycat | sleepycat
qpl-1.0 | public | q public | qpl 1 0
ncsa | ncsa | (?:university of illinois )?ncsa(?: open source)? | ncsa
w3c | w3c | w3c(?: software)?(?: notice and)? | w3c
x11 | x11 | x11 | x11
hpnd | historical | historical permission notice and disclaimer | hpnd
upl-1.0 | universal | universal permissive | upl 1 0
zpl-2.1 | zope | zope public | zpl 2 1
ijg | ijg | independent jpeg group ijg | ijg
beerware | beerware | (?:the )?beerware | beerware
json | json | json | json
lppl-1.3c | latex | latex project public | lppl 1 3c
mulan-2.0 | mulan | mulan (?:permissive|psl)(?: software)? | mulanpsl 2 0
blue-oak-1.0 | oak | blue oak model | blueoak 1 0 0
polyform | polyform | polyform(?: [a-z]+)? | polyform [a-z]+ 1 0 0
llama | llama | llama [234](?: [123])? community | llama[234]
rail | openrail | (?:creative ml )?openrail(?: m)? | openrail
"""

#: form | pattern around a name {n} or an identifier {i} | priority | confidence
FORMS = """
spdx | spdx license identifier {i} | 90 | 0.99
grant | (?:re)?(?:licen[cs]ed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?{n}(?: licen[cs]e)? | 70 | 0.95
terms | (?:under|to|by) the terms (?:and conditions )?of (?:the )?{n}(?: licen[cs]e)? | 65 | 0.9
name | {n} licen[cs]e | 50 | 0.8
tag | licen[cs]e (?:is )?(?:the )?{n} | 40 | 0.6
"""

#: label | anchor | a sentence only this licence's text or notice holds
TEXTS = """
mit | obtaining | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | substantial | the above copyright notice and this permission notice shall be included in all copies or substantial portions
apache-2.0 | unless | unless required by applicable law or agreed to in writing software distributed under the license
apache-2.0 | apache | www apache org licenses license 2 0
apache | apache | www apache org licenses
bsd | redistributions | redistributions of source code must retain the above copyright notice
bsd-3-clause | endorse | neither the name of (?:[^ ]+ ){1,8}nor the names of its contributors may be used to endorse
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software must display
isc | purpose | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee
gpl-2.0 | version | either version 2 of the license or at your option any later version
gpl-3.0 | version | either version 3 of the license or at your option any later version
gpl | copyleft | the gnu general public license is a free copyleft license
gpl | gnu | www gnu org licenses(?: gpl)?
lgpl | lesser | this library is free software you can redistribute it and or modify it under the terms of the gnu lesser
agpl | affero | gnu affero general public license is a free copyleft license
mpl-2.0 | mozilla | this source code form is subject to the terms of the mozilla public license
mpl | mozilla | (?:www )?mozilla org mpl
epl | eclipse | www eclipse org (?:legal|org documents) epl
cc | creativecommons | creativecommons org licenses
cc0-1.0 | creativecommons | creativecommons org publicdomain zero
bsl-1.0 | organization | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying
zlib | misrepresented | the origin of this software must not be misrepresented
unlicense | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | fuck | do what the fuck you want to
ofl-1.1 | font | this font software is licensed under the sil open font license
proprietary | reserved | all rights reserved
proprietary | confidential | (?:strictly )?confidential and proprietary
public-domain | domain | (?:placed in|dedicated to|released into) the public domain
openssl | openssl | this product includes software developed by the openssl project
postgresql | documentation | permission to use copy modify and distribute this software and its documentation for any purpose without fee
"""


def _rows(table: str) -> list[list[str]]:
    return [[cell.strip() for cell in line.split(" | ")] for line in table.strip().splitlines()]


def phrase_rules(phrases: dict[str, str]) -> list[Rule]:
    """Rules for plain phrases that no other detection may suppress; the anchor is a phrase's first word."""
    return [Rule(f"phrase:{p}", label, p.split()[0], p, 0, 0.7, True) for p, label in phrases.items()]


def default_rules() -> list[Rule]:
    """All signatures, the highest priority first."""
    rules = [Rule(f"text:{n}", label, anchor, p, 80, 1.0) for n, (label, anchor, p) in enumerate(_rows(TEXTS))]
    for form, around, priority, confidence in _rows(FORMS):
        for n, (label, anchor, name, identifier) in enumerate(_rows(NAMES)):
            rules.append(Rule(
                f"{form}:{label}:{n}", label, "spdx" if "{i}" in around else anchor,
                around.replace("{n}", name).replace("{i}", identifier), int(priority), float(confidence),
            ))
    return sorted(rules, key=lambda r: -r.priority)
