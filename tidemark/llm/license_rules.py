"""Signatures of licenses, as ordered rules.

A rule is a regular expression over words: lower-case runs of letters and
digits, with one blank before each word but the first. Punctuation is gone, so
``GPL-2.0`` reads ``gpl 2 0``. It is tried only on texts that hold its keywords,
words of which every match has each.

Priorities: 4 the wording of a license or of its grant, 3 a name with its
version or an address, 2 a name, 1 a hint. Earlier rules win ties.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    number: int
    label: str
    priority: int
    keywords: tuple[str, ...]
    pattern: str
    base: bool


# The contract's phrases and labels (fixed values).
BASE = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

# label ; versions ; keywords ; pattern, in which {v} stands for the version.
VERSIONED = r"""
gpl ; 1.0 2.0 3.0 ; gnu general public ; gnu general public licen[cs]e(?: as published by the free software foundation)?(?: either)? {v}
gpl ; 1.0 2.0 3.0 ; gpl ; (?:gnu )?gpl(?: licen[cs]e)? {v}
gpl ; 1.0 2.0 3.0 ; spdx gpl ; spdx license identifier gpl {v}(?: only)?
gpl ; 1.0 2.0 3.0 ; gnu licenses ; gnu org licenses (?:old licenses )?gpl {v}
lgpl ; 2.0 2.1 3.0 ; gnu public ; gnu (?:lesser|library) general public licen[cs]e(?: as published by the free software foundation)?(?: either)? {v}
lgpl ; 2.0 2.1 3.0 ; lgpl ; (?:gnu )?lgpl(?: licen[cs]e)? {v}
lgpl ; 2.0 2.1 3.0 ; spdx lgpl ; spdx license identifier lgpl {v}(?: only)?
agpl ; 1.0 3.0 ; affero ; (?:gnu )?affero general public licen[cs]e(?: as published by the free software foundation)?(?: either)? {v}
agpl ; 1.0 3.0 ; agpl ; (?:gnu )?agpl(?: licen[cs]e)? {v}
gfdl ; 1.1 1.2 1.3 ; gnu documentation ; gnu free documentation licen[cs]e {v}
gfdl ; 1.1 1.2 1.3 ; gfdl ; (?:gnu )?gfdl {v}
apache ; 1.0 1.1 2.0 ; apache ; apache(?: software)? licen[cs]e {v}
apache ; 1.0 1.1 2.0 ; apache ; apache {v}
apache ; 1.0 1.1 2.0 ; apache licenses ; apache org licenses license {v}
mpl ; 1.0 1.1 2.0 ; mozilla public ; mozilla public licen[cs]e {v}
mpl ; 1.0 1.1 2.0 ; mpl ; mpl {v}
mpl ; 1.0 1.1 2.0 ; mozilla mpl ; mozilla org mpl {v}
epl ; 1.0 2.0 ; eclipse public ; eclipse public licen[cs]e {v}
epl ; 1.0 2.0 ; epl ; epl {v}
cddl ; 1.0 1.1 ; development distribution ; common development and distribution licen[cs]e {v}
cddl ; 1.0 1.1 ; cddl ; cddl {v}
eupl ; 1.0 1.1 1.2 ; european union public ; european union public licen[cs]e {v}
eupl ; 1.0 1.1 1.2 ; eupl ; eupl {v}
osl ; 1.0 1.1 2.0 2.1 3.0 ; open software ; open software licen[cs]e {v}
osl ; 1.0 1.1 2.0 2.1 3.0 ; osl ; osl {v}
afl ; 1.1 1.2 2.0 2.1 3.0 ; academic free ; academic free licen[cs]e {v}
afl ; 1.1 1.2 2.0 2.1 3.0 ; afl ; afl {v}
artistic ; 1.0 2.0 ; artistic ; (?:perl )?artistic(?: licen[cs]e)? {v}
cecill ; 1.0 1.1 2.0 2.1 ; cecill ; cecill {v}
ecl ; 1.0 2.0 ; educational community ; educational community licen[cs]e {v}
lppl ; 1.0 1.1 1.2 1.3 ; lppl ; lppl {v}
lppl ; 1.0 1.1 1.2 1.3 ; latex project public ; latex project public licen[cs]e {v}
ofl ; 1.0 1.1 ; ofl ; (?:sil )?ofl {v}
ofl ; 1.0 1.1 ; sil open font ; sil open font licen[cs]e {v}
zpl ; 1.1 2.0 2.1 ; zope public ; zope public licen[cs]e(?: zpl)? {v}
psf ; 2.0 ; python foundation ; python software foundation licen[cs]e {v}
boost ; 1.0 ; boost ; boost software licen[cs]e {v}
boost ; 1.0 ; bsl ; bsl {v}
apsl ; 1.0 1.1 1.2 2.0 ; apple public source ; apple public source licen[cs]e {v}
npl ; 1.0 1.1 ; netscape public ; netscape public licen[cs]e {v}
qpl ; 1.0 ; q public ; q public licen[cs]e {v}
cpl ; 1.0 ; common public ; common public licen[cs]e {v}
ipl ; 1.0 ; ibm public ; ibm public licen[cs]e {v}
upl ; 1.0 ; universal permissive ; universal permissive licen[cs]e {v}
odbl ; 1.0 ; odbl ; odbl {v}
odbl ; 1.0 ; open database ; open database licen[cs]e {v}
odc-by ; 1.0 ; odc by ; odc by {v}
pddl ; 1.0 ; pddl ; pddl {v}
busl ; 1.1 ; business source ; business source licen[cs]e {v}
sspl ; 1.0 ; server side public ; server side public licen[cs]e {v}
elastic ; 2.0 ; elastic ; elastic licen[cs]e {v}
cern-ohl ; 1.1 1.2 2.0 ; cern hardware ; cern open hardware licen[cs]e {v}
mulan ; 1.0 2.0 ; mulan psl ; mulan psl {v}
cc0 ; 1.0 ; cc0 ; cc0 {v}(?: universal)?
cc0 ; 1.0 ; creativecommons publicdomain zero ; creativecommons org publicdomain zero {v}
"""

# label ; versions ; pattern of one word, in which {n} stands for the digits before and behind the point.
JOINED = r"""
gpl ; 1.0 2.0 3.0 ; gplv{n}
lgpl ; 2.0 2.1 3.0 ; lgplv{n}
agpl ; 1.0 3.0 ; agplv{n}
mpl ; 1.0 1.1 2.0 ; mplv{n}
apache ; 1.0 1.1 2.0 ; apachev{n}
"""

# priority ; label ; keywords ; pattern
PLAIN = r"""
4 ; gpl-or-later ; any later version ; general public licen[cs]e (?:as published by the free software foundation )?(?:either )?(?:version [123](?: [01])? )?(?:of the licen[cs]e )?or (?:at your option )?any later version
4 ; gpl ; redistribute modify gnu ; redistribute it and or modify it under the terms of the gnu general public licen[cs]e
4 ; lgpl ; redistribute modify gnu ; redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e
4 ; agpl ; redistribute modify affero ; redistribute it and or modify it under the terms of the (?:gnu )?affero general public licen[cs]e
4 ; apache-2.0 ; licensed apache compliance ; licensed under the apache license version 2 0 the license you may not use this file except in compliance
4 ; mit ; permission granted charge obtaining ; permission is hereby granted free of charge to any person obtaining a copy of this software
4 ; mit ; substantial portions ; shall be included in all copies or substantial portions of the software
4 ; isc ; permission copy modify fee ; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
4 ; bsd ; redistribution source binary ; redistribution and use in source and binary forms with or without modification are permitted
4 ; bsd-3-clause ; endorse promote ; may be used to endorse or promote products derived from this software
4 ; bsd-4-clause ; advertising materials ; all advertising materials mentioning features or use of this software
4 ; zlib ; misrepresented origin ; the origin of this software must not be misrepresented
4 ; zlib ; altered source versions ; altered source versions must be plainly marked as such
4 ; mpl-2.0 ; source form subject mozilla ; this source code form is subject to the terms of the mozilla public licen[cs]e
4 ; unlicense ; unencumbered public domain ; free and unencumbered software released into the public domain
4 ; wtfpl ; fuck ; do what the fuck you want to public licen[cs]e
4 ; beerware ; buy beer ; you can buy me a beer in return
4 ; json ; good evil ; shall be used for good not evil
4 ; cc0 ; waived copyright neighboring ; waived all copyright and related or neighboring rights
4 ; boost ; machine executable object ; solely in the form of machine executable object code generated by a source language processor
4 ; warranty ; as is warranty ; provided as is without warranty of any kind
4 ; warranty ; merchantability fitness ; merchantability(?: or)? fitness for a particular purpose
4 ; warranty ; hope useful warranty ; in the hope that it will be useful but without any warranty
4 ; proprietary ; confidential proprietary ; confidential and proprietary
4 ; proprietary ; reproduction prohibited ; (?:unauthori[sz]ed )?reproduction (?:or distribution )?(?:in whole or in part )?is (?:strictly )?prohibited
4 ; proprietary ; may republished ; may not be (?:reproduced|copied|published|republished)(?: or (?:distributed|republished))? without
3 ; mit ; spdx mit ; spdx license identifier mit
3 ; isc ; spdx isc ; spdx license identifier isc
3 ; bsd-2-clause ; spdx bsd ; spdx license identifier bsd 2 clause
3 ; bsd-3-clause ; spdx bsd ; spdx license identifier bsd 3 clause
3 ; unlicense ; spdx unlicense ; spdx license identifier unlicense
3 ; zlib ; spdx zlib ; spdx license identifier zlib
3 ; mit ; opensource mit ; opensource org licenses mit
3 ; isc ; opensource isc ; opensource org licenses isc
3 ; bsd-2-clause ; opensource bsd ; opensource org licenses bsd 2 clause
3 ; bsd-3-clause ; opensource bsd ; opensource org licenses bsd 3 clause
3 ; bsd ; opensource bsd ; opensource org licenses bsd licen[cs]e
3 ; unlicense ; unlicense org ; unlicense org
3 ; bsd-1-clause ; bsd clause ; (?:bsd 1 clause|(?:1|one) clause bsd)(?: licen[cs]e)?
3 ; bsd-2-clause ; bsd clause ; (?:bsd 2 clause|(?:2|two) clause bsd)(?: licen[cs]e)?
3 ; bsd-3-clause ; bsd clause ; (?:bsd 3 clause|(?:3|three) clause bsd)(?: licen[cs]e)?
3 ; bsd-4-clause ; bsd clause ; (?:bsd 4 clause|(?:4|four) clause bsd)(?: licen[cs]e)?
3 ; bsd-2-clause ; simplified bsd ; simplified bsd(?: licen[cs]e)?
3 ; bsd-2-clause ; freebsd ; freebsd licen[cs]e
3 ; bsd-3-clause ; new bsd ; new bsd(?: licen[cs]e)?
3 ; bsd-3-clause ; modified bsd ; modified bsd(?: licen[cs]e)?
3 ; bsd-4-clause ; original bsd ; original bsd(?: licen[cs]e)?
3 ; 0bsd ; 0bsd ; 0bsd
3 ; 0bsd ; zero clause bsd ; zero clause bsd(?: licen[cs]e)?
3 ; mit-0 ; mit attribution ; mit no attribution(?: licen[cs]e)?
3 ; mit-0 ; mit 0 ; mit 0
3 ; ms-pl ; microsoft public ; microsoft public licen[cs]e
3 ; ms-pl ; ms pl ; ms pl
3 ; ms-rl ; microsoft reciprocal ; microsoft reciprocal licen[cs]e
3 ; ms-rl ; ms rl ; ms rl
2 ; gpl ; gnu gpl ; gnu gpl
2 ; gpl ; gpl ; gpl licen[cs]ed?
2 ; gpl ; general public ; general public licen[cs]e
2 ; lgpl ; gnu public ; gnu (?:lesser|library) general public licen[cs]e
2 ; lgpl ; lgpl ; lgpl
2 ; agpl ; affero ; (?:gnu )?affero general public licen[cs]e
2 ; agpl ; agpl ; agpl
2 ; gfdl ; gnu documentation ; gnu free documentation licen[cs]e
2 ; apache ; apache ; apache(?: software)? licen[cs]e
2 ; apache ; apache ; apache licen[cs]ed
2 ; mit ; mit ; mit(?: style)? licen[cs]ed?
2 ; mit ; expat ; expat licen[cs]e
2 ; x11 ; x11 ; x11 licen[cs]e
2 ; bsd ; bsd ; bsd(?: style)? licen[cs]ed?
2 ; isc ; isc ; isc licen[cs]ed?
2 ; mpl ; mozilla public ; mozilla public licen[cs]e
2 ; epl ; eclipse public ; eclipse public licen[cs]e
2 ; cddl ; development distribution ; common development and distribution licen[cs]e
2 ; eupl ; european union public ; european union public licen[cs]e
2 ; osl ; open software ; open software licen[cs]e
2 ; afl ; academic free ; academic free licen[cs]e
2 ; artistic ; artistic ; artistic licen[cs]e
2 ; cecill ; cecill ; cecill(?: [bc])?
2 ; ecl ; educational community ; educational community licen[cs]e
2 ; lppl ; latex project public ; latex project public licen[cs]e
2 ; ofl ; open font ; (?:sil )?open font licen[cs]e
2 ; zpl ; zope public ; zope public licen[cs]e
2 ; psf ; python foundation ; python software foundation licen[cs]e
2 ; psf ; psf ; psf licen[cs]e
2 ; boost ; boost ; boost software licen[cs]e
2 ; apsl ; apple public source ; apple public source licen[cs]e
2 ; npl ; netscape public ; netscape public licen[cs]e
2 ; qpl ; q public ; q public licen[cs]e
2 ; cpl ; common public ; common public licen[cs]e
2 ; ipl ; ibm public ; ibm public licen[cs]e
2 ; upl ; universal permissive ; universal permissive licen[cs]e
2 ; odbl ; open database ; (?:odc )?open database licen[cs]e
2 ; odc-by ; open commons attribution ; open data commons attribution licen[cs]e
2 ; pddl ; public domain dedication ; public domain dedication and licen[cs]e
2 ; busl ; business source ; business source licen[cs]e
2 ; sspl ; server side public ; server side public licen[cs]e
2 ; elastic ; elastic ; elastic licen[cs]e
2 ; cern-ohl ; cern hardware ; cern open hardware licen[cs]e
2 ; unlicense ; unlicense ; (?:the )?unlicense
2 ; wtfpl ; wtfpl ; wtfpl
2 ; zlib ; zlib ; zlib(?: libpng)? licen[cs]e
2 ; libpng ; libpng ; libpng licen[cs]e
2 ; openssl ; openssl ; openssl licen[cs]e
2 ; ssleay ; ssleay ; ssleay licen[cs]e
2 ; php ; php ; php licen[cs]e
2 ; ruby ; ruby ; ruby licen[cs]e
2 ; vim ; vim ; vim licen[cs]e
2 ; curl ; curl ; curl licen[cs]e
2 ; icu ; icu ; icu licen[cs]e
2 ; ncsa ; ncsa ; (?:university of illinois )?ncsa(?: open source)? licen[cs]e
2 ; ncsa ; university illinois ; university of illinois open source licen[cs]e
2 ; w3c ; w3c ; w3c software(?: notice and)? licen[cs]e
2 ; json ; json ; json licen[cs]e
2 ; beerware ; beerware ; beerware
2 ; postgresql ; postgresql ; postgresql licen[cs]e
2 ; sleepycat ; sleepycat ; sleepycat licen[cs]e
2 ; intel ; intel open source ; intel open source licen[cs]e
2 ; sun ; sun public ; sun public licen[cs]e
2 ; nokia ; nokia open source ; nokia open source licen[cs]e
2 ; nasa ; nasa open source ; nasa open source(?: agreement)?
2 ; unicode ; unicode ; unicode licen[cs]e agreement
2 ; openldap ; openldap public ; openldap public licen[cs]e
2 ; fair ; fair ; fair licen[cs]e
2 ; ijg ; independent jpeg ; independent jpeg group
2 ; ftl ; freetype ; freetype(?: project)? licen[cs]e
2 ; opl ; open publication ; open publication licen[cs]e
2 ; ogl ; open government ; open government licen[cs]e
2 ; cc0 ; cc0 ; cc0
2 ; cc0 ; creative commons zero ; creative commons zero
2 ; cc ; creative commons ; creative commons(?: public)? licen[cs]e
2 ; public-domain ; public domain ; (?:in|into|to) the public domain
2 ; public-domain ; public domain ; public domain
2 ; commons-clause ; commons clause ; commons clause
2 ; blueoak ; blue oak ; blue oak model licen[cs]e
2 ; mulan ; mulan ; mulan permissive software licen[cs]e
2 ; openrail ; openrail ; (?:creativeml )?openrail(?: m)?
1 ; open-source ; open source ; open source licen[cs]ed?
1 ; free-software ; free software ; this (?:program|library) is free software
1 ; proprietary ; all rights reserved ; all rights reserved
1 ; copyright ; copyright ; copyright (?:c )?(?:19|20)[0-9][0-9]
1 ; copyright ; © ; © (?:19|20)[0-9][0-9]
1 ; copyright-notice ; above copyright notice ; the above copyright notice
1 ; licensed ; licensed under ; licensed under (?:the )?(?:terms|licen[cs]e)
1 ; licensed ; released under ; released under (?:the )?(?:terms|licen[cs]e)
1 ; licensed ; spdx ; spdx licen[cs]e identifier
1 ; licensed ; see file ; see (?:the )?licen[cs]e file
1 ; eula ; end user agreement ; end user licen[cs]e agreement
1 ; eula ; eula ; eula
1 ; terms ; terms conditions ; terms and conditions (?:of use|apply)
"""

# Creative Commons: the elements behind "by", each as its abbreviation and its name.
ELEMENTS = {
    "": "",
    "sa": " share ?alike",
    "nc": " non ?commercial",
    "nd": " no ?deriv(?:ative)?s?",
    "nc sa": " non ?commercial share ?alike",
    "nc nd": " non ?commercial no ?deriv(?:ative)?s?",
}
COMMONS_VERSIONS = "1.0 2.0 2.5 3.0 4.0"


def version_words(version: str) -> str:
    """A version as its words: ``v2``, ``v 2``, ``version 2`` or ``2``, a zero behind the point at will."""
    major, minor = version.split(".")
    return f"(?:version {major}|v {major}|v{major}|{major})" + ("(?: 0)?" if minor == "0" else f" {minor}")


def fields(text: str) -> list[list[str]]:
    return [[part.strip() for part in line.split(" ; ")] for line in text.strip().splitlines()]


def commons() -> list[tuple[str, int, str, str]]:
    out = []
    for short, long in ELEMENTS.items():
        parts = f"by {short}".strip()
        label = "cc-" + parts.replace(" ", "-")
        ways = (
            ("cc by", f"cc {parts}"),
            ("creative commons attribution", f"creative commons attribution{long}"),
            ("creativecommons licenses by", f"creativecommons org licenses {parts}"),
        )
        for keywords, pattern in ways:
            # Names are joined at will: a blank that may be missing is written " ?".
            out.append((label, 2, keywords, pattern))
            for version in COMMONS_VERSIONS.split():
                out.append((f"{label}-{version}", 3, keywords, f"{pattern}(?: international| unported)? {version_words(version)}"))
    return out


def written_rules() -> list[tuple[str, int, str, str]]:
    """``label, priority, keywords, pattern`` of all rules but the contract's phrases."""
    out = [(label, int(priority), keywords, pattern) for priority, label, keywords, pattern in fields(PLAIN)]
    for label, versions, keywords, pattern in fields(VERSIONED):
        for version in versions.split():
            out.append((f"{label}-{version}", 3, keywords, pattern.replace("{v}", version_words(version))))
    for label, versions, pattern in fields(JOINED):
        for version in versions.split():
            major, minor = version.split(".")
            word = pattern.replace("{n}", major)
            out.append((f"{label}-{version}", 3, word, word + ("(?: 0)?" if minor == "0" else f" {minor}")))
    return out + commons()


def over_padded_words(pattern: str) -> str:
    """The pattern for texts in which every word has a blank of its own before and behind it."""
    return " " + pattern.replace(" ?", "(?:  )?").replace(" ", "  ").replace("(?:    )?", "(?:  )?") + " "


def all_rules() -> list[Rule]:
    """Base phrases first, then by priority as written."""
    base = [Rule(i, label, 2, tuple(p.split()), over_padded_words(p), True) for i, (label, p) in enumerate(BASE)]
    ordered = sorted(written_rules(), key=lambda r: -r[1])
    return base + [
        Rule(i, label, priority, tuple(keywords.split()), over_padded_words(pattern), False)
        for i, (label, priority, keywords, pattern) in enumerate(ordered, len(base))
    ]
