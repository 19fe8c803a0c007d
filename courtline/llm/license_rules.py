"""The license signatures of operator 4, in order.

A family is hand-written: label, keyword, the name as a regular expression over
normalised words (lower case, one blank between words), and the versions its
label can carry.  Every family and version makes the same few signatures, from
the most telling to the least.  The licenses' own words (``TEXTS``) are
hand-written signatures.  ``rules()`` lists them all.
"""

from __future__ import annotations

from dataclasses import dataclass

#: label, keyword (a substring of the normalised text), name, versions
FAMILIES = [
    ("mit", " mit ", "mit", ()),
    ("mit-0", " mit ", "mit (?:0|no attribution)", ()),
    ("apache", " apache ", "apache(?: software)?", ("1 0", "1 1", "2 0", "2")),
    ("gpl", " gpl", "(?:gnu )?gpl", ("1", "2", "3", "2 0", "3 0")),
    ("gpl", " general public ", "(?:gnu )?general public", ("1", "2", "3", "2 0", "3 0")),
    ("lgpl", " lgpl", "(?:gnu )?lgpl", ("2", "2 1", "3", "3 0")),
    ("lgpl", " lesser general ", "(?:gnu )?lesser general public", ("2 1", "3", "3 0")),
    ("lgpl", " library general ", "(?:gnu )?library general public", ("2", "2 0")),
    ("agpl", " agpl", "(?:gnu )?agpl", ("1", "3", "3 0")),
    ("agpl", " affero ", "(?:gnu )?affero general public", ("1", "3", "3 0")),
    ("gfdl", " free documentation ", "(?:gnu )?free documentation", ("1 1", "1 2", "1 3")),
    ("bsd-2-clause", " bsd ", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", ()),
    ("bsd-3-clause", " bsd ", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)", ()),
    ("bsd-4-clause", " bsd ", "(?:bsd 4 clause|4 clause bsd|original bsd)", ()),
    ("bsd", " bsd ", "(?:berkeley )?bsd", ()),
    ("0bsd", " 0bsd ", "(?:0bsd|zero clause bsd)", ()),
    ("mpl", " mozilla ", "mozilla(?: public)?", ("1 0", "1 1", "2 0")),
    ("mpl", " mpl", "mpl", ("1 0", "1 1", "2 0")),
    ("epl", " eclipse ", "eclipse(?: public)?", ("1 0", "2 0")),
    ("edl", " eclipse ", "eclipse distribution", ("1 0",)),
    ("cddl", " cddl", "cddl", ("1 0", "1 1")),
    ("cddl", " common development ", "common development and distribution", ("1 0", "1 1")),
    ("cpl", " common public ", "common public", ("1 0",)),
    ("ipl", " ibm public ", "ibm public", ("1 0",)),
    ("isc", " isc ", "isc", ()),
    ("zlib", " zlib ", "zlib(?: libpng)?", ()),
    ("libpng", " libpng ", "libpng", ("2 0",)),
    ("bsl", " boost ", "boost(?: software)?", ("1 0",)),
    ("artistic", " artistic ", "(?:perl )?artistic", ("1 0", "2 0")),
    ("unlicense", " unlicense ", "unlicense", ()),
    ("wtfpl", " wtfpl", "wtfpl", ("2", "2 0")),
    ("cc0", " cc0", "cc0", ("1 0",)),
    ("cc-by", " attribution ", "(?:creative commons )?attribution", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", " sharealike ", "(?:creative commons )?attribution sharealike", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", " noncommercial ", "(?:creative commons )?attribution noncommercial", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", " noderivatives ", "(?:creative commons )?attribution noderivatives", ("2 0", "3 0", "4 0")),
    ("cc-by", " cc by ", "cc by", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", " cc by sa ", "cc by sa", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", " cc by nc ", "cc by nc", ("2 0", "3 0", "4 0")),
    ("cc-by-nd", " cc by nd ", "cc by nd", ("2 0", "3 0", "4 0")),
    ("cc-by-nc-sa", " cc by nc sa ", "cc by nc sa", ("2 0", "3 0", "4 0")),
    ("cc-by-nc-nd", " cc by nc nd ", "cc by nc nd", ("2 0", "3 0", "4 0")),
    ("eupl", " eupl", "eupl", ("1 0", "1 1", "1 2")),
    ("eupl", " european union public ", "european union public", ("1 0", "1 1", "1 2")),
    ("cecill", " cecill", "cecill", ("1 0", "2 0", "2 1")),
    ("osl", " open software ", "open software", ("1 0", "2 0", "3 0")),
    ("afl", " academic free ", "academic free", ("2 0", "2 1", "3 0")),
    ("ofl", " open font ", "(?:sil )?open font", ("1 0", "1 1")),
    ("odbl", " open database ", "open database", ("1 0",)),
    ("odc-by", " open data commons ", "open data commons attribution", ("1 0",)),
    ("pddl", " public domain dedication ", "public domain dedication(?: and)?", ("1 0",)),
    ("psf", " python ", "python(?: software foundation)?", ("2", "2 0")),
    ("php", " php ", "php", ("3 0", "3 01")),
    ("ruby", " ruby ", "ruby", ()),
    ("vim", " vim ", "vim", ()),
    ("x11", " x11 ", "x11", ()),
    ("ncsa", " ncsa ", "(?:university of illinois )?ncsa(?: open source)?", ()),
    ("postgresql", " postgresql ", "postgresql", ()),
    ("openssl", " openssl ", "openssl", ()),
    ("sleepycat", " sleepycat ", "sleepycat", ()),
    ("upl", " universal permissive ", "universal permissive", ("1 0",)),
    ("ms-pl", " microsoft ", "microsoft public", ()),
    ("ms-rl", " microsoft ", "microsoft reciprocal", ()),
    ("nasa", " nasa ", "nasa open source", ("1 3",)),
    ("qpl", " q public ", "q public", ("1 0",)),
    ("spl", " sun public ", "sun public", ("1 0",)),
    ("w3c", " w3c ", "w3c(?: software)?", ()),
    ("sspl", " sspl", "sspl", ("1 0",)),
    ("sspl", " server side public ", "server side public", ("1 0",)),
    ("busl", " business source ", "business source", ("1 0", "1 1")),
    ("elastic", " elastic ", "elastic", ("2", "2 0")),
    ("commons-clause", " commons clause ", "commons clause", ("1 0",)),
    ("public-domain", " public domain ", "(?:dedicated to the |in the )?public domain", ()),
    ("proprietary", " proprietary ", "proprietary", ()),
]

#: Acronyms: names that say a license by themselves.
FAMILIES += [
    ("agpl", " affero ", "(?:gnu )?affero gpl", ("1", "3", "3 0")),
    ("gfdl", " gfdl", "(?:gnu )?gfdl", ("1 1", "1 2", "1 3")),
    ("epl", " epl", "epl", ("1 0", "2 0")),
    ("bsl", " bsl ", "bsl", ("1 0",)),
    ("busl", " busl", "busl", ("1 1",)),
    ("osl", " osl ", "osl", ("1 0", "2 0", "3 0")),
    ("afl", " afl ", "afl", ("2 0", "2 1", "3 0")),
    ("ofl", " ofl ", "(?:sil )?ofl", ("1 0", "1 1")),
    ("odbl", " odbl", "odbl", ("1 0",)),
    ("pddl", " pddl", "pddl", ("1 0",)),
    ("ms-pl", " ms pl ", "ms pl", ()),
    ("ms-rl", " ms rl ", "ms rl", ()),
]

#: Keywords of families whose name needs no "license" after "released under".
ALONE = {" mit ", " apache ", " gpl", " lgpl", " agpl", " affero ", " gfdl", " bsd ", " 0bsd ", " mpl", " epl", " cddl", " bsl ", " busl", " osl ", " afl ", " ofl ", " odbl", " pddl", " ms pl ", " ms rl ",
         " isc ", " zlib ", " unlicense ", " wtfpl", " cc0", " cc by ", " cc by sa ", " cc by nc ", " cc by nd ", " cc by nc sa ", " cc by nc nd ", " eupl", " cecill", " ncsa ", " sspl"}
#: Those whose name and version are a license wherever they stand (GPLv2, MPL 2.0).
VERSIONED = {" gpl", " lgpl", " agpl", " gfdl", " mpl", " cddl", " cc0", " cc by ", " cc by sa ", " cc by nc ", " cc by nd ", " cc by nc sa ", " cc by nc nd ", " eupl", " cecill", " wtfpl", " sspl", " odbl"}

#: What a BSD text begins with, and words up to a clause that tells its kind; none of the warranty that ends the clauses.
_BSD = " redistributions? and use (?:of this software )?in source and binary forms with or without modification (?:are|is) permitted"
_CLAUSES = "(?: (?!advertising |provided (?:by|as) )[^ ]+){0,160}?"
_MIT = " permission is hereby granted free of charge to any person obtaining a copy of this software and(?: the)? associated documentation files(?: the software)?"
_MIT_RIGHTS = " to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"
_ISC = " permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"
_HPND = " permission to use copy modify(?: and| and or)? distribute(?: and sell)? this software and its documentation for any purpose"

#: Hand-written signatures of the licenses' own words: label, keyword, pattern, priority.
TEXTS = [
    ("mit", " permission is hereby granted ", f"{_MIT}{_MIT_RIGHTS} subject to the following conditions", 4),
    ("mit-0", " permission is hereby granted ", f"{_MIT}{_MIT_RIGHTS}(?! subject )", 4),
    ("mit", " permission is hereby granted ", _MIT, 3),
    ("ncsa", " permission is hereby granted ", f"{_MIT} to deal with the software without restriction", 4),
    ("x11", " shall not be used in advertising ", " except as contained in this notice the names? of(?: [^ ]+){1,8}? shall not be used in advertising", 3),
    ("ofl", " font software ", " permission is hereby granted free of charge to any person obtaining a copy of the font software", 4),
    ("bsl", " permission is hereby granted ", " permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", 4),
    ("json", " for good not evil ", " the software shall be used for good not evil", 3),
    ("isc", " permission to use copy modify ", f"{_ISC} provided that the above copyright notice and this permission notice appear in all copies", 4),
    ("0bsd", " permission to use copy modify ", f"{_ISC}(?! provided )", 4),
    ("isc", " permission to use copy modify ", f"{_ISC} provided that", 3),
    ("postgresql", " permission to use copy modify ", f"{_HPND} without fee and without a written agreement is hereby granted", 4),
    ("hpnd", " permission to use copy modify ", f"{_HPND}(?: and)?(?: without fee)? is hereby granted(?: without fee)?", 4),
    ("bsd-4-clause", " in source and binary forms ", f"{_BSD}{_CLAUSES} all advertising materials mentioning features", 4),
    ("bsd-3-clause", " in source and binary forms ", f"{_BSD}{_CLAUSES} (?:neither the names? of|(?:the )?names? of(?: [^ ]+){{1,8}}? may not be used to endorse)", 4),
    ("bsd-2-clause", " in source and binary forms ", f"{_BSD}{_CLAUSES} materials provided with the distribution (?:the views and conclusions|this software is provided)", 4),
    ("apache-1.1", " in source and binary forms ", f"{_BSD}{_CLAUSES} this product includes software developed by the apache software foundation", 4),
    ("bsd", " in source and binary forms ", _BSD, 3),
    ("zlib", " permission is granted to anyone ", " permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely", 4),
    ("unlicense", " unencumbered software ", " this is free and unencumbered software(?: released into the public domain)?", 4),
    ("unlicense", " unlicense ", " (?:the )?unlicense", 1),
    ("cc0", " dedicated the work ", " has dedicated the work to the public domain by waiving all of (?:his or her|their) rights", 4),
    ("cc0-1.0", " publicdomain zero ", " creativecommons org publicdomain zero 1 0", 4),
    ("cc0-1.0", " cc0 ", " cc0 1 0 universal(?: public domain dedication)?", 3),
    ("cc0", " cc0 ", " cc0(?: universal)?(?: public domain dedication)?", 1),
    ("wtfpl", " fuck you want to ", " (?:you just )?do what the fuck you want to(?: public licen[cs]e)?", 4),
    ("beerware", " beer ware ", " beer ware licen[cs]e", 2),
    ("beerware", " as long as you retain this notice ", " as long as you retain this notice you can do whatever you want with this stuff", 4),
    ("psf", " python software foundation ", " this licen[cs]e agreement is between the python software foundation", 3),
    ("public-domain", " public domain ", " (?:released|placed|put|dedicated|donated|committed|given)(?: [^ ]+){0,4}? (?:in(?: ?to)?|to) the public domain", 2),
    ("public-domain", " public domain ", "(?<! not)(?<! not in)(?<! not in the)(?<! not to)(?<! not to the)(?<! not into)(?<! not into the) (?:(?:in|into|to) )?(?:the )?public domain", 1),
]

#: Creative Commons: label, the name's words, the words in its address.
_CC = [("cc-by", "", "by"), ("cc-by-sa", " share ?alike", "by sa"), ("cc-by-nc", " non ?commercial", "by nc"), ("cc-by-nd", " no ?deriv(?:ative)?s", "by nd"),
       ("cc-by-nc-sa", " non ?commercial share ?alike", "by nc sa"), ("cc-by-nc-nd", " non ?commercial no ?deriv(?:ative)?s", "by nc nd")]
_CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

#: Share of certainty by priority.
WEIGHTS = {1: 0.6, 2: 0.8, 3: 0.9, 4: 1.0}

_LICENSE = "licen[cs]e"
#: Before a version: blank, "v", "version" or both, glued to it or to the name.
_VERSION = "(?: (?:version |ver )?(?:v ?)?|v ?)"
_RELEASED = "(?:released|distributed|redistributed|published|offered|provided|available|issued|covered|sourced|shared|shipped|placed|usable)(?: [^ ]+){0,4}? under (?:the |a |an )?(?:(?:terms|conditions)(?: and conditions)? of )?(?:the )?"


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    keyword: str
    pattern: str
    priority: int
    #: Another substring of every text with a match; often the keyword itself.
    gate: str


def rules() -> list[Rule]:
    """All signatures, in order."""
    out: list[tuple[str, str, str, int, str]] = []
    for label, keyword, name, versions in FAMILIES:
        alone = keyword in ALONE
        called = f"{name}(?: {_LICENSE})?" if alone else f"{name} {_LICENSE}"
        for version in versions:
            own = f"{label}-{version.replace(' ', '.')}"
            number = f"{_VERSION}{version}(?! [0-9])"
            out.append((own, keyword, f" spdx {_LICENSE} identifier {name}{number}(?: only| or later)?", 4, " spdx "))
            out.append((own, keyword, f" licen[cs]ed under (?:the )?(?:terms of the )?{name}(?: {_LICENSE})?{number}", 3, " licen"))
            out.append((own, keyword, f" {name}(?: {_LICENSE}){number}(?: only| or (?:any )?later(?: version)?)?", 2, " licen"))
            out.append((own, keyword, f" {name}{number} {_LICENSE}", 2, " licen"))
            out.append((own, keyword, f" (?:version |v ?){version} of (?:the )?{called}", 2, " of "))
            if alone:
                out.append((own, keyword, f" {_RELEASED}{name}(?: {_LICENSE})?{number}(?: only| or (?:any )?later(?: version)?)?", 3, " under "))
            if keyword in VERSIONED:
                out.append((own, keyword, f" {name}{number}(?: only| or (?:any )?later(?: version)?)?", 2, keyword))
            if name.endswith("general public"):
                out.append((own, keyword, f" {name} {_LICENSE} as published by the free software foundation(?: either)? version {version} of the {_LICENSE}(?: or at your option any later version)?", 3, " licen"))
        out.append((label, keyword, f" spdx {_LICENSE} identifier {name}", 3, " spdx "))
        out.append((label, keyword, f" licen[cs]ed under (?:the )?(?:terms of the )?{name}(?: {_LICENSE})?", 2, " licen"))
        if alone:
            out.append((label, keyword, f" {_RELEASED}{name}(?: {_LICENSE})?", 2, " under "))
        out.append((label, keyword, f" (?:terms of the |the )?{name} {_LICENSE}", 1, " licen"))
    for label, words, address in _CC:
        for version in _CC_VERSIONS:
            own = f"{label}-{version.replace(' ', '.')}"
            out.append((own, " creative commons ", f" creative commons attribution{words}{_VERSION}{version}(?: international| unported| generic)?(?: public)?(?: {_LICENSE})?", 3, " attribution "))
            out.append((own, " creativecommons ", f" creativecommons org licen[cs]es {address} {version}", 4, " licen"))
        out.append((label, " creative commons ", f" creative commons attribution{words}(?! (?:non|share|no ?deriv))", 2, " attribution "))
    out += [(label, keyword, pattern, priority, keyword) for label, keyword, pattern, priority in TEXTS]
    return [Rule(k, label, keyword, pattern + "(?= )", priority, gate) for k, (label, keyword, pattern, priority, gate) in enumerate(out)]


def gates() -> tuple[str, ...]:
    """A text with none of these matches no signature."""
    return tuple(dict.fromkeys(r.gate for r in rules()))
