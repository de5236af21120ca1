"""Signatures of licenses.

Patterns are written over words: a blank stands between two words, and
everything but a-z, 0-9 and letters beyond ASCII separates words, so "2.0"
reads "2 0". They are plain enough to mean the same in every regular
expression library.
"""

from __future__ import annotations

from typing import NamedTuple

#: Priorities: a name alone, a name with its version or a distinctive sentence, a machine-readable tag.
NAME, EXACT, TAG = 1, 2, 3


class Rule(NamedTuple):
    label: str
    #: In the words of every text that the pattern can match.
    keyword: str
    pattern: str
    priority: int
    base: bool = False


_BASE = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]

# Families with versions: label, keyword, ways to write the name, versions.
_FAMILIES = [
    ("gpl", "gpl", ["gpl"], ["1.0", "2.0", "3.0"]),
    ("gpl", "general public", ["gnu general public licen[cs]e"], ["1.0", "2.0", "3.0"]),
    ("gpl", "gnu gpl", ["gnu gpl licen[cs]e"], ["1.0", "2.0", "3.0"]),
    ("lgpl", "lgpl", ["lgpl"], ["2.0", "2.1", "3.0"]),
    ("lgpl", "general public", ["gnu (?:lesser|library) general public licen[cs]e"], ["2.0", "2.1", "3.0"]),
    ("agpl", "agpl", ["agpl"], ["1.0", "3.0"]),
    ("agpl", "affero", ["(?:gnu )?affero general public licen[cs]e"], ["1.0", "3.0"]),
    ("gfdl", "documentation", ["gnu free documentation licen[cs]e"], ["1.1", "1.2", "1.3"]),
    ("apache", "apache", ["apache(?: software)? licen[cs]e"], ["1.0", "1.1", "2.0"]),
    ("mpl", "mozilla", ["mozilla public licen[cs]e"], ["1.0", "1.1", "2.0"]),
    ("mpl", "mpl", ["mpl"], ["1.0", "1.1", "2.0"]),
    ("epl", "eclipse", ["eclipse public licen[cs]e"], ["1.0", "2.0"]),
    ("edl", "eclipse", ["eclipse distribution licen[cs]e"], ["1.0"]),
    ("cddl", "development and distribution", ["common development and distribution licen[cs]e"], ["1.0", "1.1"]),
    ("cpl", "common public", ["common public licen[cs]e"], ["1.0"]),
    ("eupl", "european union", ["european union public licen[cs]e"], ["1.0", "1.1", "1.2"]),
    ("osl", "open software", ["open software licen[cs]e"], ["1.0", "1.1", "2.0", "2.1", "3.0"]),
    ("afl", "academic free", ["academic free licen[cs]e"], ["1.1", "1.2", "2.0", "2.1", "3.0"]),
    ("ecl", "educational", ["educational community licen[cs]e"], ["1.0", "2.0"]),
    ("artistic", "artistic", ["(?:perl )?artistic licen[cs]e"], ["1.0", "2.0"]),
    ("ofl", "open font", ["sil open font licen[cs]e"], ["1.0", "1.1"]),
    ("lppl", "latex project", ["latex project public licen[cs]e"], ["1.0", "1.1", "1.2", "1.3"]),
    ("psf", "python software", ["python software foundation licen[cs]e"], ["2.0"]),
    ("zpl", "zope", ["zope public licen[cs]e"], ["1.1", "2.0", "2.1"]),
    ("upl", "universal permissive", ["universal permissive licen[cs]e"], ["1.0"]),
    ("bsl", "boost", ["boost software licen[cs]e"], ["1.0"]),
    ("busl", "business source", ["business source licen[cs]e"], ["1.1"]),
    ("sspl", "server side", ["server side public licen[cs]e"], ["1.0"]),
    ("elastic", "elastic", ["elastic licen[cs]e"], ["2.0"]),
    ("cecill", "cecill", ["cecill(?: free software)?(?: licen[cs]e)?(?: agreement)?"], ["1.0", "1.1", "2.0", "2.1"]),
    ("odbl", "database", ["open database licen[cs]e"], ["1.0"]),
    ("odc-by", "data commons", ["open data commons attribution licen[cs]e"], ["1.0"]),
    ("pddl", "data commons", ["open data commons public domain dedication(?: and licen[cs]e)?"], ["1.0"]),
    ("cdla-permissive", "community data", ["community data licen[cs]e agreement permissive"], ["1.0", "2.0"]),
    ("cdla-sharing", "community data", ["community data licen[cs]e agreement sharing"], ["1.0"]),
    ("ms-pl", "microsoft", ["microsoft public licen[cs]e"], ["1.0"]),
    ("ms-rl", "microsoft", ["microsoft reciprocal licen[cs]e"], ["1.0"]),
    ("apsl", "apple public", ["apple public source licen[cs]e"], ["1.0", "1.1", "1.2", "2.0"]),
    ("rpl", "reciprocal public", ["reciprocal public licen[cs]e"], ["1.1", "1.5"]),
    ("qpl", "q public", ["q public licen[cs]e"], ["1.0"]),
    ("npl", "netscape", ["netscape public licen[cs]e"], ["1.0", "1.1"]),
    ("spl", "sun public", ["sun public licen[cs]e"], ["1.0"]),
    ("ipl", "ibm public", ["ibm public licen[cs]e"], ["1.0"]),
    ("mulan-psl", "mulan", ["mulan permissive software licen[cs]e"], ["1.0", "2.0"]),
    ("php", "php licen", ["php licen[cs]e"], ["3.0", "3.01"]),
    ("w3c", "w3c", ["w3c software(?: notice and)?(?: and)?(?: document)? licen[cs]e"], ["1.0"]),
]

# Creative Commons terms: label, short form, long form.
_COMMONS = [
    ("by", "by", "attribution"),
    ("by-sa", "by sa", "attribution share ?alike"),
    ("by-nc", "by nc", "attribution non ?commercial"),
    ("by-nd", "by nd", "attribution no ?deriv(?:ative)?s?"),
    ("by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?"),
]
_COMMONS_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]

_GRANT = "permission is hereby granted free of charge to any person obtaining a copy"

# Names without versions and distinctive sentences: label, keyword, pattern, priority.
_OTHERS = [
    ("mit", "mit licen", "(?:the )?mit licen[cs]e", NAME),
    ("mit", "expat", "expat licen[cs]e", NAME),
    ("mit", "permission is hereby granted", _GRANT, EXACT),
    ("mit", "to deal in the software", "to deal in the software without restriction", EXACT),
    # Other licenses begin with the same words; theirs are longer, which suppresses the one for mit.
    ("ofl", "font software", f"{_GRANT} of the font software", EXACT),
    ("ncsa", "to deal with the software",
     f"{_GRANT} of this software and associated documentation files the software to deal with the software", EXACT),
    ("unicode", "data files", f"{_GRANT} of (?:the unicode )?data files", EXACT),
    ("upl", "associated documentation and or data", f"{_GRANT} of this software associated documentation and or data", EXACT),
    ("mit-0", "mit no attribution", "mit no attribution(?: licen[cs]e)?", EXACT),
    ("x11", "x11 licen", "x11 licen[cs]e", NAME),
    ("isc", "isc licen", "isc licen[cs]e", NAME),
    ("isc", "distribute this software", "permission to use copy modify and or distribute this software for any purpose", EXACT),
    ("0bsd", "zero clause", "(?:bsd )?zero clause(?: bsd)? licen[cs]e", EXACT),
    ("bsd-2-clause", "clause", "(?:bsd 2 clause|2 clause bsd)(?: licen[cs]e)?", EXACT),
    ("bsd-2-clause", "simplified bsd", "simplified bsd(?: licen[cs]e)?", EXACT),
    ("bsd-2-clause", "freebsd licen", "freebsd licen[cs]e", EXACT),
    ("bsd-3-clause", "clause", "(?:bsd 3 clause|3 clause bsd)(?: licen[cs]e)?", EXACT),
    ("bsd-3-clause", "bsd licen", "(?:new|modified|revised) bsd licen[cs]e", EXACT),
    ("bsd-3-clause", "endorse or promote", "may be used to endorse or promote products derived from this software", EXACT),
    ("bsd-4-clause", "clause", "(?:bsd 4 clause|4 clause bsd)(?: licen[cs]e)?", EXACT),
    ("bsd-4-clause", "bsd licen", "original bsd licen[cs]e", EXACT),
    ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software", EXACT),
    ("bsd", "bsd licen", "bsd licen[cs]e", NAME),
    ("bsd", "bsd style", "bsd style licen[cs]e", NAME),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms with or without modification", NAME),
    ("zlib", "zlib", "zlib(?: libpng)? licen[cs]e", NAME),
    ("zlib", "origin of this software", "the origin of this software must not be misrepresented", EXACT),
    ("libpng", "libpng", "libpng licen[cs]e", NAME),
    ("unlicense", "unlicense", "(?:the )?unlicense", NAME),
    ("unlicense", "unencumbered", "free and unencumbered software released into the public domain", EXACT),
    ("wtfpl", "wtfpl", "wtfpl", NAME),
    ("wtfpl", "fuck you want", "do what the fuck you want to public licen[cs]e", EXACT),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?(?: universal)?", EXACT),
    ("cc0-1.0", "creative commons", "creative commons (?:zero|public domain dedication)", EXACT),
    ("public-domain", "public domain", "(?:is|are|been|released|placed|dedicated) (?:in|into|to) the public domain", NAME),
    ("public-domain-mark", "public domain", "public domain mark(?: 1 0)?", EXACT),
    ("openssl", "openssl", "openssl licen[cs]e", NAME),
    ("openssl", "openssl", "developed by the openssl project for use in the openssl toolkit", EXACT),
    ("python", "python licen", "python licen[cs]e", NAME),
    ("ruby", "ruby", "ruby s? ?licen[cs]e", NAME),
    ("perl", "perl", "same terms as perl(?: itself)?", NAME),
    ("vim", "vim licen", "vim licen[cs]e", NAME),
    ("curl", "curl licen", "curl licen[cs]e", NAME),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)? licen[cs]e", NAME),
    ("postgresql", "postgresql", "postgresql licen[cs]e", NAME),
    ("sqlite-blessing", "blessing", "in place of a legal notice here is a blessing", EXACT),
    ("beerware", "beer", "(?:the )?beer ?ware licen[cs]e", NAME),
    ("json", "good not evil", "shall be used for good not evil", EXACT),
    ("ftl", "freetype", "freetype(?: project)? licen[cs]e", NAME),
    ("ijg", "jpeg group", "independent jpeg group", NAME),
    ("unicode", "unicode", "unicode licen[cs]e(?: agreement)?", NAME),
    ("hpnd", "historical permission", "historical permission notice and disclaimer", EXACT),
    ("fair", "fair licen", "fair licen[cs]e", NAME),
    ("naumen", "naumen", "naumen public licen[cs]e", NAME),
    ("intel", "intel", "intel open source licen[cs]e", NAME),
    ("sleepycat", "sleepycat", "sleepycat licen[cs]e", NAME),
    ("watcom", "watcom", "sybase open watcom public licen[cs]e", NAME),
    ("commons-clause", "commons clause", "commons clause licen[cs]e condition", EXACT),
    ("polyform", "polyform", "polyform (?:noncommercial|small business|shield|strict) licen[cs]e", NAME),
    ("prosperity", "prosperity", "prosperity public licen[cs]e", NAME),
    ("parity", "parity public", "parity public licen[cs]e", NAME),
    ("blue-oak", "blue oak", "blue oak model licen[cs]e", NAME),
    ("openrail", "openrail", "(?:creativeml )?openrail(?: m| s| d)?(?: licen[cs]e)?", NAME),
    ("openrail", "open rail", "(?:creativeml )?open rail(?: m| s| d)?(?: licen[cs]e)?", NAME),
    ("bigscience-rail", "rail licen", "(?:bigscience|bloom) rail licen[cs]e", NAME),
    ("llama", "llama", "llama [0-9]+(?: [0-9]+)? community licen[cs]e(?: agreement)?", EXACT),
    ("gemma", "gemma", "gemma terms of use", EXACT),
    ("ogl", "open government", "open government licen[cs]e", NAME),
    ("etalab", "licence ouverte", "licence ouverte", NAME),
    ("dl-de", "datenlizenz", "datenlizenz deutschland", NAME),
    ("proprietary", "all rights reserved", "all rights reserved", NAME),
    ("proprietary", "proprietary", "proprietary and confidential", EXACT),
]


def _version(text: str) -> str:
    """Words of a version; a zero at the end may be missing."""
    head, _, tail = text.partition(".")
    return f"v?{head}(?: 0)?" if tail == "0" else f"v?{head} {tail}"


def _rules() -> list[Rule]:
    found = [Rule(label, phrase, phrase, NAME, True) for label, phrase in _BASE]
    tags: dict[str, str] = {}
    for label, keyword, names, versions in _FAMILIES:
        name = f"(?:{'|'.join(names)})"
        found.append(Rule(label, keyword, name, NAME))
        for v in versions:
            said = f"{name}(?: v| version)? {_version(v)}"
            found.append(Rule(f"{label}-{v}", keyword, said, EXACT))
            if label in ("gpl", "lgpl", "agpl", "gfdl"):
                found.append(Rule(f"{label}-{v}-or-later", keyword,
                                  f"{said}(?: of the licen[cs]e)? or(?: at your option)? (?:any )?later(?: version)?",
                                  EXACT))
            tags[f"{label}-{v}"] = f"{label.replace('-', ' ')} {v.replace('.', ' ')}"
    for label, short, long in _COMMONS:
        found.append(Rule(f"cc-{label}", "cc by", f"cc {short}", NAME))
        found.append(Rule(f"cc-{label}", "creative commons", f"creative commons {long}(?: licen[cs]e)?", NAME))
        for v in _COMMONS_VERSIONS:
            number = v.replace(".", " ")
            found.append(Rule(f"cc-{label}-{v}", "cc by", f"cc {short} {number}", EXACT))
            found.append(Rule(f"cc-{label}-{v}", "creative commons",
                              f"creative commons {long} {number}(?: international| unported| generic)?", EXACT))
            tags[f"cc-{label}-{v}"] = f"cc {short} {number}"
    for label, keyword, pattern, priority in _OTHERS:
        found.append(Rule(label, keyword, pattern.replace(" s? ?", "(?: s)? "), priority))
        tags.setdefault(label, label.replace("-", " ").replace(".", " "))
    found += [Rule(label, "spdx license identifier", f"spdx license identifier {words}", TAG)
              for label, words in sorted(tags.items())]
    return found


def over_words(pattern: str) -> str:
    """A pattern for texts in which every word has a blank on either side."""
    out = pattern.replace(" ?", "\0").replace(" ", "  ").replace("\0", "(?:  )?")
    return f" {out} "


RULES = _rules()
#: One of these is in the words of every text that a rule can match.
GATE = ["licen", "cc  by", "cc0", "gpl", "spdx", "public  domain", "creative  commons", "mozilla", "permission",
        "redistribution", "copyright", "rights  reserved", "software", "openrail", "open  rail", "wtfpl", "perl",
        "mpl", "blessing", "not  evil", "cecill", "jpeg  group", "gemma  terms", "data  commons",
        "no  attribution", "openssl", "datenlizenz", "clause", "simplified  bsd", "proprietary", "historical"]
