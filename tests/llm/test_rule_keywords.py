"""A rule's keyword and a word of the gate are in everything that its pattern can match."""

import re
from re import _constants as kinds
from re import _parser as parser

from adtally.llm.license_rules import GATE, RULES, over_words
from adtally.llm.licenses import scan_licenses


def every(tree):
    """A string for each choice of alternatives and of optional parts."""
    out = [""]
    for kind, value in tree:
        if kind is kinds.LITERAL:
            some = [chr(value)]
        elif kind is kinds.IN:
            some = [chr(v if k is kinds.LITERAL else v[0]) for k, v in value]
        elif kind is kinds.SUBPATTERN:
            some = every(value[3])
        elif kind is kinds.BRANCH:
            some = [x for part in value[1] for x in every(part)]
        else:
            assert kind is kinds.MAX_REPEAT
            some = [""] * (value[0] == 0) + every(value[2])
        out = [a + b for a in out for b in some]
    return out


def test_keywords_are_implied():
    for rule in RULES:
        pattern = over_words(rule.pattern)
        for text in every(parser.parse(pattern)):
            assert re.fullmatch(pattern, text)
            assert rule.keyword.replace(" ", "  ") in text and any(g in text for g in GATE), (rule, text)


GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy"
TEXTS = {
    "CreativeML Open RAIL-M": "openrail",
    "the BigScience OpenRAIL-M licence": "openrail",
    "Simplified BSD License": "bsd-2-clause",
    "a BSD-style license": "bsd",
    "GNU GPL license 2.0": "gpl-2.0",
    "GNU GPL licence, version 3 or later": "gpl-3.0-or-later",
    GRANT: "mit",
    f"{GRANT} of this software": "mit",
    f"{GRANT} of the Font Software, to use": "ofl",
    f'{GRANT} of this software and associated documentation files (the "Software"), to deal with the Software': "ncsa",
    f"{GRANT} of the Unicode data files": "unicode",
    f"{GRANT} of this software, associated documentation and/or data": "upl",
}


def test_labels_of_texts_without_other_words(spark):
    rows = list(enumerate(TEXTS))
    got = {r.doc_id: r.labels for r in scan_licenses(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {text: got[k] for k, text in rows} == TEXTS
