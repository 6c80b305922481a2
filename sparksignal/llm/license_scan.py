"""License detection by ordered signature rules.

Rules are regular expressions over a text's lower-cased words, joined by single
blanks: names and versions of license families, and hand-written sentences of the
licenses themselves. A rule runs only where its keyword occurs. Detections are taken in
order of priority, then length, then place; one that lies inside a detection
taken before is suppressed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_words, column, record_batch

# The base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# License families as (label, full names, short names, versions).
FAMILIES = (
    ("apache", "apache(?: software)?", "apache|asl", ("1 0", "1 1", "2 0")),
    ("gpl", "gnu general public", "gpl|gnu gpl", ("1", "2", "3")),
    ("lgpl", "gnu (?:lesser|library) general public", "lgpl|gnu lgpl", ("2", "2 1", "3")),
    ("agpl", "gnu affero general public", "agpl|gnu agpl", ("1", "3")),
    ("gfdl", "gnu free documentation", "gfdl|fdl", ("1 1", "1 2", "1 3")),
    ("mpl", "mozilla public", "mpl", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse public", "epl", ("1 0", "2 0")),
    ("cpl", "common public", "cpl", ("0 5", "1 0")),
    ("cddl", "common development and distribution", "cddl", ("1 0", "1 1")),
    ("eupl", "european union public", "eupl", ("1 0", "1 1", "1 2")),
    ("osl", "open software", "osl", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "academic free", "afl", ("1 1", "2 0", "2 1", "3 0")),
    ("artistic", "(?:perl )?artistic", "artistic", ("1 0", "2 0")),
    ("bsl", "boost software", "bsl", ("1 0",)),
    ("zpl", "zope public", "zpl", ("1 1", "2 0", "2 1")),
    ("cecill", "cecill(?: free software)?", "cecill", ("1 0", "1 1", "2 0", "2 1")),
    ("ms-pl", "microsoft public", "ms pl", ()),
    ("ms-rl", "microsoft reciprocal", "ms rl", ()),
    ("odbl", "open (?:data commons open )?database", "odbl", ("1 0",)),
    ("odc-by", "open data commons attribution", "odc by", ("1 0",)),
    ("pddl", "public domain dedication and", "pddl", ("1 0",)),
    ("ofl", "sil open font", "ofl", ("1 0", "1 1")),
    ("psf", "python software foundation", "psf", ("2", "2 0")),
    ("php", "php", "php", ("3 0", "3 01")),
    ("ruby", "ruby", "ruby", ()),
    ("w3c", "w3c(?: software(?: notice and)?)?", "w3c", ()),
    ("zlib", "zlib(?: libpng)?", "zlib", ()),
    ("libpng", "libpng", "libpng", ("2 0",)),
    ("isc", "isc|internet systems consortium", "isc", ()),
    ("x11", "x11|x consortium", "x11", ()),
    ("mit", "mit|expat", "mit|expat", ()),
    ("ncsa", "ncsa open source|university of illinois ncsa open source", "ncsa", ()),
    ("upl", "universal permissive", "upl", ("1 0",)),
    ("vsl", "vovida software", "vsl", ("1 0",)),
    ("openssl", "openssl", "openssl", ()),
    ("postgresql", "postgresql", "postgresql", ()),
    ("qpl", "q public", "qpl", ("1 0",)),
    ("sleepycat", "sleepycat", "sleepycat", ()),
    ("sspl", "server side public", "sspl", ("1",)),
    ("busl", "business source", "busl", ("1 1",)),
    ("apsl", "apple public source", "apsl", ("1 0", "1 1", "1 2", "2 0")),
    ("cpal", "common public attribution", "cpal", ("1 0",)),
    ("nasa", "nasa open source agreement", "nasa", ("1 3",)),
    ("lppl", "latex project public", "lppl", ("1 0", "1 1", "1 2", "1 3")),
    ("unicode", "unicode", "unicode", ()),
    ("unlicense", "unlicense|the unlicense", "unlicense", ()),
    ("wtfpl", "do what the fuck you want to public", "wtfpl", ("1", "2")),
    ("0bsd", "zero clause bsd|bsd zero clause", "0bsd", ()),
    ("bsd-2-clause", "(?:simplified|freebsd|2 clause|two clause) bsd|bsd (?:2|two) clause", "bsd 2 clause", ()),
    ("bsd-3-clause", "(?:modified|revised|new|3 clause|three clause) bsd|bsd (?:3|three) clause", "bsd 3 clause", ()),
    ("bsd-4-clause", "(?:original|4 clause|four clause) bsd|bsd (?:4|four) clause", "bsd 4 clause", ()),
    ("bsd", "bsd", "bsd", ()),
)
# Creative Commons forms and versions.
CREATIVE = (
    ("cc-by", "by", "attribution"),
    ("cc-by-sa", "by sa", "attribution share ?alike"),
    ("cc-by-nd", "by nd", "attribution no ?deriv(?:s|atives|ative works)"),
    ("cc-by-nc", "by nc", "attribution non ?commercial"),
    ("cc-by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:s|atives|ative works)"),
)
CREATIVE_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
# Short names and identifiers that mean a license wherever they stand.
BARE = (
    "gpl lgpl agpl gfdl cddl eupl cecill odbl pddl sspl busl lppl cpal apsl wtfpl unlicense 0bsd".split()
    + ["gnu gpl", "gnu lgpl", "gnu agpl", "ms pl", "ms rl", "odc by", "bsd 2 clause", "bsd 3 clause", "bsd 4 clause"]
)
# How a text says that a license holds.
GRANTS = ("licensed", "released", "distributed", "available")
_MIT_GRANT = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"
_MIT_RIGHTS = (
    "without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
    "and or sell copies of the software and to permit persons to whom the software is furnished to do so"
)
_ISC_GRANT = "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"
_BSD_BINARY = (
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
    "disclaimer in the documentation and or other materials provided with the distribution"
)
# Sentences of the licenses themselves as (label, pattern, keyword, priority). Sentences that several
# licenses share name the family; longer ones that only one has rank higher.
SIGNATURES = (
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge", 45),
    ("mit", _MIT_GRANT, "permission is hereby granted free of charge", 80),
    ("mit", f"{_MIT_GRANT} the software to deal in the software without restriction", "to deal in the software", 85),
    ("mit-0", f"{_MIT_GRANT} the software to deal in the software {_MIT_RIGHTS}(?! subject to)", "furnished to do so", 90),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "this permission notice shall be included", 80),
    ("ncsa", f"{_MIT_GRANT} the software to deal with the software without restriction", "to deal with the software", 85),
    ("x11", "except as contained in this notice the names? of (?:[^ ]+ ){1,20}?shall not be used in advertising or otherwise", "except as contained in this notice", 80),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", "person or organization obtaining a copy", 85),
    ("isc", f"{_ISC_GRANT} provided that the above copyright notice and this permission notice appear in all copies", "with or without fee is hereby granted", 85),
    ("0bsd", f"{_ISC_GRANT}(?! provided)", "with or without fee is hereby granted", 80),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", "without a written agreement is hereby granted", 85),
    ("hpnd", "permission to use copy modify(?: and)? distribute(?: and sell)? this software and its documentation for any purpose (?:and|is hereby granted|with or without fee)", "this software and its documentation for any purpose", 70),
    ("w3c", "permission to copy modify and distribute this software and its documentation with or without modification for any purpose and without fee or royalty", "without fee or royalty", 85),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms", 45),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms", 70),
    ("bsd-2-clause", f"{_BSD_BINARY} this software is provided", "redistributions in binary form must reproduce", 80),
    ("bsd-3-clause", "neither the names? of (?:[^ ]+ ){1,20}?may be used to endorse or promote products derived from this software", "may be used to endorse or promote products", 80),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment", "all advertising materials mentioning features", 85),
    ("apache-1.1", "the end user documentation included with the redistribution if any must include the following acknowledge?ment", "the end user documentation included with", 80),
    ("apache-2.0", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|except as stated in this section patent) license", "each contributor hereby grants to you a perpetual", 80),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at https? www apache org licenses license 2 0", "apache org licenses license 2 0", 85),
    ("apache-2.0", "apache org licenses license 2 0", "apache org licenses license 2 0", 80),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e", "you can redistribute it and or modify it", 60),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e", "you can redistribute it and or modify it", 60),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e", "you can redistribute it and or modify it", 60),
    ("gpl-2", "the gnu general public license is intended to guarantee your freedom to share and change free software", "guarantee your freedom to share and change", 80),
    ("gpl-3", "the gnu general public license is a free copyleft license for software and other kinds of works", "is a free copyleft license for software", 80),
    ("agpl-3", "the gnu affero general public license is a free copyleft license for software and other kinds of works", "is a free copyleft license for software", 80),
    ("lgpl-2", "this is the first released version of the library gpl", "the first released version of the library gpl", 80),
    ("lgpl-2.1", "this is the first released version of the lesser gpl", "the first released version of the lesser gpl", 80),
    ("lgpl-3", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3", "incorporates the terms and conditions of version 3", 80),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at", "a copy of the mpl was not distributed", 80),
    ("epl", "the accompanying program is provided under the terms of this eclipse public license", "the accompanying program is provided under", 70),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain", "associated a work with this deed", 85),
    ("cc0", "the laws of most jurisdictions throughout the world automatically confer exclusive copyright and related rights", "automatically confer exclusive copyright", 80),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software", 85),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software", "anyone is free to copy modify publish", 80),
    ("zlib", "in no event will the authors? be held liable for any damages arising from the use of this software", "be held liable for any damages arising from", 70),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software", "the origin of this software must not be", 80),
    ("wtfpl", "you just do what the fuck you want to", "you just do what the", 80),
    ("artistic-1.0", "the intent of this document is to state the conditions under which a package may be copied", "conditions under which a package may be copied", 80),
    ("artistic-2.0", "this license establishes the terms under which a given free software package may be copied", "a given free software package may be copied", 80),
    ("ofl", "the goals of the open font license ofl are to stimulate worldwide development", "the goals of the open font license", 80),
    ("psf", "psf is making python available to licensee on an as is basis", "psf is making python available", 80),
    ("openssl", "this product includes software developed by the openssl project", "software developed by the openssl project", 70),
)


@dataclass(frozen=True)
class Rule:
    label: str
    #: Over words joined by blanks; needs a blank before and after.
    pattern: str
    #: A text that must occur, at the beginning of a word, for the rule to run.
    keyword: str
    #: 1 to 100; higher rules win, and a detection's score is a hundredth of it.
    priority: int


def _keyword(alternatives: str) -> str | None:
    """The longest plain run of words, where there is but one alternative."""
    if "|" in re.sub(r"\(\?:[^)]*\)\??", "", alternatives):
        return None
    return max(re.split(r"\(\?:[^)]*\)\??|\s\?|.\?", alternatives), key=len).strip()


def _add(rules: list[Rule], label: str, names: str, tail: str, priority: int, head: str = "") -> None:
    """One rule for each alternative name, gated by the name's longest plain part."""
    for name in re.split(r"\|(?![^(]*\))", names) if names else ():
        rules.append(Rule(label, f"{head}{name}{tail}", _keyword(name), priority))


@cache
def signature_rules() -> tuple[Rule, ...]:
    """All rules: those built from the families, several hundred, and the sentences of ``SIGNATURES``.

    The mark of a version may be a word or joined to the number, and after a
    short name to both: "version 3", "v 3", "v3", "gplv3", "gpl3".
    """
    license_, version = " licen[cs]es?", "(?: version| ver| v)? v?"
    joined = f"(?:(?:{license_})?{version}|v?)"
    rules: list[Rule] = []
    for label, names, short, versions in FAMILIES:
        _add(rules, label, names, license_, 50)
        either = "|".join(dict.fromkeys(re.split(r"\|(?![^(]*\))", f"{names}|{short}")))
        for grant in GRANTS:
            _add(rules, label, either, "", 40, head=f"{grant} under (?:the )?(?:terms of the )?")
        _add(rules, label, "|".join(n for n in short.split("|") if n not in names.split("|")), license_, 50)
        _add(rules, label, "|".join(n for n in short.split("|") if n in BARE), "", 35)
        _add(rules, label, short, "", 85, head="opensource org licenses? ")
        _add(rules, label, short, "", 90, head="spdx license identifier ")
        for v in versions:
            dashed = f"{label}-{v.replace(' ', '.')}"
            number = f"{v}(?: 0)?" if " " not in v else v
            # A version N.0 is also called N, where the text has no other figure after it.
            whole = f"{v[:-2]}(?: 0|(?! [0-9]))" if v.endswith(" 0") and v[:-2] not in versions else number
            _add(rules, dashed, names, f"{license_}{version}{whole}", 70)
            _add(rules, dashed, names, f"{license_} as published by the free software foundation(?: either)? version {number}", 75)
            _add(rules, dashed, short, f"{joined}{number}(?: only| or later)?", 60)
            _add(rules, dashed, short, f"(?: v|v){whole}(?: only| or later)?", 60)
            _add(rules, dashed, short, f"(?:{version}|v?){whole}{license_}", 65)
            _add(rules, dashed, short, f" {number}(?: only| or later)?", 95, head="spdx license identifier ")
            _add(rules, dashed, short, f" {number}(?: only| or later)?", 88, head="opensource org licenses? ")
    for label, short, words in CREATIVE:
        rules.append(Rule(label, f"cc {short}", f"cc {short}", 55))
        rules.append(Rule(label, f"creative commons {words}{license_}", "creative commons", 55))
        rules.append(Rule(label, f"creativecommons org licenses {short}", "creativecommons org", 85))
        for v in CREATIVE_VERSIONS:
            dashed = f"{label}-{v.replace(' ', '.')}"
            rules.append(Rule(dashed, f"cc {short}{version}{v}", f"cc {short}", 75))
            rules.append(Rule(dashed, f"creative commons {words}(?:{license_})?{version}{v}", "creative commons", 75))
            rules.append(Rule(dashed, f"creativecommons org licenses {short} {v}", "creativecommons org", 88))
    rules.append(Rule("cc0", "cc0(?: 1 0)?", "cc0", 55))
    rules.append(Rule("cc0", "creative commons zero", "creative commons zero", 60))
    rules.append(Rule("public-domain", "(?:released |dedicated )?(?:in|into|to) the public domain", "the public domain", 30))
    rules.append(Rule("all-rights-reserved", "all rights reserved", "all rights reserved", 20))
    rules += [Rule(*signature) for signature in SIGNATURES]
    return tuple(rules)


class Scanner:
    def __init__(self, rules: tuple[Rule, ...], base: tuple[tuple[str, str], ...]):
        self.base = [(re.compile(f"(?<= ){re.escape(p)}(?= )".encode()), f" {p} ".encode(), label) for p, label in base]
        self.gated: dict[bytes, list[tuple[re.Pattern, Rule]]] = {}
        for rule in rules:
            compiled = re.compile(f"(?<= )(?:{rule.pattern})(?= )".encode())
            self.gated.setdefault(f" {rule.keyword}".encode(), []).append((compiled, rule))

    def base_hits(self, joined: bytes) -> list[tuple[int, str]]:
        """(first word, label) of every place of a base phrase."""
        here = [(p, label) for p, phrase, label in self.base if phrase in joined]
        blanks = _blanks(joined) if here else None
        return [(_word_at(blanks, m.start()), label) for p, label in here for m in p.finditer(joined)]

    def detections(self, joined: bytes) -> list[tuple[int, int, Rule]]:
        """(first word, word after the last, rule) of all detections that no earlier one contains, by place."""
        here = [rules for keyword, rules in self.gated.items() if keyword in joined]
        blanks = _blanks(joined) if here else None
        found = []
        for rules in here:
            for pattern, rule in rules:
                for m in pattern.finditer(joined):
                    first = _word_at(blanks, m.start())
                    found.append((first, first + m[0].count(b" ") + 1, rule))
        return suppress(found)


def _blanks(joined: bytes) -> np.ndarray:
    return np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)


def _word_at(blanks: np.ndarray, start: int) -> int:
    """Number of the word that begins at byte ``start``; the text begins with a blank."""
    return int(np.searchsorted(blanks, start)) - 1


def suppress(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Drop each detection inside one of higher order: by priority, length, place, label."""
    found = sorted(set(found), key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label, d[2].pattern))
    reach = max((end - first for first, end, _ in found), default=0)
    furthest: dict[int, int] = {}
    kept = []
    for first, end, rule in found:
        if all(furthest.get(at, 0) < end for at in range(first - reach, first + 1)):
            kept.append((first, end, rule))
            furthest[first] = end
    return sorted(kept, key=lambda d: (d[0], d[1], d[2].label))


@cache
def _scanner(rules: tuple[Rule, ...], base: tuple[tuple[str, str], ...]) -> Scanner:
    return Scanner(rules, base)


_DETECTION = pa.struct([("first", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("priority", pa.int32())])
_PLACE = pa.struct([("first", pa.int64()), ("label", pa.string())])
_ROWS = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("base", pa.list_(_PLACE)), ("detections", pa.list_(_DETECTION))]
)
_OUT = (
    "doc_id long, n_words long, base array<struct<first: long, label: string>>, "
    "detections array<struct<first: long, end: long, label: string, priority: int>>"
)


def _scan(rules, base):
    def run(batches):
        scanner = _scanner(rules, base)
        for batch in batches:
            sizes, places, detections = [], [], []
            for text in column(batch, "text"):
                words = byte_words(text)
                joined = b" " + b" ".join(words) + b" "
                sizes.append(len(words))
                places.append([{"first": at, "label": label} for at, label in scanner.base_hits(joined)])
                detections.append(
                    [
                        {"first": first, "end": end, "label": rule.label, "priority": rule.priority}
                        for first, end, rule in scanner.detections(joined)
                    ]
                )
            yield record_batch(_ROWS, batch.column(0), sizes, places, detections)

    return run


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] | None = None,
    base: tuple[tuple[str, str], ...] = BASE,
) -> DataFrame:
    """(doc_id, n_words, base, detections) for every row of ``docs``.

    ``base`` lists every place of a base phrase; ``detections`` what is left of
    the rules' matches after suppression, with word intervals. A NULL or empty
    text has no words and no detection. Rows are judged one by one: repeated
    rows and NULL ids stay; other columns take no part.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")
    )
    return rows.mapInArrow(_scan(signature_rules() if rules is None else rules, base), _OUT)


def license_summary(scanned: DataFrame) -> DataFrame:
    """One line per row: number and range of base places, labels, and the score of the surest detection."""

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    starts = F.transform("base", lambda p: p["first"])
    own = F.transform("base", lambda p: p["label"])
    best = F.coalesce(F.array_max(F.transform("detections", lambda d: d["priority"])), F.lit(0))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(own).alias("base_labels"),
        joined(F.concat(own, F.transform("detections", lambda d: d["label"]))).alias("labels"),
        (best / F.lit(100.0)).alias("score"),
    )
