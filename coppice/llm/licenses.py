"""License notices by ordered signature rules.

Rules are regular expressions over the words of a text (lower-cased A-Z, joined by one
space). Each rule names keywords, of which every form it matches holds one; only rules with
a keyword in the text run. Every match is a detection with the rule's label, priority and weight. Overlaps are settled in
the order of priority, then length, then place: a detection that lies inside an accepted
one is suppressed, so that a full notice hides the license name within it and a longer
name the shorter one.

Most rules come from license names put into forms of notice; the rest are sentences of
license texts. The score is 1 - product(1 - weight) over the detections that stay.

A row depends on its text alone: null and empty texts have no words and the score 0;
repeated rows and ties need no rule. Columns of other names are not read, and an empty
table gives no rows. Long texts take linear time, but for the sorting of detections.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.llm.common import Cover, per_worker, text_or_empty, words_of

# The base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Label, keywords, and names as word patterns. Common names and identifiers of licenses.
NAMES = (
    ("0bsd", "0bsd|zero clause", "0bsd|bsd zero clause license|zero clause bsd"),
    ("afl-3.0", "academic|afl", "academic free license(?: version| v)?(?: 3 0| 3)?|afl 3 0"),
    ("agpl-3.0", "affero", "(?:gnu )?affero general public license(?: version 3| v3)?(?: or later)?"),
    ("agpl-3.0", "agpl", "(?:gnu )?agpl(?: ?v?3)?(?: 0)?(?: only| or later)?"),
    ("apache-1.1", "apache", "apache(?: software)? license(?: version| v)? 1 1|apache 1 1"),
    ("apache-2.0", "apache", "apache(?: software)? license(?: version| v)? ?v?2(?: 0)?|apache 2(?: 0)?"),
    ("artistic-2.0", "artistic", "artistic license(?: version)?(?: 2 0| 2)?"),
    ("bsd-2-clause", "bsd", "(?:simplified|freebsd|2 clause|two clause) bsd license|bsd 2 clause(?: license)?"),
    ("bsd-3-clause", "bsd", "(?:new|modified|revised|3 clause|three clause) bsd license|bsd 3 clause(?: license)?"),
    ("bsd-4-clause", "bsd", "(?:original|4 clause|four clause) bsd license|bsd 4 clause(?: license)?"),
    ("bsd", "bsd", "bsd(?: style)? licen[cs]e"),
    ("bsl-1.0", "boost|bsl", "boost software license(?: version| v)?(?: ?1 0| 1)?|bsl 1 0"),
    ("busl-1.1", "business|busl", "business source license(?: 1 1)?|busl 1 1"),
    ("cc-by-4.0", "creative", "creative commons attribution(?: 4 0)?(?: international)?(?: public)? license"),
    ("cc-by-4.0", "cc", "cc by(?: 4 0)?"),
    ("cc-by-3.0", "cc", "cc by 3 0(?: unported)?"),
    ("cc-by-2.0", "cc", "cc by 2 [05]"),
    ("cc-by-sa", "creative", "creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported)?(?: license)?"),
    ("cc-by-sa", "cc", "cc by sa(?: [1-4] [05])?"),
    ("cc-by-nd", "creative", "creative commons attribution no ?deriv(?:ative|ative work)?s?(?: [1-4] [05])?(?: international)?(?: license)?"),
    ("cc-by-nd", "cc", "cc by nd(?: [1-4] [05])?"),
    ("cc-by-nc", "creative", "creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported)?(?: license)?"),
    ("cc-by-nc", "cc", "cc by nc(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "creative", "creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported)?(?: license)?"),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "creative", "creative commons attribution non ?commercial no ?deriv(?:ative|ative work)?s?(?: [1-4] [05])?(?: international)?(?: license)?"),
    ("cc-by-nc-nd", "cc", "cc by nc nd(?: [1-4] [05])?"),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1.0", "zero", "creative commons zero(?: v?1 0)?(?: universal)?"),
    ("cddl-1.0", "cddl", "cddl(?: 1 [01])?"),
    ("cddl-1.0", "distribution", "common development and distribution license(?: 1 [01])?"),
    ("cecill-2.1", "cecill", "cecill(?: ?[abc])?(?: 2 [01])?(?: license)?"),
    ("epl-1.0", "eclipse", "eclipse public license(?: version| v)? ?v?1(?: 0)?"),
    ("epl-2.0", "eclipse", "eclipse public license(?: version| v)? ?v?2(?: 0)?"),
    ("epl", "epl", "epl(?: [12] 0)?"),
    ("eupl-1.2", "union", "european union public licen[cs]e(?: version| v)?(?: ?1 [012])?"),
    ("eupl-1.2", "eupl", "eupl(?: ?v?1 [012])?"),
    ("gfdl", "documentation", "gnu free documentation license(?: version| v)?(?: ?1 [123])?"),
    ("gpl-2.0", "general", "(?:gnu )?general public license(?: version| v)? ?v?2(?: 0)?(?: only| or later)?"),
    ("gpl-2.0", "gpl", "(?:gnu )?gpl ?v?2(?: 0)?(?: only| or later)?"),
    ("gpl-3.0", "general", "(?:gnu )?general public license(?: version| v)? ?v?3(?: 0)?(?: only| or later)?"),
    ("gpl-3.0", "gpl", "(?:gnu )?gpl ?v?3(?: 0)?(?: only| or later)?"),
    ("gpl", "general", "gnu general public license"),
    ("gpl", "gpl", "gnu gpl"),
    ("isc", "isc", "isc license"),
    ("lgpl-2.1", "lesser", "(?:gnu )?lesser general public license(?: version| v)? ?v?2 1(?: only| or later)?"),
    ("lgpl-2.0", "library", "(?:gnu )?library general public license(?: version| v)?(?: ?v?2(?: 0)?)?"),
    ("lgpl-3.0", "lesser", "(?:gnu )?lesser general public license(?: version| v)? ?v?3(?: 0)?(?: only| or later)?"),
    ("lgpl", "lesser", "(?:gnu )?lesser general public license"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl(?: ?v?[23](?: [01])?)?(?: only| or later)?"),
    ("mit", "mit|expat", "mit licen[cs]e|expat license"),
    ("mit-0", "mit", "mit no attribution(?: license)?|mit 0"),
    ("mpl-1.1", "mozilla", "mozilla public license(?: version| v)? ?v?1 1"),
    ("mpl-2.0", "mozilla", "mozilla public license(?: version| v)?(?: ?v?2(?: 0)?)?"),
    ("mpl-2.0", "mpl", "mpl ?v?2(?: 0)?"),
    ("ms-pl", "microsoft|ms pl", "microsoft public license|ms pl"),
    ("ms-rl", "microsoft|ms rl", "microsoft reciprocal license|ms rl"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa open source license"),
    ("odbl-1.0", "database", "open (?:data commons open )?database license(?: v?1 0)?"),
    ("ofl-1.1", "font", "(?:sil )?open font license(?: version| v)?(?: 1 1)?"),
    ("osl-3.0", "osl", "osl 3 0"),
    ("osl-3.0", "open", "open software license(?: version| v)?(?: 3 0)?"),
    ("php-3.01", "php", "php license(?: version)?(?: 3 01?)?"),
    ("postgresql", "postgresql", "postgresql license"),
    ("psf-2.0", "python", "python software foundation license(?: version 2)?"),
    ("public-domain", "domain", "public domain dedication"),
    ("ruby", "ruby", "ruby license"),
    ("sspl-1.0", "side", "server side public license(?: version| v)?(?: 1)?"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("upl-1.0", "permissive", "universal permissive license(?: version| v)?(?: 1 0)?"),
    ("vim", "vim", "vim license"),
    ("w3c", "w3c", "w3c software (?:notice and )?license"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("x11", "x11", "x11 license"),
    ("zlib", "zlib", "zlib(?: libpng)? license"),
    ("zpl-2.1", "zope", "zope public license(?: version| v)?(?: 2 1)?"),
)

# How a notice names its license; priority and weight.
FORMS = (
    (90, 0.99, r"spdx license identifier (?:{name})"),
    (80, 0.95, r"(?:dual |also |re)?licen[cs]ed (?:to you )?under (?:the terms of )?(?:the |an? )?(?:{name})"),
    (
        80,
        0.95,
        r"(?:released|distributed|available|published|provided|covered|shared|offered|made available) (?:as is )?"
        r"(?:under|by) (?:the terms (?:and conditions )?of )?(?:the |an? )?(?:{name})",
    ),
    (70, 0.9, r"(?:subject to|governed by|under the terms of|see|read) (?:the )?(?:{name})"),
    (50, 0.8, r"(?:{name})"),
)

# Sentences of license texts; label, keywords, pattern, priority, weight.
SENTENCES = (
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy", 85, 0.95),
    ("mit", "sublicense", "to use copy modify merge publish distribute sublicense and or sell copies", 85, 0.9),
    ("isc", "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 86, 0.95),
    ("0bsd", "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided", 87, 0.9),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted", 84, 0.95),
    ("bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software", 84, 0.9),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display", 84, 0.9),
    ("apache-2.0", "warranties", "without warranties or conditions of any kind either express or implied", 84, 0.9),
    ("apache-2.0", "apache", "you may obtain a copy of the license at https? www apache org licenses license 2 0", 88, 0.99),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license", 85, 0.95),
    ("lgpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu lesser general public license", 86, 0.95),
    ("agpl-3.0", "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public license", 86, 0.95),
    ("gpl", "copyleft", "(?:gnu )?general public license is a free copyleft license", 84, 0.95),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license(?: v 2 0)?", 88, 0.99),
    ("epl", "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public license", 86, 0.95),
    ("bsl-1.0", "boost", "distributed under the boost software license version 1 0", 88, 0.99),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", 88, 0.99),
    ("wtfpl", "fuck", "do what the fuck you want to", 85, 0.95),
    ("zlib", "altered", "altered source versions must be plainly marked as such", 84, 0.9),
    ("cc0-1.0", "waived", "has waived all copyright and related or neighboring rights", 84, 0.9),
    ("public-domain", "domain", "(?:released|placed|dedicated|is) (?:in|into|to) the public domain", 70, 0.8),
    ("ofl-1.1", "font", "this font software is licensed under the sil open font license", 88, 0.99),
    ("artistic-2.0", "artistic|perl", "under the same terms as perl itself|under the artistic license", 80, 0.9),
    ("beerware", "beer", "beer ?ware license|buy me a beer in return", 80, 0.9),
    ("json", "evil", "the software shall be used for good not evil", 85, 0.95),
    ("proprietary", "proprietary", "proprietary and confidential|proprietary license|licensed proprietary", 60, 0.7),
    ("proprietary", "reserved", "all rights reserved", 40, 0.4),
    ("unknown", "licensed", "licensed under", 10, 0.3),
    ("unknown", "license", "(?:see|read) (?:the )?license(?: file| txt| md)?", 10, 0.3),
    ("unknown", "terms", "under the terms of (?:the|this) license", 10, 0.3),
)


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    priority: int
    weight: float
    pattern: re.Pattern


@dataclass(frozen=True)
class Detection:
    start: int  # word numbers, end exclusive
    end: int
    label: str
    priority: int
    weight: float


def rules() -> dict[bytes, list[Rule]]:
    """All rules by their keywords; a rule with several stands under each."""
    listed = [(label, keys, form.format(name=name), priority, weight) for label, keys, name in NAMES for priority, weight, form in FORMS]
    by_key: dict[bytes, list[Rule]] = {}
    for number, (label, keys, pattern, priority, weight) in enumerate([*listed, *SENTENCES]):
        compiled = re.compile(rf"(?<= )(?:{pattern})(?= )".encode())
        for key in keys.split("|"):
            by_key.setdefault(key.encode(), []).append(Rule(number, label, priority, weight, compiled))
    return by_key


def _spaces(line: bytes) -> np.ndarray:
    """Places of the spaces, so that the number before a place is a search in them."""
    return np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)


def base_places(words: list[bytes], line: bytes) -> list[tuple[int, str]]:
    """Word numbers where the words of a base phrase stand consecutively."""
    found = []
    for phrase, label in BASE:
        needle = f" {phrase} ".encode()
        at = line.find(needle)
        while at >= 0:
            found.append((at, label))
            at = line.find(needle, at + 1)
    if not found:
        return []
    places, labels = zip(*found)
    return sorted(zip(np.searchsorted(_spaces(line), places).tolist(), labels))


def detect(line: bytes, by_key: dict[bytes, list[Rule]]) -> list[Detection]:
    """Detections that stay, by place; ``line`` is the words, each between spaces."""
    found = []
    ran = set()
    for key, group in by_key.items():
        if key in line:
            for rule in group:
                if rule.number in ran:
                    continue
                ran.add(rule.number)
                for m in rule.pattern.finditer(line):
                    found.append((-rule.priority, m.start() - m.end(), m.start(), rule.number, m.end(), rule))
    if not found:
        return []
    cover, kept = Cover(), []
    for _, _, start, _, end, rule in sorted(found, key=lambda f: f[:4]):
        if not cover.contains(start, end):
            cover.add(start, end)
            kept.append((start, end, rule))
    kept.sort(key=lambda k: k[:2])
    spaces = _spaces(line)
    firsts, lasts = (np.searchsorted(spaces, [k[side] for k in kept]).tolist() for side in (0, 1))
    return [Detection(s - 1, e, rule.label, rule.priority, rule.weight) for s, e, (_, _, rule) in zip(firsts, lasts, kept)]


def scan_column(text_col: str = "text"):
    """A struct column: word count, base places and labels, all labels, score and detections."""
    fields = (
        "n_words: bigint, n_base: bigint, first_word: bigint, last_word: bigint, base_labels: string, labels: string,"
        " score: double, detections: array<struct<start: bigint, end: bigint, label: string>>"
    )

    @F.arrow_udf(f"struct<{fields}>")
    def scan(texts: pa.Array) -> pa.Array:
        by_key = per_worker("license rules", rules)
        out = []
        for text in texts.to_pylist():
            words = words_of(text)
            line = b" " + b" ".join(words) + b" "
            places = base_places(words, line)
            kept = detect(line, by_key)
            miss = 1.0
            for found in kept:
                miss *= 1 - found.weight
            labels = {label for _, label in places}
            out.append(
                {
                    "n_words": len(words),
                    "n_base": len(places),
                    "first_word": places[0][0] if places else None,
                    "last_word": places[-1][0] if places else None,
                    "base_labels": ",".join(sorted(labels)),
                    "labels": ",".join(sorted(labels | {found.label for found in kept})),
                    "score": 1 - miss,
                    "detections": [{"start": d.start, "end": d.end, "label": d.label} for d in kept],
                }
            )
        return pa.array(out, _kind())

    return scan(text_or_empty(text_col))


def _kind() -> pa.DataType:
    long, text = pa.int64(), pa.string()
    detection = pa.struct([("start", long), ("end", long), ("label", text)])
    longs = [(name, long) for name in ("n_words", "n_base", "first_word", "last_word")]
    return pa.struct([*longs, ("base_labels", text), ("labels", text), ("score", pa.float64()), ("detections", pa.list_(detection))])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and what ``scan_column`` finds, for every row."""
    found = docs.select(id_col, scan_column(text_col).alias("found"))
    return found.select(id_col, "found.*")
