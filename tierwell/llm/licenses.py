"""License scans: ordered signature rules over the words of a text.

A text becomes its words, lower-cased and joined by single spaces; a rule is a regular expression
over that, with a keyword that has to occur before the expression is tried, a label and a priority.
A detection that lies within one of higher priority, or within a longer one of equal priority, is
suppressed.  The phrases of the base are rules as well; what they detect is never suppressed."""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tierwell.llm.common import text_slices


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: bytes
    pattern: str
    priority: int
    weight: float
    base: bool = False


#: The phrases and labels of the base.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Families: label, names as patterns over words, the identifier's words, a keyword of all of them.
FAMILIES = (
    ("mit", r"(?:the )?(?:mit|expat|x11)", r"mit", "mit|expat|x11"),
    ("mit-0", r"(?:the )?mit (?:no attribution|0)", r"mit 0", "mit"),
    ("apache-1.1", r"(?:the )?apache(?: software)?(?: license)?(?: version)? v?1 1", r"apache 1 1", "apache"),
    ("apache-2.0", r"(?:the )?apache(?: software)?(?: license)?(?: version)? v?2(?: 0)?", r"apache 2 0", "apache"),
    ("bsd-2-clause", r"(?:the )?(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", r"bsd 2 clause", "bsd"),
    ("bsd-3-clause", r"(?:the )?(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)", r"bsd 3 clause", "bsd"),
    ("bsd-4-clause", r"(?:the )?(?:bsd 4 clause|4 clause bsd|original bsd|old bsd)", r"bsd 4 clause", "bsd"),
    ("bsd-0-clause", r"(?:the )?(?:0bsd|zero clause bsd|bsd zero clause)", r"0bsd", "bsd"),
    ("isc", r"(?:the )?(?:isc|internet systems consortium)", r"isc", "isc|internet systems"),
    ("zlib", r"(?:the )?zlib(?: libpng)?", r"zlib", "zlib"),
    ("gpl-1.0", r"(?:the )?(?:gnu )?(?:general public license|gpl)(?: version)? v?1(?: 0)?", r"gpl 1 0(?: only| or later)?", "gpl|general public"),
    ("gpl-2.0", r"(?:the )?(?:gnu )?(?:general public license|gpl)(?: version)? v?2(?: 0)?", r"gpl 2 0(?: only| or later)?", "gpl|general public"),
    ("gpl-3.0", r"(?:the )?(?:gnu )?(?:general public license|gpl)(?: version)? v?3(?: 0)?", r"gpl 3 0(?: only| or later)?", "gpl|general public"),
    ("lgpl-2.0", r"(?:the )?(?:gnu )?(?:(?:lesser|library) general public license|lgpl)(?: version)? v?2 0", r"lgpl 2 0(?: only| or later)?", "lgpl|general public"),
    ("lgpl-2.1", r"(?:the )?(?:gnu )?(?:(?:lesser|library) general public license|lgpl)(?: version)? v?2 1", r"lgpl 2 1(?: only| or later)?", "lgpl|general public"),
    ("lgpl-3.0", r"(?:the )?(?:gnu )?(?:lesser general public license|lgpl)(?: version)? v?3(?: 0)?", r"lgpl 3 0(?: only| or later)?", "lgpl|general public"),
    ("agpl-3.0", r"(?:the )?(?:gnu )?(?:affero general public license|agpl)(?: version)? v?3(?: 0)?", r"agpl 3 0(?: only| or later)?", "agpl|affero"),
    ("gfdl-1.1", r"(?:the )?(?:gnu )?(?:free documentation license|gfdl|fdl)(?: version)? v?1 1", r"gfdl 1 1(?: only| or later)?", "documentation|fdl"),
    ("gfdl-1.2", r"(?:the )?(?:gnu )?(?:free documentation license|gfdl|fdl)(?: version)? v?1 2", r"gfdl 1 2(?: only| or later)?", "documentation|fdl"),
    ("gfdl-1.3", r"(?:the )?(?:gnu )?(?:free documentation license|gfdl|fdl)(?: version)? v?1 3", r"gfdl 1 3(?: only| or later)?", "documentation|fdl"),
    ("mpl-1.1", r"(?:the )?(?:mozilla public license|mpl)(?: version)? v?1 1", r"mpl 1 1", "mozilla|mpl"),
    ("mpl-2.0", r"(?:the )?(?:mozilla public license|mpl)(?: version)? v?2(?: 0)?", r"mpl 2 0", "mozilla|mpl"),
    ("epl-1.0", r"(?:the )?(?:eclipse public license|epl)(?: version)? v?1(?: 0)?", r"epl 1 0", "eclipse|epl"),
    ("epl-2.0", r"(?:the )?(?:eclipse public license|epl)(?: version)? v?2(?: 0)?", r"epl 2 0", "eclipse|epl"),
    ("cddl", r"(?:the )?(?:common development and distribution license|cddl)", r"cddl", "cddl|common development"),
    ("cddl-1.0", r"(?:the )?(?:common development and distribution license|cddl)(?: version)? v?1 0", r"cddl 1 0", "cddl|common development"),
    ("cddl-1.1", r"(?:the )?(?:common development and distribution license|cddl)(?: version)? v?1 1", r"cddl 1 1", "cddl|common development"),
    ("cpl-1.0", r"(?:the )?(?:common public license|cpl)(?: version)? v?1(?: 0)?", r"cpl 1 0", "common public|cpl"),
    ("eupl-1.1", r"(?:the )?(?:european union public licen[cs]e|eupl)(?: version)? v?1 1", r"eupl 1 1", "european union|eupl"),
    ("eupl-1.2", r"(?:the )?(?:european union public licen[cs]e|eupl)(?: version)? v?1 2", r"eupl 1 2", "european union|eupl"),
    ("artistic-2.0", r"(?:the )?artistic(?: license)?(?: version)? v?2(?: 0)?", r"artistic 2 0", "artistic"),
    ("artistic-1.0", r"(?:the )?artistic(?: license)?(?: version)? v?1(?: 0)?", r"artistic 1 0", "artistic"),
    ("bsl-1.0", r"(?:the )?boost software license(?: version)?(?: v?1 0)?", r"bsl 1 0", "boost|bsl"),
    ("busl-1.1", r"(?:the )?(?:business source license|busl|bsl)(?: version)? v?1 1", r"busl 1 1", "business source|bsl|busl"),
    ("sspl-1.0", r"(?:the )?(?:server side public license|sspl)", r"sspl 1 0", "server side|sspl"),
    ("elastic-2.0", r"(?:the )?elastic license(?: version)?(?: v?2(?: 0)?)?", r"elastic 2 0", "elastic"),
    ("unlicense", r"(?:the )?unlicense", r"unlicense", "unlicense"),
    ("wtfpl", r"(?:the )?wtfpl", r"wtfpl", "wtfpl"),
    ("cc0-1.0", r"(?:the )?(?:creative commons zero|cc0|cc zero)(?: 1 0)?(?: universal)?", r"cc0 1 0", "creative commons|cc0|cc zero"),
    ("cc-by-3.0", r"(?:the )?(?:creative commons attribution|cc by)(?: license)? 3 0", r"cc by 3 0", "creative commons|cc by"),
    ("cc-by-4.0", r"(?:the )?(?:creative commons attribution|cc by)(?: license)? 4 0", r"cc by 4 0", "creative commons|cc by"),
    ("cc-by-sa-3.0", r"(?:the )?(?:creative commons attribution share ?alike|cc by sa)(?: license)? 3 0", r"cc by sa 3 0", "creative commons|cc by"),
    ("cc-by-sa-4.0", r"(?:the )?(?:creative commons attribution share ?alike|cc by sa)(?: license)? 4 0", r"cc by sa 4 0", "creative commons|cc by"),
    ("cc-by-nd-4.0", r"(?:the )?(?:creative commons attribution no ?deriv(?:ative)?s?|cc by nd)(?: license)? 4 0", r"cc by nd 4 0", "creative commons|cc by"),
    ("cc-by-nc-4.0", r"(?:the )?(?:creative commons attribution non ?commercial|cc by nc)(?: license)? 4 0", r"cc by nc 4 0", "creative commons|cc by"),
    ("cc-by-nc-sa-4.0", r"(?:the )?(?:creative commons attribution non ?commercial share ?alike|cc by nc sa)(?: license)? 4 0", r"cc by nc sa 4 0", "creative commons|cc by"),
    ("cc-by-nc-nd-4.0", r"(?:the )?(?:creative commons attribution non ?commercial no ?deriv(?:ative)?s?|cc by nc nd)(?: license)? 4 0", r"cc by nc nd 4 0", "creative commons|cc by"),
    ("odbl-1.0", r"(?:the )?(?:open (?:data commons open )?database license|odbl)", r"odbl 1 0", "database license|odbl"),
    ("pddl-1.0", r"(?:the )?(?:public domain dedication and license|pddl)", r"pddl 1 0", "dedication|pddl"),
    ("psf-2.0", r"(?:the )?(?:python software foundation|psf)(?: license)?", r"(?:psf|python) 2 0", "python|psf"),
    ("ofl-1.1", r"(?:the )?(?:sil )?(?:open font license|ofl)(?: version)? v?1 1", r"ofl 1 1", "font|ofl"),
    ("postgresql", r"(?:the )?postgresql", r"postgresql", "postgresql"),
    ("ncsa", r"(?:the )?university of illinois(?: ncsa)?(?: open source)?", r"ncsa", "illinois|ncsa"),
    ("ms-pl", r"(?:the )?microsoft public", r"ms pl", "microsoft|ms pl"),
    ("ms-rl", r"(?:the )?microsoft reciprocal", r"ms rl", "microsoft|ms rl"),
)

#: The ways a family is mentioned: pattern around its name or identifier, priority, weight.
FORMS = (
    (r"spdx license identifier {id}", "id", 90, 1.0),
    (r"(?:(?:is|are) )?(?:dual )?(?:re)?licensed under (?:the terms of )?{name}(?: licen[cs]es?)?", "name", 80, 0.95),
    (r"(?:released|distributed|available|published|provided|redistribut\w+) under (?:the terms of )?{name}(?: licen[cs]es?)?", "name", 75, 0.9),
    (r"(?:under|subject to) the (?:terms|conditions|terms and conditions) of {name}(?: licen[cs]es?)?", "name", 70, 0.85),
    (r"licen[cs]e {id}", "id", 60, 0.7),
    (r"{name} licen[cs]es?", "name", 50, 0.6),
)

#: Sentences of the licenses themselves and notices that name no family of the table.
TEXTS = (
    ("mit", "permission is hereby", r"permission is hereby granted free of charge to any person obtaining a copy", 95, 1.0),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose", 95, 1.0),
    ("apache-2.0", "apache", r"apache license(?: version)? v?2 0(?: january 2004)?", 65, 0.95),
    ("apache-2.0", "unless required", r"unless required by applicable law or agreed to in writing software distributed under the license", 95, 1.0),
    ("gpl-2.0", "general public", r"free software foundation either version 2 of the license", 95, 1.0),
    ("gpl-3.0", "general public", r"free software foundation either version 3 of the license", 95, 1.0),
    ("gpl-3.0", "general public", r"gnu general public license(?: version)? v?3(?: 0)?(?: 29 june 2007)?", 65, 0.95),
    ("gpl-2.0", "general public", r"gnu general public license(?: version)? v?2(?: 0)?(?: june 1991)?", 65, 0.95),
    ("lgpl", "lesser general", r"(?:gnu )?lesser general public license", 40, 0.6),
    ("agpl", "affero general", r"(?:gnu )?affero general public license", 40, 0.6),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted", 95, 1.0),
    ("bsd-3-clause", "neither the name", r"neither the name of .{1,120}? nor the names of its contributors may be used to endorse", 95, 1.0),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", 95, 1.0),
    ("public-domain", "public domain", r"(?:released|placed|dedicated)? ?(?:in|into|to) the public domain", 45, 0.6),
    ("boost", "boost", r"boost software license version 1 0 august 17th 2003", 95, 1.0),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0", 95, 1.0),
    ("zlib", "as is", r"this software is provided as is without any express or implied warranty in no event will the authors", 90, 0.9),
    ("cc", "creative commons", r"licensed under a creative commons", 30, 0.5),
    ("proprietary", "all rights reserved", r"all rights reserved", 20, 0.4),
    ("proprietary", "confidential", r"(?:proprietary and confidential|confidential and proprietary)", 35, 0.6),
)


def rules() -> tuple[Rule, ...]:
    """Base phrases, license texts, and every form of every family, in order of priority."""
    base = [Rule(label, b"license", phrase, 10, 0.8, True) for phrase, label in BASE]
    texts = [Rule(label, key.encode(), pattern, priority, weight) for label, key, pattern, priority, weight in TEXTS]
    forms = [
        Rule(label, key.encode(), form.format(name=f"(?:{name})", id=f"(?:{ident})"), priority, weight)
        for label, name, ident, keys in FAMILIES
        for form, _, priority, weight in FORMS
        for key in keys.split("|")
    ]
    return tuple(sorted(base + texts + forms, key=lambda r: -r.priority))


_WORD = bytes.maketrans(bytes(range(0x80)), bytes(c if chr(c).isalnum() else 32 for c in bytes(range(0x80)).lower()))
#: No rule matches a text that holds none of these.
GATES = (b"licen", b"spdx", b" under ", b"subject to the", b"permission", b"redistribution", b"public domain", b"free software", b"all rights reserved", b"confidential", b"neither the name", b"as is", b"unless required", b"source code form")


@dataclass(frozen=True)
class Scan:
    n_words: int
    base: tuple[tuple[int, str], ...]  # (first word, label) of every base place
    kept: tuple[tuple[int, int, str, int, float], ...]  # (first word, end word, label, priority, weight)


def uncontained(found: Sequence[tuple[int, int, str, int, float]]) -> list[tuple[int, int, str, int, float]]:
    """The (start, end, label, priority, weight) that lie in none of higher priority and in no longer one of
    their own; of equal spans the one of higher priority, then the first by alphabet.

    Whatever lies in a suppressed one lies in what suppresses it, so it is enough to know the furthest end
    of all that start no later: a sort and a look-up for each priority."""
    kept: list[tuple[int, int, str, int, float]] = []
    starts: list[int] = []
    reach: list[int] = []
    for _, own in itertools.groupby(sorted(found, key=lambda x: (-x[3], x[0], -x[1], x[2])), key=lambda x: x[3]):
        end = -1
        added = []
        for one in own:
            before = bisect.bisect_right(starts, one[0])
            if one[1] > end and (not before or reach[before - 1] < one[1]):
                added.append(one)
            end = max(end, one[1])
        if added:
            kept += added
            spans = sorted((a, b) for a, b, *_ in kept)
            starts, reach = [a for a, _ in spans], list(itertools.accumulate((b for _, b in spans), max))
    return kept


class Scanner:
    """Each distinct pattern is tried once, where one of its keywords occurs."""

    def __init__(self, found: Sequence[Rule] | None = None):
        keys: dict[Rule, list[bytes]] = {}
        for rule in found or rules():
            keys.setdefault(replace(rule, keyword=b""), []).append(rule.keyword)
        self.rules = [(r, re.compile(rb"(?= " + r.pattern.encode() + rb" )" if r.base else rb" " + r.pattern.encode() + rb"(?= )")) for r in keys]
        self.by_key: dict[bytes, list[int]] = {}
        for i, own in enumerate(keys.values()):
            for key in own:
                self.by_key.setdefault(key, []).append(i)

    def scan(self, text: str) -> Scan:
        line = b" " + b" ".join(text.encode("utf-8", "surrogatepass").translate(_WORD).split()) + b" "
        n_words = line.count(b" ") - 1 if len(line) > 2 else 0
        if not any(g in line for g in GATES):
            return Scan(n_words, (), ())
        tried = sorted({i for key, own in self.by_key.items() if key in line for i in own})
        base: list[tuple[int, str]] = []
        found: dict[tuple[int, int, str], tuple[int, float]] = {}
        for i in tried:
            rule, pattern = self.rules[i]
            for m in pattern.finditer(line):
                if rule.base:
                    base.append((m.start(), rule.label))
                else:
                    span = (m.start(), m.end(), rule.label)
                    found[span] = max(found.get(span, (0, 0.0)), (rule.priority, rule.weight))
        if not base and not found:
            return Scan(n_words, (), ())
        blanks = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32)

        def words(places: Sequence[int]) -> list[int]:
            return np.searchsorted(blanks, np.asarray(places, dtype=np.int64)).tolist()

        kept = sorted(uncontained([(*span, *value) for span, value in found.items()]))
        first, end = words([k[0] for k in kept]), words([k[1] for k in kept])
        bases = sorted(zip(words([a for a, _ in base]), (label for _, label in base), strict=True))
        return Scan(n_words, tuple(bases), tuple((a, b, *k[2:]) for a, b, k in zip(first, end, kept, strict=True)))


_SCANNERS: list[Scanner] = []
_DETECTION = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string()), ("priority", pa.int32())]))


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if not _SCANNERS:
        _SCANNERS.append(Scanner())
    for batch in batches:
        for start, texts in text_slices(batch.column("text")):
            scans = [_SCANNERS[0].scan(t) for t in texts]
            first = [min((w for w, _ in s.base), default=None) for s in scans]
            last = [max((w for w, _ in s.base), default=None) for s in scans]
            own = [sorted({label for _, label in s.base}) for s in scans]
            every = [sorted({*o, *(k[2] for k in s.kept)}) for o, s in zip(own, scans, strict=True)]
            score = [max([0.8] * bool(s.base) + [k[4] for k in s.kept], default=0.0) for s in scans]
            hits = [[dict(first_word=k[0], end_word=k[1], label=k[2], priority=k[3]) for k in s.kept] for s in scans]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(start, len(texts)),
                    pa.array([s.n_words for s in scans], pa.int64()),
                    pa.array([len(s.base) for s in scans], pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(last, pa.int64()),
                    pa.array([",".join(o) for o in own], pa.string()),
                    pa.array([",".join(e) for e in every], pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(hits, _DETECTION),
                ],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"],
            )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """What the rules find in every row of ``docs`` (doc_id, text): n_words, n_base, first_word,
    last_word, base_labels, labels, score and the detections that were not suppressed.

    A null text is empty; texts without a detection have empty label lists, score 0 and null places.
    Overlapping base places count each.  Of equal spans the label of higher priority, then the first
    by alphabet, stays.  Texts are scanned whole, in time that grows with their length and detections.
    Repeated rows each get their row; further columns are not looked at."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _scan_batches,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "detections array<struct<first_word:long,end_word:long,label:string,priority:int>>",
    )
