"""License scan by ordered signature rules.

A text is reduced to its words (A-Z lower-cased; letters, digits and anything
beyond ASCII), joined by single spaces, and each rule is a regular expression
over that.  Rules are gated twice: a text is only looked at if one of a few
byte strings occurs in it, and a rule only runs if its keyword does.  All hits
become intervals of words with a priority; an interval that lies within one of
higher priority, or within an equal or longer one that comes earlier in the
order of the rules, is suppressed.  Hits of the base rules are always kept.

The rules are made from licence families and sentence forms: every family has
names, versions, tags and titles of its own, and each form turns those into
regular expressions.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import ALNUM, blank_text, slices, tidy, utf8

# Phrases and labels of the base detections.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@dataclass(frozen=True)
class Family:
    label: str
    #: alternatives of the name, as regular expressions over words
    names: str
    #: alternatives of the versions; empty for none
    versions: str = ""
    #: alternatives of the tag in SPDX lines, words apart by spaces
    tags: str = ""
    #: a sentence that only this licence's text has
    notice: str = ""


# Licence families, their names, versions, tags and tell-tale sentences.
FAMILIES = [
    Family("mit", "mit|x11|expat", "", "mit|x11", "permission is hereby granted free of charge to any person obtaining a copy"),
    Family("apache", "apache|apache software foundation|asl", "1 0|1 1|2 0|2", "apache 1 0|apache 1 1|apache 2 0",
           "you may not use this file except in compliance with the license"),
    Family("gpl", "gnu general public|gnu gpl|gpl|gplv2|gplv3", "1|2|3|2 0|3 0", "gpl 1 0|gpl 2 0|gpl 3 0",
           "this program is free software you can redistribute it and or modify it"),
    Family("lgpl", "gnu lesser general public|gnu library general public|lesser general public|gnu lgpl|lgpl", "2|2 0|2 1|3|3 0",
           "lgpl 2 0|lgpl 2 1|lgpl 3 0", "this library is free software you can redistribute it and or modify it"),
    Family("agpl", "gnu affero general public|affero general public|gnu agpl|agpl", "1|3|3 0", "agpl 1 0|agpl 3 0",
           "interacting with it remotely through a computer network"),
    Family("bsd", "bsd|new bsd|simplified bsd|revised bsd|modified bsd|berkeley software distribution", "2 clause|3 clause|4 clause",
           "bsd 2 clause|bsd 3 clause|bsd 4 clause|0bsd", "redistributions of source code must retain the above copyright notice"),
    Family("mpl", "mozilla public|mpl", "1 0|1 1|2 0", "mpl 1 0|mpl 1 1|mpl 2 0", "this source code form is subject to the terms of the mozilla public license"),
    Family("epl", "eclipse public|epl", "1 0|2 0", "epl 1 0|epl 2 0", "the accompanying program is provided under the terms of this eclipse public license"),
    Family("cddl", "common development and distribution|cddl", "1 0|1 1", "cddl 1 0|cddl 1 1", "the contents of this file are subject to the terms of the common development"),
    Family("cpl", "common public|cpl", "1 0", "cpl 1 0", "the accompanying program is provided under the terms of this common public license"),
    Family("isc", "isc|internet systems consortium", "", "isc", "permission to use copy modify and or distribute this software for any purpose"),
    Family("zlib", "zlib|zlib libpng|libpng", "", "zlib|libpng", "altered source versions must be plainly marked as such"),
    Family("boost", "boost software|boost|bsl", "1 0", "bsl 1 0", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    Family("unlicense", "unlicense|the unlicense", "", "unlicense", "this is free and unencumbered software released into the public domain"),
    Family("artistic", "artistic|perl artistic", "1 0|2 0", "artistic 1 0|artistic 2 0", "the intent of this document is to state the conditions under which a package may be copied"),
    Family("psf", "python software foundation|psf|python", "2|2 0", "psf 2 0|python 2 0", "this license agreement is between the python software foundation"),
    Family("ofl", "sil open font|open font|ofl", "1 0|1 1", "ofl 1 0|ofl 1 1", "the font software may be modified altered or added to"),
    Family("eupl", "european union public|eupl", "1 0|1 1|1 2", "eupl 1 0|eupl 1 1|eupl 1 2", "licensed under the eupl"),
    Family("wtfpl", "wtfpl|do what the fuck you want to public", "2", "wtfpl", "you just do what the fuck you want to"),
    Family("postgresql", "postgresql", "", "postgresql", "in no event shall the university of california be liable to any party"),
    Family("openssl", "openssl|ssleay", "", "openssl", "this product includes software developed by the openssl project"),
    Family("php", "php", "3 0|3 01", "php 3 0|php 3 01", "this product includes php software"),
    Family("ruby", "ruby", "", "ruby", "you may make and give away verbatim copies of the source form"),
    Family("cc0", "cc0|creative commons zero", "1 0", "cc0 1 0", "to the extent possible under law"),
    Family("cc-by", "creative commons attribution|cc by", "1 0|2 0|2 5|3 0|4 0", "cc by 3 0|cc by 4 0", "this work is licensed under a creative commons attribution"),
    Family("cc-by-sa", "creative commons attribution share ?alike|cc by sa", "2 0|2 5|3 0|4 0", "cc by sa 3 0|cc by sa 4 0",
           "this work is licensed under a creative commons attribution share ?alike"),
    Family("cc-by-nc", "creative commons attribution non ?commercial|cc by nc", "2 0|3 0|4 0", "cc by nc 3 0|cc by nc 4 0",
           "this work is licensed under a creative commons attribution non ?commercial"),
    Family("cc-by-nd", "creative commons attribution no ?deriv(?:ative)?s|cc by nd", "2 0|3 0|4 0", "cc by nd 3 0|cc by nd 4 0",
           "this work is licensed under a creative commons attribution no ?deriv"),
    Family("odbl", "open database|odbl", "1 0", "odbl 1 0", "this database is made available under the open database license"),
    Family("upl", "universal permissive|upl", "1 0", "upl 1 0", "the universal permissive license"),
    Family("ncsa", "university of illinois ncsa open source|ncsa", "", "ncsa", "developed by .{1,60} university of illinois"),
    Family("elastic", "elastic|server side public|sspl", "1 0|2 0", "sspl 1 0|elastic 2 0", "provide the software to third parties as a hosted or managed service"),
]

# Sentence forms as (name, priority, keyword, expression); {n}, {v}, {t} and {s}
# stand for a family's names, versions, tags and sentence.
FORMS = [
    ("tag", 95, "spdx", "spdx license identifier (?:{t})(?: only| or later)?"),
    ("notice", 90, "", "{s}"),
    ("under-version", 85, "licen", "(?:licensed|released|distributed|available|provided) under (?:the )?(?:terms of )?(?:the )?(?:{n}) "
     "(?:licen[sc]e )?(?:v|version )?(?:{v})(?: or later)?"),
    ("version", 80, "licen", "(?:{n}) licen[sc]e (?:v|version )?(?:{v})(?: or(?: any)? later(?: version)?)?"),
    ("under", 75, "licen", "(?:licensed|released|distributed|available|provided) under (?:the )?(?:terms of )?(?:the )?(?:{n})(?: licen[sc]e)?"),
    ("field", 70, "licen", "licen[sc]e (?:is |type |name )?(?:the )?(?:{n})(?: licen[sc]e)?"),
    ("terms", 65, "licen", "(?:terms|copy|text|conditions) of the (?:{n}) licen[sc]e"),
    ("subject", 60, "licen", "(?:subject to|governed by|covered by|in accordance with) the (?:{n}) licen[sc]e"),
    ("name", 50, "licen", "(?:{n}) licen[sc]e"),
]


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    priority: int
    keyword: str
    pattern: re.Pattern
    base: bool = False


def _compiled(expression: str) -> re.Pattern:
    return re.compile(f"(?<![^ ])(?:{expression})(?![^ ])")


def make_rules(families: list[Family] = FAMILIES) -> list[Rule]:
    """Base rules first, then all forms of all families by priority and family."""
    rules = [Rule(f"base-{label}", label, 100, "license", _compiled(phrase), True) for phrase, label in BASE.items()]
    made = []
    for f in families:
        for name, priority, keyword, form in FORMS:
            parts = {"n": f.names, "v": f.versions, "t": f.tags, "s": f.notice}
            if any("{" + k + "}" in form and not v for k, v in parts.items()):
                continue
            expression = form.format(**parts)
            # of a sentence, its longest plain word gates
            gate = keyword or max(re.findall(r"[a-z]+", f.notice.split(".{")[0].split(" ?")[0]), key=len)
            made.append(Rule(f"{f.label}-{name}", f.label, priority, gate, _compiled(expression)))
    return rules + sorted(made, key=lambda r: -r.priority)


RULES = make_rules()
#: A text without any of these (in lower case) has no rule's keyword.
ROOTS = sorted(k for k in {r.keyword for r in RULES} if not any(r.keyword in k and r.keyword != k for r in RULES))


@dataclass(frozen=True)
class Hit:
    first: int  # word
    end: int
    rule: int  # place in the order of the rules


def normal(text: str) -> list[str]:
    return _WORD.findall(text.translate(_LOWER))


_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


class Furthest:
    """The furthest end among the intervals so far that begin at or before a place (a Fenwick tree)."""

    def __init__(self, begins: list[int]):
        self.places = sorted(set(begins))
        self.most = [0] * (len(self.places) + 1)

    def add(self, begin: int, end: int) -> None:
        k = bisect_left(self.places, begin) + 1
        while k < len(self.most):
            self.most[k] = max(self.most[k], end)
            k += k & -k

    def end(self, begin: int) -> int:
        k, found = bisect_right(self.places, begin), 0
        while k:
            found = max(found, self.most[k])
            k -= k & -k
        return found


def suppressed(hits: list[Hit], rules: list[Rule]) -> list[Hit]:
    """The hits without those that lie within a better one, best first; base hits all stay, and suppress none.

    A hit within a suppressed one lies within what suppressed that as well, so all
    better hits may be asked, kept or not: n hits take n log n steps.
    """
    kept, better = [], Furthest([h.first for h in hits])
    for h in sorted(hits, key=lambda h: (-rules[h.rule].priority, h.first - h.end, h.rule, h.first)):
        if rules[h.rule].base:
            kept.append(h)
            continue
        if better.end(h.first) < h.end:
            kept.append(h)
        better.add(h.first, h.end)
    return sorted(kept, key=lambda h: (h.first, h.end, h.rule))


def detect(words: list[str], rules: list[Rule] = RULES) -> list[Hit]:
    """All kept hits of a text's words."""
    text, hits, at = " ".join(words), [], None
    for k, r in enumerate(rules):
        if r.keyword in text:
            for m in r.pattern.finditer(text):
                if at is None:  # word number at each character
                    at = np.cumsum(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 32)
                hits.append(Hit(int(at[m.start()]), int(at[m.end() - 1]) + 1, k))
    return suppressed(hits, rules) if hits else hits


RESULT = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double, detections array<struct<rule:string,label:string,first:bigint,end:bigint,priority:int>>"
)
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
     ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
     ("detections", pa.list_(pa.struct([("rule", pa.string()), ("label", pa.string()), ("first", pa.int64()),
                                        ("end", pa.int64()), ("priority", pa.int32())])))]
)


def count_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words of each text, from its bytes."""
    on = ALNUM[data] != 0
    begins = on.copy()
    begins[1:] &= ~on[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] = on[first]
    sums = np.concatenate([[0], np.cumsum(begins)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def gated(data: np.ndarray, offsets: np.ndarray, roots: list[str] = ROOTS) -> np.ndarray:
    """Numbers of the texts in which a root occurs."""
    lower, found = data.tobytes().lower(), []
    for root in map(str.encode, roots):
        at = lower.find(root)
        while at >= 0:
            k = int(np.searchsorted(offsets, at, "right")) - 1
            found.append(k)
            at = lower.find(root, int(offsets[k + 1]))
    return np.unique(np.array(found, np.int64))


def scan(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row per document: word count, base places, labels, confidence and all kept detections.

    The score is the highest priority among the kept detections, as a share of
    100; 0 without any.  Null and empty texts have no words and no labels.
    Rows with equal ids are scanned each; a doc_id that is no number is null;
    other columns play no part.  A text is matched whole, however long; the time
    grows with its length and the logarithm of its hits.
    """
    rules = RULES if rules is None else rules

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                data, offsets = utf8(rows.column("text"))
                ids, out = rows.column("doc_id").to_pylist(), []
                for doc_id, n in zip(ids, count_words(data, offsets).tolist(), strict=True):
                    out.append({"doc_id": doc_id, "n_words": n, "n_base": 0, "base_labels": "", "labels": "", "score": 0.0, "detections": []})
                for k in gated(data, offsets).tolist():
                    found = detect(normal(rows.column("text")[k].as_py()), rules)
                    base = [h for h in found if rules[h.rule].base]
                    if found:
                        label = lambda hits: ",".join(sorted({rules[h.rule].label for h in hits}))
                        out[k] |= {
                            "n_base": len(base), "base_labels": label(base), "labels": label(found),
                            "score": max(rules[h.rule].priority for h in found) / 100,
                            "detections": [{"rule": rules[h.rule].name, "label": rules[h.rule].label, "first": h.first,
                                            "end": h.end, "priority": rules[h.rule].priority} for h in found],
                        }
                    if base:
                        out[k] |= {"first_word": min(h.first for h in base), "last_word": max(h.first for h in base)}
                yield pa.RecordBatch.from_pylist(out, _ARROW)

    rows = docs.select(F.col("doc_id").try_cast("bigint").alias("doc_id"), blank_text(F.col("text")).alias("text"))
    return rows.mapInArrow(tidy(run), RESULT)
