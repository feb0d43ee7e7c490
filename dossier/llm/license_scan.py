"""License detection by ordered signature rules.

A rule is a regex over normalised words with a label, a priority and the keywords without which it can't match. A text is
normalised once; one pass over its keywords tells which rules may match; detections that lie inside a
detection of higher priority (or of the same priority and longer) are suppressed. Base phrases are rules as well, but
every place of theirs is reported and their labels always stay.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.llm.common import map_arrow, utf8

BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass(frozen=True)
class Rule:
    """pattern: a regex over words joined by single spaces; keywords: words of which the text must hold each; priority: the higher wins."""

    label: str
    pattern: str
    keywords: tuple[str, ...]
    priority: int


#: label, words of the full name (a regex), keywords, SPDX words, versions (words; "" for none).
FAMILIES = (
    ("gpl", r"gnu general public licen[cs]e", ("gnu", "general"), "gpl", ("1", "2", "3")),
    ("lgpl", r"gnu (?:lesser|library) general public licen[cs]e", ("gnu", "general"), "lgpl", ("2", "2 1", "3")),
    ("agpl", r"(?:gnu )?affero general public licen[cs]e", ("affero",), "agpl", ("1", "3")),
    ("gfdl", r"gnu free documentation licen[cs]e", ("gnu", "documentation"), "gfdl", ("1 1", "1 2", "1 3")),
    ("apache", r"apache (?:software )?licen[cs]e", ("apache",), "apache", ("1 0", "1 1", "2", "2 0")),
    ("mit", r"mit licen[cs]e", ("mit",), "mit", ("",)),
    ("mit-0", r"mit no attribution(?: licen[cs]e)?", ("mit", "attribution"), "mit 0", ("",)),
    ("isc", r"isc licen[cs]e", ("isc",), "isc", ("",)),
    ("bsd", r"(?:berkeley software distribution|bsd) licen[cs]e", ("bsd",), "bsd", ("",)),
    ("bsd-2", r"(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: licen[cs]e)?", ("bsd",), "bsd 2 clause", ("",)),
    ("bsd-3", r"(?:bsd 3 clause|3 clause bsd|new bsd|revised bsd|modified bsd)(?: licen[cs]e)?", ("bsd",), "bsd 3 clause", ("",)),
    ("bsd-4", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[cs]e)?", ("bsd",), "bsd 4 clause", ("",)),
    ("0bsd", r"(?:zero clause bsd|bsd zero clause)(?: licen[cs]e)?", ("bsd",), "0bsd", ("",)),
    ("mpl", r"mozilla public licen[cs]e", ("mozilla",), "mpl", ("1 0", "1 1", "2 0")),
    ("epl", r"eclipse public licen[cs]e", ("eclipse",), "epl", ("1 0", "2 0")),
    ("edl", r"eclipse distribution licen[cs]e", ("eclipse", "distribution"), "edl", ("1 0",)),
    ("cpl", r"common public licen[cs]e", ("common",), "cpl", ("1 0",)),
    ("ipl", r"ibm public licen[cs]e", ("ibm",), "ipl", ("1 0",)),
    ("cddl", r"common development and distribution licen[cs]e", ("development", "distribution"), "cddl", ("1 0", "1 1")),
    ("eupl", r"european union public licen[cs]e", ("european", "union"), "eupl", ("1 0", "1 1", "1 2")),
    ("artistic", r"artistic licen[cs]e", ("artistic",), "artistic", ("1 0", "2 0")),
    ("boost", r"boost software licen[cs]e", ("boost",), "bsl", ("1 0",)),
    ("zlib", r"zlib(?: libpng)? licen[cs]e", ("zlib",), "zlib", ("",)),
    ("libpng", r"libpng licen[cs]e", ("libpng",), "libpng", ("2 0",)),
    ("unlicense", r"the unlicense", ("unlicense",), "unlicense", ("",)),
    ("wtfpl", r"do what the fuck you want to public licen[cs]e", ("public", "want"), "wtfpl", ("2",)),
    ("python", r"python software foundation licen[cs]e", ("python", "foundation"), "psf", ("2 0",)),
    ("php", r"php licen[cs]e", ("php",), "php", ("3 0", "3 01")),
    ("ruby", r"ruby licen[cs]e", ("ruby",), "ruby", ("",)),
    ("perl", r"same terms as perl itself", ("perl", "terms"), "perl", ("",)),
    ("openssl", r"openssl licen[cs]e", ("openssl",), "openssl", ("",)),
    ("postgresql", r"postgresql licen[cs]e", ("postgresql",), "postgresql", ("",)),
    ("ncsa", r"university of illinois(?: ncsa)? open source licen[cs]e", ("illinois",), "ncsa", ("",)),
    ("osl", r"open software licen[cs]e", ("open", "software"), "osl", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", r"academic free licen[cs]e", ("academic",), "afl", ("1 1", "2 0", "2 1", "3 0")),
    ("ofl", r"sil open font licen[cs]e", ("font",), "ofl", ("1 0", "1 1")),
    ("lppl", r"latex project public licen[cs]e", ("latex",), "lppl", ("1 0", "1 2", "1 3")),
    ("cecill", r"cecill(?: free software)? licen[cs]e", ("cecill",), "cecill", ("1 0", "2 0", "2 1")),
    ("ms-pl", r"microsoft public licen[cs]e", ("microsoft",), "ms pl", ("",)),
    ("ms-rl", r"microsoft reciprocal licen[cs]e", ("microsoft", "reciprocal"), "ms rl", ("",)),
    ("apsl", r"apple public source licen[cs]e", ("apple",), "apsl", ("1 0", "1 2", "2 0")),
    ("spl", r"sun public licen[cs]e", ("sun",), "spl", ("1 0",)),
    ("qpl", r"q public licen[cs]e", ("q", "public"), "qpl", ("1 0",)),
    ("zpl", r"zope public licen[cs]e", ("zope",), "zpl", ("1 1", "2 0", "2 1")),
    ("vim", r"vim licen[cs]e", ("vim",), "vim", ("",)),
    ("curl", r"curl licen[cs]e", ("curl",), "curl", ("",)),
    ("x11", r"x11 licen[cs]e", ("x11",), "x11", ("",)),
    ("w3c", r"w3c software(?: notice and)? licen[cs]e", ("w3c",), "w3c", ("",)),
    ("upl", r"universal permissive licen[cs]e", ("universal", "permissive"), "upl", ("1 0",)),
    ("mulan", r"mulan permissive software licen[cs]e", ("mulan",), "mulanpsl", ("1 0", "2 0")),
    ("blueoak", r"blue oak model licen[cs]e", ("oak",), "blueoak", ("1 0 0",)),
    ("sspl", r"server side public licen[cs]e", ("server", "side"), "sspl", ("1 0",)),
    ("busl", r"business source licen[cs]e", ("business",), "busl", ("1 1",)),
    ("elastic", r"elastic licen[cs]e", ("elastic",), "elastic", ("2 0",)),
    ("odbl", r"open(?: data commons open)? database licen[cs]e", ("database",), "odbl", ("1 0",)),
    ("pddl", r"public domain dedication and licen[cs]e", ("dedication",), "pddl", ("1 0",)),
    ("cc0", r"(?:cc0|creative commons zero|cc zero)(?: universal)?", ("cc0", "zero"), "cc0", ("1 0",)),
    ("public-domain", r"(?:released|placed|dedicated|lies|is) (?:in|into|to) the public domain", ("public", "domain"), "public domain", ("",)),
    ("proprietary", r"all rights reserved", ("rights", "reserved"), "proprietary", ("",)),
)

#: Further names that share no keyword with those above: label, words (a regex), keywords.
OTHER_NAMES = (
    ("bsd-2", r"freebsd(?: licen[cs]e)?", ("freebsd",)),
    ("0bsd", r"0bsd(?: licen[cs]e)?", ("0bsd",)),
)

#: Creative Commons variants: label, short words, long words.
COMMONS = (
    ("cc-by", "by", "attribution"),
    ("cc-by-sa", "by sa", "attribution share ?alike"),
    ("cc-by-nd", "by nd", "attribution no ?deriv(?:ative|ative work)?s"),
    ("cc-by-nc", "by nc", "attribution non ?commercial"),
    ("cc-by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative|ative work)?s"),
)

#: Clauses that identify a licence by its own wording: label, regex, keywords.
CLAUSES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", ("permission", "charge")),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies", ("notice", "permission")),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose", ("permission", "purpose")),
    ("bsd", r"redistribution and use in source and binary forms with or without modification", ("redistribution", "binary")),
    ("bsd-3", r"neither the name of .{1,80}? nor the names of its contributors may be used", ("neither", "contributors")),
    ("bsd-4", r"all advertising materials mentioning features or use of this software", ("advertising",)),
    ("apache", r"you may not use this file except in compliance with the license", ("compliance",)),
    ("apache", r"unless required by applicable law or agreed to in writing software", ("applicable",)),
    ("gpl", r"this program is free software you can redistribute it and or modify it", ("redistribute", "modify")),
    ("gpl", r"without even the implied warranty of merchantability or fitness for a particular purpose", ("merchantability",)),
    ("lgpl", r"this library is free software you can redistribute it and or modify it", ("library", "redistribute")),
    ("mpl", r"this source code form is subject to the terms of the mozilla public licen[cs]e", ("mozilla",)),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors", ("warranty", "authors")),
    ("boost", r"permission is hereby granted free of charge to any person or organization obtaining", ("permission", "organization")),
    ("unlicense", r"this is free and unencumbered software released into the public domain", ("unencumbered",)),
    ("wtfpl", r"everyone is permitted to copy and distribute verbatim or modified copies", ("verbatim",)),
    ("artistic", r"the intent of this document is to state the conditions under which a package may be copied", ("intent", "package")),
    ("proprietary", r"(?:confidential and proprietary|proprietary and confidential)", ("proprietary",)),
    ("proprietary", r"unauthorized (?:copying|use|reproduction) of this (?:file|software|document)", ("unauthorized",)),
    ("proprietary", r"unauthorised (?:copying|use|reproduction) of this (?:file|software|document)", ("unauthorised",)),
)


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """The ordered rules: clauses and tags outrank versioned names, which outrank bare names."""
    out = [Rule(label, pattern, keys, 50) for label, pattern, keys in CLAUSES]
    out += [Rule(label, pattern, keys, 20) for label, pattern, keys in OTHER_NAMES]
    for label, name, keys, tag, versions in FAMILIES:
        first_tag = tag.split()[0]
        out.append(Rule(label, name, keys if label not in ("cc0", "bsd") else (), 20))
        out.append(Rule(label, rf"spdx license identifier {tag}(?: [0-9]+)*(?: only| or later)?", ("spdx", first_tag), 60))
        out.append(Rule(label, rf"(?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?{tag}(?: licen[cs]e)?", ("under", first_tag), 30))
        for v in versions:
            if v:
                out.append(Rule(f"{label}-{v.replace(' ', '.')}", rf"{name} (?:version |v ?)?{v}", keys if label != "cc0" else (), 40))
                out.append(Rule(f"{label}-{v.replace(' ', '.')}", rf"{tag} (?:v ?)?{v}(?: only| or later)?", (first_tag,), 35))
    for label, short, long in COMMONS:
        out.append(Rule(label, rf"cc {short}", ("cc",), 20 + len(short)))
        out.append(Rule(label, rf"creative commons {long}", ("creative", "commons"), 20 + len(short)))
        out.append(Rule(label, rf"creativecommons org licenses {short}", ("creativecommons",), 60 + len(short)))
        for v in ("1 0", "2 0", "2 5", "3 0", "4 0", "4"):
            out.append(Rule(f"{label}-{v.split()[0] if v.endswith(' 0') else v.replace(' ', '.')}", rf"cc {short} {v}(?! [0-9])", ("cc",), 40 + len(short)))
    return tuple(out)


def fold(text: bytes) -> bytes:
    """Lower-case A-Z; every other ASCII byte but letters and digits becomes a space."""
    return text.translate(_FOLD)


class Scanner:
    """Compiled rules behind one keyword automaton."""

    def __init__(self, ordered: tuple[Rule, ...], base: tuple[tuple[str, str], ...] = BASE):
        self.rules = [(r, re.compile(rb"(?<= )" + r.pattern.encode() + rb"(?= )"), frozenset(r.keywords)) for r in ordered]
        self.base = [(phrase.encode(), label) for phrase, label in base]
        self.words = sorted({k for r in ordered for k in r.keywords})
        self.gate = ahocorasick.Automaton()
        for w in self.words:
            self.gate.add_word(f" {w} ", w)
        if self.words:
            self.gate.make_automaton()
        # No rule without keywords can match a text without "license", "licence" or its own word: those are always tried.
        self.always = [i for i, (_, _, keys) in enumerate(self.rules) if not keys]
        self.by_keyword: dict[str, list[int]] = {}
        for i, (r, _, keys) in enumerate(self.rules):
            if keys:
                self.by_keyword.setdefault(min(keys, key=lambda k: (-len(k), k)), []).append(i)

    def present(self, line: bytes) -> set[str]:
        # A word ends where the next begins: overlapping spaces are found as the automaton keeps its state.
        return {w for _, w in self.gate.iter(line.decode("latin-1"))} if self.words else set()

    def base_places(self, line: bytes) -> list[tuple[int, int, str]]:
        """(byte start, byte end, label) of every base phrase in a line of words with a space at both ends."""
        out = []
        for phrase, label in self.base:
            needle = b" " + phrase + b" "
            at = line.find(needle)
            while at >= 0:
                out.append((at + 1, at + 1 + len(phrase), label))
                at = line.find(needle, at + 1)
        return sorted(out)

    def detections(self, line: bytes) -> list[tuple[int, int, str, int]]:
        """(start, end, label, priority) of what stays of the rules' matches, in order."""
        there = self.present(line)
        tried = [*self.always, *(i for w in there for i in self.by_keyword.get(w, ()))]
        found = []
        for i in sorted(tried):
            rule, pattern, keys = self.rules[i]
            if keys <= there:
                found += [(m.start(), m.end(), rule.label, rule.priority) for m in pattern.finditer(line)]
        return suppressed(found)


def suppressed(found: list[tuple[int, int, str, int]]) -> list[tuple[int, int, str, int]]:
    """Drop detections inside an accepted one: by priority, then length, then place, then label."""
    kept: list[tuple[int, int, str, int]] = []
    starts: list[int] = []  # of accepted detections that no other holds, in order; their ends are in order too
    ends: list[int] = []
    for d in sorted(set(found), key=lambda d: (-d[3], d[0] - d[1], d[0], d[2])):
        at = bisect_right(starts, d[0])
        if at and ends[at - 1] >= d[1]:
            continue
        kept.append(d)
        low, high = bisect_left(starts, d[0]), bisect_right(ends, d[1])
        starts[low : max(low, high)], ends[low : max(low, high)] = [d[0]], [d[1]]
    return sorted(kept)


@lru_cache(maxsize=1)
def _scanner() -> Scanner:
    return Scanner(rules())


DETECTION = "array<struct<start_word:long,n_words:long,label:string,priority:int,base:boolean>>"


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n_words and detections (start_word, n_words, label, priority, base) of every whole text.

    A null or empty text has no words and no detections; repeated rows give repeated results; an empty table gives no rows; other
    columns are ignored. Base detections hold every place of a base phrase, whatever else is found there.
    """
    kind = docs.schema[key].dataType.simpleString()
    item = pa.struct([("start_word", pa.int64()), ("n_words", pa.int64()), ("label", pa.string()), ("priority", pa.int32()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner()
        for b in batches:
            counts, all_found = [], []
            for t in utf8(b, text):
                words = fold(t or b"").split()
                line = b" " + b" ".join(words) + b" "
                counts.append(len(words))
                rows = [(a, z, label, 100, True) for a, z, label in scanner.base_places(line)]
                rows += [(*d, False) for d in scanner.detections(line)]
                if rows:
                    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
                    rows = [{"start_word": int(np.searchsorted(spaces, a)) - 1, "n_words": line.count(b" ", a, z) + 1, "label": label, "priority": p, "base": base} for a, z, label, p, base in rows]
                all_found.append(rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(all_found, pa.list_(item))], names=[key, "n_words", "detections"])

    return map_arrow(docs.select(key, text), run, f"`{key}` {kind}, n_words long, detections {DETECTION}")


def license_digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of *docs*: n_words, n_base, first_word, last_word, base_labels, labels, score (the share of priority that
    the best detection reaches, 0 without any)."""
    found = scan(docs, key, text)
    base = F.filter("detections", lambda d: d["base"])
    starts = F.transform(base, lambda d: d["start_word"])
    named = lambda xs: F.array_join(F.array_sort(F.array_distinct(F.transform(xs, lambda d: d["label"]))), ",")
    return found.select(
        key, "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), named(base).alias("base_labels"), named(F.col("detections")).alias("labels"),
        F.least(F.lit(1.0), F.coalesce(F.array_max(F.transform("detections", lambda d: d["priority"])), F.lit(0)) / F.lit(100.0)).alias("score"),
    )
