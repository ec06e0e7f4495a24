"""Operator 10: license scans by ordered signature rules.

Texts become words (A-Z lower-cased).  Base phrases are looked up as runs of word hashes over whole
slices of documents.  Signature rules are regular expressions over the words joined by single
blanks; a rule runs on a document only if one of its keywords is among the document's words, and
every match of a rule holds one of them as a word.  Detections are resolved by priority: one that lies within a stronger one (same interval: the earlier rule) is
suppressed, so "apache license 2 0" does not also report "apache".
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textops as T
from ledgerlens.llm.common import ship_code

# fixed values: base phrases and labels
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


@dataclass(frozen=True)
class Signature:
    """``pattern`` runs where one of ``keywords``, joined by blanks, is a word; a higher ``priority`` suppresses what it contains."""

    label: str
    keywords: str
    pattern: str
    priority: int
    weight: float


# Hand-written signatures: label, keywords, priority, weight, pattern over normalised words.
_WRITTEN = (
    ("mit", "mit", 60, 0.9, r"mit licen[sc]ed?"),
    ("mit", "mit", 60, 0.9, r"licensed under (?:the )?mit"),
    ("mit", "mit", 50, 0.8, r"released under (?:the )?mit"),
    ("mit", "hereby", 90, 1.0, r"permission is hereby granted free of charge to any person obtaining a copy(?: of this software)?"),
    ("mit", "mit", 70, 1.0, r"spdx license identifier mit"),
    ("isc", "isc", 60, 0.9, r"isc licen[sc]ed?"),
    ("isc", "isc", 70, 1.0, r"spdx license identifier isc"),
    ("isc", "hereby", 90, 1.0, r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "bsd", 40, 0.8, r"bsd (?:style )?licen[sc]ed?"),
    ("bsd-2-clause", "bsd", 70, 1.0, r"(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: licen[sc]e)?"),
    ("bsd-3-clause", "bsd", 70, 1.0, r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?"),
    ("bsd-4-clause", "bsd", 70, 1.0, r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[sc]e)?"),
    ("bsd", "redistribution", 90, 1.0, r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("0bsd", "0bsd zero", 70, 1.0, r"0bsd|zero clause bsd"),
    ("apache", "apache", 40, 0.7, r"apache (?:software )?licen[sc]ed?"),
    ("apache-1.1", "apache", 70, 1.0, r"apache (?:software )?licen[sc]e (?:version |v)?1 1"),
    ("apache-2.0", "apache", 70, 1.0, r"apache (?:software )?licen[sc]e (?:version |v )?v?2(?: 0)?"),
    ("apache-2.0", "apache", 70, 1.0, r"(?:spdx license identifier )?apache 2 0"),
    ("apache-2.0", "apache", 80, 1.0, r"licensed under the apache license version 2 0 the license"),
    ("apache-2.0", "apache", 80, 1.0, r"www apache org licenses license 2 0"),
    ("mpl", "mozilla", 40, 0.7, r"mozilla public licen[sc]e"),
    ("mpl-1.1", "mozilla", 70, 1.0, r"mozilla public licen[sc]e (?:version |v )?1 1"),
    ("mpl-2.0", "mozilla", 70, 1.0, r"mozilla public licen[sc]e (?:version |v )?2 0"),
    ("mpl-2.0", "mpl", 70, 1.0, r"mpl 2 0"),
    ("epl-1.0", "eclipse", 70, 1.0, r"eclipse public licen[sc]e (?:version |v )?1 0"),
    ("epl-2.0", "eclipse", 70, 1.0, r"eclipse public licen[sc]e (?:version |v )?2 0"),
    ("epl", "eclipse", 40, 0.7, r"eclipse public licen[sc]e"),
    ("edl-1.0", "eclipse", 60, 0.9, r"eclipse distribution licen[sc]e"),
    ("cddl", "cddl", 50, 0.8, r"cddl(?: 1 [01])?"),
    ("cddl", "distribution", 60, 0.9, r"common development and distribution licen[sc]e"),
    ("cpl-1.0", "common", 60, 0.9, r"common public licen[sc]e"),
    ("artistic", "artistic", 40, 0.8, r"artistic licen[sc]e"),
    ("artistic-2.0", "artistic", 70, 1.0, r"artistic licen[sc]e (?:version |v )?2 0"),
    ("perl", "perl", 70, 0.9, r"(?:under )?the same terms as perl(?: itself)?"),
    ("zlib", "zlib", 60, 0.9, r"zlib(?: libpng)? licen[sc]e"),
    ("zlib", "warranty", 90, 1.0, r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("boost-1.0", "boost", 60, 1.0, r"boost software licen[sc]e"),
    ("boost-1.0", "bsl", 70, 1.0, r"bsl 1 0"),
    ("unlicense", "unlicense", 60, 1.0, r"(?:the )?unlicense"),
    ("unlicense", "unencumbered", 90, 1.0, r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "wtfpl", 60, 1.0, r"wtfpl"),
    ("public-domain", "domain", 40, 0.8, r"(?:released|dedicated|placed) (?:in|into|to) the public domain"),
    ("public-domain", "domain", 30, 0.5, r"public domain"),
    ("cc0", "cc0", 60, 1.0, r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0", "zero", 60, 1.0, r"creative commons zero(?: 1 0)?"),
    ("odbl", "database", 60, 0.9, r"open (?:data commons open )?database licen[sc]e"),
    ("odc-by", "attribution", 60, 0.9, r"open data commons attribution licen[sc]e"),
    ("ogl-uk", "government", 60, 0.9, r"open government licen[sc]e(?: v?[123] 0)?"),
    ("gfdl", "documentation", 60, 0.9, r"gnu free documentation licen[sc]e"),
    ("gfdl", "gfdl", 60, 0.9, r"gfdl(?: 1 [123])?"),
    ("ofl-1.1", "font", 60, 0.9, r"(?:sil )?open font licen[sc]e"),
    ("ofl-1.1", "ofl", 70, 1.0, r"ofl 1 1"),
    ("psf", "python", 60, 0.9, r"python software foundation licen[sc]e"),
    ("python", "python", 50, 0.8, r"python licen[sc]e"),
    ("php", "php", 60, 0.9, r"php licen[sc]e(?: version 3 0[01])?"),
    ("ruby", "ruby", 50, 0.8, r"(?:ruby s|ruby) licen[sc]e"),
    ("w3c", "w3c", 60, 0.9, r"w3c software (?:notice and )?licen[sc]e"),
    ("x11", "x11", 60, 0.9, r"x11 licen[sc]e"),
    ("openssl", "openssl", 60, 0.9, r"openssl licen[sc]e"),
    ("ncsa", "ncsa", 60, 0.9, r"(?:university of illinois )?ncsa open source licen[sc]e"),
    ("upl-1.0", "universal", 60, 0.9, r"universal permissive licen[sc]e"),
    ("ms-pl", "microsoft", 60, 0.9, r"microsoft public licen[sc]e"),
    ("ms-rl", "microsoft", 60, 0.9, r"microsoft reciprocal licen[sc]e"),
    ("eupl", "union", 60, 0.9, r"european union public licen[sc]e"),
    ("eupl", "eupl", 60, 0.9, r"eupl(?: v?1 [012])?"),
    ("cecill", "cecill", 60, 0.9, r"cecill(?: [bc])?"),
    ("qpl-1.0", "q", 60, 0.9, r"q public licen[sc]e"),
    ("sleepycat", "sleepycat", 60, 0.9, r"sleepycat licen[sc]e"),
    ("sspl-1.0", "sspl", 60, 1.0, r"sspl(?: 1 0)?"),
    ("sspl-1.0", "server", 70, 1.0, r"server side public licen[sc]e"),
    ("busl-1.1", "business", 60, 0.9, r"business source licen[sc]e"),
    ("elastic-2.0", "elastic", 60, 0.9, r"elastic licen[sc]e(?: v?2 0)?"),
    ("commons-clause", "clause", 60, 0.9, r"commons clause"),
    ("json", "evil", 80, 0.9, r"the software shall be used for good not evil"),
    ("beerware", "beerware", 60, 0.9, r"beerware(?: licen[sc]e)?"),
    ("proprietary", "proprietary", 40, 0.7, r"proprietary and confidential"),
    ("proprietary", "confidential", 40, 0.7, r"strictly confidential"),
    ("proprietary", "unauthorized unauthorised", 50, 0.8, r"unauthori[sz]ed (?:copying|use|reproduction|distribution)(?: of this file)? (?:via any medium )?is (?:strictly )?prohibited"),
    ("proprietary", "permission", 50, 0.8, r"may not be (?:copied|reproduced|distributed)(?: or \S+)? without (?:the )?(?:prior )?(?:written )?permission"),
    ("reserved", "reserved", 20, 0.5, r"(?:all|some) rights reserved"),
    ("copyright", "copyright", 20, 0.4, r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?"),
    ("copyleft", "copyleft", 30, 0.5, r"copyleft"),
    ("open-source", "osi", 30, 0.5, r"osi approved"),
    ("dual", "dual", 40, 0.7, r"dual licensed"),
)


def _built() -> list[Signature]:
    """Signatures that differ only by family, version and wording."""
    out = []
    terms = {"by": "attribution", "by-sa": "attribution share ?alike", "by-nc": "attribution non ?commercial",
             "by-nd": "attribution no ?deriv(?:ative|ative works|s|atives)", "by-nc-sa": "attribution non ?commercial share ?alike",
             "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative|ative works|s|atives)"}
    for code, words in terms.items():
        short = code.replace("-", " ")
        out.append(Signature(f"cc-{code}", "cc", rf"cc {short}", 60 + len(code), 0.9))
        out.append(Signature(f"cc-{code}", "commons", rf"creative commons {words}(?: (?:international|unported|generic))?(?: licen[sc]e)?", 60 + len(code), 0.9))
        for version in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            label = f"cc-{code}-{version.replace(' ', '.')}"
            out.append(Signature(label, "cc", rf"cc {short} {version}", 80 + len(code), 1.0))
            out.append(Signature(label, "commons", rf"creative commons {words} {version}(?: (?:international|unported|generic))?(?: licen[sc]e)?", 80 + len(code), 1.0))
            out.append(Signature(label, "creativecommons", rf"creativecommons org licenses {short} {version}", 80 + len(code), 1.0))
    families = {"gpl": ("", ("1", "2", "3")), "lgpl": ("(?:lesser|library) ", ("2", "2 1", "3")), "agpl": ("affero ", ("1", "3"))}
    for family, (word, versions) in families.items():
        out.append(Signature(family, "public", rf"(?:gnu )?{word}general public licen[sc]e", 40, 0.8))
        out.append(Signature(family, family, family, 30, 0.7))
        for version in versions:
            number, label = rf"(?:version |v )?v?{version}(?: 0)?", f"{family}-{version.replace(' ', '.')}"
            joined = " ".join([family, *(f"{family}{x}" for x in ("version", "v", f"v{version[0]}", version[0]))])  # gpl 3, gplversion 3, gplv 3, gplv3, gpl3
            out.append(Signature(label, "public", rf"(?:gnu )?{word}general public licen[sc]e {number}", 70, 1.0))
            out.append(Signature(label, joined, rf"(?:gnu )?{family} ?{number}", 60, 0.9))
            for tail, name in (("only", "only"), (r"or (?:\(?at your option\)? )?(?:any )?later(?: version)?", "or-later")):
                out.append(Signature(f"{label}-{name}", "public", rf"(?:gnu )?{word}general public licen[sc]e {number} {tail}", 80, 1.0))
                out.append(Signature(f"{label}-{name}", joined, rf"(?:gnu )?{family} ?{number} {tail}", 75, 1.0))
    return out


SIGNATURES = tuple(Signature(label, keywords, pattern, priority, weight) for label, keywords, priority, weight, pattern in _WRITTEN) + tuple(_built())

_in_word = np.zeros(256, dtype=bool)
_in_word[0x30:0x3A] = _in_word[0x41:0x5B] = _in_word[0x61:0x7B] = _in_word[0x80:] = True


def _hash_word(word: str) -> np.uint64:
    buf = np.frombuffer(word.encode(), dtype=np.uint8)
    return T.span_hashes(T.prefix_sums(buf), np.array([0]), np.array([len(buf)]))[0]


@lru_cache(maxsize=1)
def _compiled() -> dict[str, list[tuple[int, Signature, re.Pattern]]]:
    by_keyword: dict[str, list] = {}
    for i, s in enumerate(SIGNATURES):
        rule = (i, s, re.compile(rf"(?<![^ ])(?:{s.pattern})(?![^ ])"))
        for keyword in s.keywords.split():
            by_keyword.setdefault(keyword, []).append(rule)
    return by_keyword


def resolve(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of (start, end, priority, rule), those that lie within no stronger one.

    Taken from the strongest to the weakest; kept intervals are held by start, with the furthest
    end so far, so each test is a binary search.
    """
    kept: list[tuple[int, int, int, int]] = []
    starts: list[int] = []
    reach: list[int] = []  # reach[i]: the furthest end among kept intervals that start at or before starts[i]
    for d in sorted(found, key=lambda x: (-x[2], x[0] - x[1], x[3], x[0])):
        i = bisect_right(starts, d[0])
        if i and reach[i - 1] >= d[1]:
            continue
        kept.append(d)
        starts.insert(i, d[0])
        reach.insert(i, max(d[1], reach[i - 1] if i else 0))
        for j in range(i + 1, len(reach)):
            if reach[j] >= d[1]:
                break
            reach[j] = d[1]
    return kept


def detect(normalised: str, words: set[str]) -> list[tuple[int, int, int, int]]:
    """Resolved detections (first word, end word, priority, rule) in words joined by blanks."""
    by_keyword = _compiled()
    rules = {rule[0]: rule for k in words & by_keyword.keys() for rule in by_keyword[k]}  # once, whichever keywords call it
    spans = [(m.start(), m.end(), s.priority, i) for i, s, p in rules.values() for m in p.finditer(normalised)]
    if not spans:
        return []
    blanks = [m.start() for m in re.finditer(" ", normalised)]
    return resolve([(bisect_right(blanks, a), bisect_right(blanks, b - 1) + 1, p, i) for a, b, p, i in spans])


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                  ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    phrases = [([_hash_word(w) for w in phrase.split()], label) for phrase, label in BASE_PHRASES]
    keywords = np.array([_hash_word(k) for k in _compiled()], dtype=np.uint64)
    for batch in batches:
        for rows, buf, offsets in T.cut_slices(batch, "text"):
            low = T.lower_ascii(buf)
            start, end, first = T.word_spans(buf, offsets, _in_word)
            h = T.span_hashes(T.prefix_sums(low), start, end)
            n = rows.num_rows
            doc = np.repeat(np.arange(n), np.diff(first))
            n_base, low_word, high_word = np.zeros(n, np.int64), np.full(n, 1 << 62), np.full(n, -1)
            labels: dict[int, set[str]] = {}
            base: dict[int, set[str]] = {}
            score: dict[int, float] = {}
            for hashes, label in phrases:
                m = max(0, len(h) - len(hashes) + 1)
                at = np.flatnonzero(np.logical_and.reduce([h[j: j + m] == x for j, x in enumerate(hashes)])) if m else np.zeros(0, np.int64)
                at = at[doc[at] == doc[at + len(hashes) - 1]]
                np.add.at(n_base, doc[at], 1)
                np.minimum.at(low_word, doc[at], at - first[doc[at]])
                np.maximum.at(high_word, doc[at], at - first[doc[at]])
                for d in np.unique(doc[at]).tolist():
                    base.setdefault(d, set()).add(label)
            for d in np.unique(doc[np.isin(h, keywords)]).tolist():
                spans = zip(start[first[d]:first[d + 1]].tolist(), end[first[d]:first[d + 1]].tolist())
                data = low[offsets[d]:offsets[d + 1]].tobytes()
                o = int(offsets[d])
                words = [data[a - o:b - o].decode() for a, b in spans]
                found = detect(" ".join(words), set(words))
                labels[d] = {SIGNATURES[i].label for *_, i in found}
                miss = 1.0
                for name in labels[d]:
                    miss *= 1 - max(SIGNATURES[i].weight for *_, i in found if SIGNATURES[i].label == name)
                score[d] = round(1 - miss, 6)
            has = n_base > 0
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(np.diff(first)), pa.array(n_base), pa.array(low_word, mask=~has),
                 pa.array(high_word, mask=~has), pa.array([",".join(sorted(base.get(d, ()))) for d in range(n)], pa.string()),
                 pa.array([",".join(sorted(base.get(d, set()) | labels.get(d, set()))) for d in range(n)], pa.string()),
                 pa.array([max(score.get(d, 0.0), 0.5 if d in base else 0.0) for d in range(n)], pa.float64())], schema=_OUT)


def document_licenses(docs: DataFrame) -> DataFrame:
    """n_words, base phrase places (n_base, first_word, last_word, base_labels), labels and score of each row.

    Words are runs of digits, letters and non-ASCII characters; the whole text is scanned.  A null
    or empty text has no words: counts 0, null positions, empty labels, score 0.  ``score`` is the
    chance that at least one label holds, taking rule weights as independent; a base phrase gives
    at least 0.5.  Repeated rows are answered each; other columns are ignored.
    """
    ship_code(docs.sparkSession)
    ddl = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
           "labels string, score double")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scan, ddl)
