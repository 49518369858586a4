"""License scans with ordered signature rules (operator 6).

Rules are regular expressions over the lower-cased UTF-8 bytes. A rule runs only on texts that hold all
its keywords. Detections are resolved by priority (then length, then place): one whose interval lies
inside that of a detection already kept is suppressed, so "GNU Lesser General Public License" is not
also a GPL notice. The base phrases are found besides the rules and are never suppressed.

Nulls and odd rows: a NULL text is an empty one: no words, no labels, score 0. Repeated rows are
scanned each, texts are scanned whole, NULL ids are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.llm.common import arrow_rows

#: Base phrases and their labels (fixed values).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_W = rb"[0-9a-z\x80-\xff]"
_GAP = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]"
_V = r"(?:,? ?(?:version|ver\.?|v\.?)? ?)"

#: Licence families: label, keywords, name (a regular expression), versions, name on the web (fixed values).
FAMILIES = [
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e", ("1.0", "3.0"), "agpl"),
    ("lgpl", "lesser general", r"(?:gnu )?lesser general public licen[sc]e", ("2.1", "3.0"), "lgpl"),
    ("lgpl", "library general", r"(?:gnu )?library general public licen[sc]e", ("2.0",), "lgpl"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[sc]e", ("1.1", "1.2", "1.3"), "fdl"),
    ("gpl", "general public", r"(?:gnu )?general public licen[sc]e", ("1.0", "2.0", "3.0"), "gpl"),
    ("apache", "apache", r"apache (?:software )?licen[sc]e", ("1.0", "1.1", "2.0"), "apache"),
    ("mit", "mit", r"mit licen[sc]e", (), "mit"),
    ("mit", "expat", r"expat licen[sc]e", (), "expat"),
    ("mit", "x11", r"x11 licen[sc]e", (), "x11"),
    ("bsd", "bsd", r"bsd(?:[- ](?:style|[0-4][- ]clause))? licen[sc]e", (), "bsd"),
    ("isc", "isc", r"isc licen[sc]e", (), "isc"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e", ("1.0", "1.1", "2.0"), "mpl"),
    ("epl", "eclipse", r"eclipse public licen[sc]e", ("1.0", "2.0"), "epl"),
    ("edl", "eclipse distribution", r"eclipse distribution licen[sc]e", ("1.0",), "edl"),
    ("cddl", "common development", r"common development and distribution licen[sc]e", ("1.0", "1.1"), "cddl"),
    ("cpl", "common public", r"common public licen[sc]e", ("1.0",), "cpl"),
    ("eupl", "european union", r"european union public licen[sc]e", ("1.0", "1.1", "1.2"), "eupl"),
    ("artistic", "artistic", r"artistic licen[sc]e", ("1.0", "2.0"), "artistic"),
    ("bsl", "boost", r"boost software licen[sc]e", ("1.0",), "bsl"),
    ("busl", "business source", r"business source licen[sc]e", ("1.1",), "busl"),
    ("sspl", "server side", r"server side public licen[sc]e", ("1",), "sspl"),
    ("zlib", "zlib", r"zlib(?:/libpng)? licen[sc]e", (), "zlib"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", (), "unlicense"),
    ("wtfpl", "do what the", r"do what the f[u*]ck you want to public licen[sc]e", ("2",), "wtfpl"),
    ("python", "python", r"python (?:software foundation )?licen[sc]e", ("2.0",), "python"),
    ("php", "php", r"php licen[sc]e", ("3.0", "3.01"), "php"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e", (), "postgresql"),
    ("openssl", "openssl", r"openssl licen[sc]e", (), "openssl"),
    ("ofl", "open font", r"(?:sil )?open font licen[sc]e", ("1.0", "1.1"), "ofl"),
    ("osl", "open software", r"open software licen[sc]e", ("1.0", "2.0", "2.1", "3.0"), "osl"),
    ("afl", "academic free", r"academic free licen[sc]e", ("2.0", "2.1", "3.0"), "afl"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e", (), "ms-pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e", (), "ms-rl"),
    ("ncsa", "ncsa", r"(?:university of illinois/)?ncsa open source licen[sc]e", (), "ncsa"),
    ("upl", "universal permissive", r"universal permissive licen[sc]e", ("1.0",), "upl"),
    ("qpl", "q public", r"q public licen[sc]e", ("1.0",), "qpl"),
    ("lppl", "latex project", r"latex project public licen[sc]e", ("1.2", "1.3c"), "lppl"),
    ("odbl", "open database", r"open (?:data commons )?(?:open )?database licen[sc]e", ("1.0",), "odbl"),
    ("odc-by", "open data commons", r"open data commons attribution licen[sc]e", ("1.0",), "odc-by"),
    ("cecill", "cecill", r"cecill(?: free software)? licen[sc]e", ("1.0", "2.0", "2.1"), "cecill"),
    ("mulan", "mulan", r"mulan (?:permissive|public) (?:software )?licen[sc]e", ("1", "2"), "mulan"),
    ("ogl", "open government", r"open government licen[sc]e", ("1.0", "2.0", "3.0"), "ogl"),
    ("elastic", "elastic", r"elastic licen[sc]e", ("2.0",), "elastic"),
    ("vim", "vim", r"vim licen[sc]e", (), "vim"),
    ("ruby", "ruby", r"ruby licen[sc]e", (), "ruby"),
    ("curl", "curl", r"curl licen[sc]e", (), "curl"),
    ("imagemagick", "imagemagick", r"imagemagick licen[sc]e", (), "imagemagick"),
    ("w3c", "w3c", r"w3c software (?:notice and )?licen[sc]e", (), "w3c"),
]
#: Creative Commons parts in their order, and versions (fixed values).
CC_PARTS = ["by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"]
CC_WORDS = {"by": "attribution", "sa": "sharealike", "nd": "noderiv(?:ative|s|atives)", "nc": "noncommercial"}
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
#: Single rules: label, keywords, regular expression, priority, confidence (fixed values).
SINGLE = [
    ("cc0", "cc0", r"cc0(?: ?1\.0)?(?: universal)?", 20, 0.9),
    ("cc0", "zero", r"creative commons zero", 20, 0.9),
    ("public-domain", "public domain", r"(?:released|placed|dedicated|is) (?:in|into|to) the public domain", 30, 0.9),
    ("public-domain", "public domain", r"public domain", 60, 0.6),
    ("mit", "permission is hereby", r"permission is hereby granted, free of charge, to any person obtaining a copy", 10, 0.95),
    ("isc", "permission to use", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose", 10, 0.9),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms", 10, 0.95),
    ("zlib", "as-is", r"provided 'as-is', without any express or implied warranty", 15, 0.8),
    ("warranty", "warrant", r"without (?:any )?warrant(?:y|ies)(?: or conditions)? of any kind", 70, 0.4),
    ("copyright", "copyright", r"copyright (?:\(c\)|\xc2\xa9)? ?(?:19|20)[0-9][0-9]", 70, 0.4),
    ("proprietary", "proprietary", r"proprietary and confidential", 40, 0.8),
    ("proprietary", "without permission", r"(?:no part of this|may not be (?:copied|reproduced)).{0,80}without (?:prior |written )*permission", 40, 0.8),
    ("non-commercial", "commercial", r"(?:for )?non-?commercial (?:use|purposes)(?: only)?", 50, 0.6),
    ("dual", "dual", r"dual[- ]licen[sc]ed", 50, 0.5),
]


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[bytes, ...]
    pattern: re.Pattern[bytes]
    priority: int
    confidence: float


def _rule(label: str, keyword: str, pattern: str, priority: int, confidence: float) -> Rule:
    gap = r"[\s*#/]+"  # a blank stands for what separates words, also over commented lines
    spaced = pattern.replace("[- ]+", "~").replace("[- ]", "~").replace(" ?", r"[\s*#/]*").replace(" ", gap).replace("~", r"[-\s]+")
    whole = b"(?<!" + _W + b")(?:" + spaced.encode("latin-1") + b")(?!" + _W + b")"
    return Rule(label, tuple(keyword.encode("ascii").split()), re.compile(whole, re.DOTALL), priority, confidence)


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, in the order in which they win: the templates of every family, then the single rules."""
    out = []
    for place, (label, keyword, name, versions, web) in enumerate(FAMILIES):
        first = 20 + place / 100  # a family listed earlier wins over a later one of the same form
        for v in versions:
            number = re.escape(v[:-2]) + r"(?:\.0)?" if v.endswith(".0") else re.escape(v)
            out.append(_rule(f"{label}-{v}", keyword, f"{name}{_V}{number}", first, 0.95))
            out.append(_rule(f"{label}-{v}", "spdx", rf"spdx-license-identifier: {web}-{re.escape(v)}(?:-only|-or-later)?", 5, 1.0))
            out.append(_rule(f"{label}-{v}", web, rf"{web}-?v?{number}", first + 5, 0.8))
        out.append(_rule(label, keyword, name, first + 10, 0.85))
        out.append(_rule(label, "spdx", rf"spdx-license-identifier: {web}[-.+0-9a-z]*", 6, 1.0))
        out.append(_rule(label, "licenses/", rf"(?:opensource\.org|gnu\.org|apache\.org|spdx\.org)/licenses/{web}[-.0-9a-z]*", first + 5, 0.9))
    for parts in CC_PARTS:
        words = "[- ]+".join(CC_WORDS[p] for p in parts.split("-"))
        dashed = parts.replace("-", "[- ]")
        for v in CC_VERSIONS:
            number = re.escape(v)
            out.append(_rule(f"cc-{parts}-{v}", "cc", f"cc[- ]{dashed}[- ]{number}", 20, 0.95))
            out.append(_rule(f"cc-{parts}-{v}", "creative commons", f"creative commons {words} {number}", 20, 0.95))
            out.append(_rule(f"cc-{parts}-{v}", "licenses/", rf"creativecommons\.org/licenses/{parts}/{number}", 20, 0.95))
        out.append(_rule(f"cc-{parts}", "cc", f"cc[- ]{dashed}", 30, 0.85))
        out.append(_rule(f"cc-{parts}", "creative commons", f"creative commons {words}", 30, 0.85))
    out += [_rule(*single) for single in SINGLE]
    return tuple(sorted(out, key=lambda r: r.priority))


_BASE = [(label, phrase.split(" ")[0].encode(), re.compile(b"(?<!" + _W + b")" + (_GAP + b"+").join(w.encode() for w in phrase.split(" ")) + b"(?!" + _W + b")")) for phrase, label in BASE.items()]
_BASE_CONFIDENCE = 0.6
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def resolve(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Detections that no earlier kept one contains; found in the rules' order of priority."""
    kept: list[tuple[int, int, Rule]] = []
    cells: dict[int, list[tuple[int, int]]] = {}  # kept intervals by the 256-byte cells they touch
    for start, end, rule in sorted(found, key=lambda f: (f[2].priority, f[0] - f[1], f[0], f[2].label)):
        if not any(a <= start and end <= b for a, b in cells.get(start >> 8, ())):
            kept.append((start, end, rule))
            for cell in range(start >> 8, (end >> 8) + 1):
                cells.setdefault(cell, []).append((start, end))
    return sorted(kept, key=lambda f: (f[0], f[1], f[2].label))


def scan(text: str | None) -> dict:
    """Words, base places, resolved detections (byte spans) and score of one text."""
    data = text.encode("utf-8", "surrogatepass").lower() if text else b""
    word = _IS_WORD[np.frombuffer(data, np.uint8)]
    begins = np.flatnonzero(word & ~np.concatenate(([False], word[:-1]))) if len(word) else np.zeros(0, np.int64)
    places = [(m.start(), label) for label, key, pattern in _BASE if key in data for m in pattern.finditer(data)]
    there: dict[bytes, bool] = {}
    found = []
    for rule in rules():
        for key in rule.keywords:
            if key not in there:
                there[key] = key in data
            if not there[key]:
                break
        else:
            found += [(m.start(), m.end(), rule) for m in rule.pattern.finditer(data)]
    kept = resolve(found)
    at = np.searchsorted(begins, [p for p, _ in places])
    base = sorted({label for _, label in places})
    confidence = [r.confidence for _, _, r in kept] + [_BASE_CONFIDENCE] * len(places)
    return {
        "n_words": len(begins), "n_base": len(places), "first_word": int(at.min()) if len(at) else None, "last_word": int(at.max()) if len(at) else None,
        "base_labels": ",".join(base), "labels": ",".join(sorted({*base, *(r.label for _, _, r in kept)})), "score": max(confidence, default=0.0),
        "spans": [{"start": a, "end": b, "label": r.label} for a, b, r in kept],
    }


_COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<start: long, end: long, label: string>>"
_ARROW = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))}


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and the columns of :func:`scan` for every row (``spans``: byte ranges of the kept detections)."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches):
            rows = [scan(t) for t in b.column("text").to_pylist()]
            arrays = [pa.array([r[c] for r in rows], kind) for c, kind in _ARROW.items()]
            yield pa.RecordBatch.from_arrays([b.column("id"), *arrays], names=["id", *_ARROW])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, {_COLUMNS}")
