import random
import re
import re._constants as C
import re._parser as parser

from peerscore.llm import licenses as L


def plain(text):
    """Base places by walking the word list."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = [(k, label) for phrase, label in L.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    places = [k for k, _ in at]
    return len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))


def test_base_equals_the_word_walk():
    r = random.Random(1)
    parts = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "été", "x1", "İ", "K"]
    for _ in range(500):
        text = "".join(r.choice(parts).title() + r.choice([" ", "  ", "\n", "-", ".", "", "_", "’"]) for _ in range(r.randint(0, 25)))
        got = L.scan(text)
        assert (got["n_words"], got["n_base"], got["first_word"], got["last_word"], got["base_labels"]) == plain(text), text


def test_there_are_hundreds_of_rules_and_keywords_never_hide_a_match():
    assert len(L.rules()) > 300
    samples = [
        "Licensed under CC BY-NC 4.0.", "GNU Lesser General\n# Public License v2.1", "Apache License, Version 2.0", "SPDX-License-Identifier: MPL-2.0",
        "https://creativecommons.org/licenses/by-sa/3.0/", "Released under the MIT License.", "Copyright (c) 2021 X", "placed in the public domain",
    ]
    samples += [text.replace(" ", "\n * ") for text in samples]
    for text in samples:
        data = text.encode().lower()
        for rule in L.rules():
            if rule.pattern.search(data):
                assert all(k in data for k in rule.keywords), (rule.label, text)


def alternatives(items):
    """Samples that hold every alternative and every optional part of a parsed pattern, and leave it out."""
    out = [b""]
    for op, arg in items:
        if op is C.LITERAL:
            some = [bytes([arg])]
        elif op is C.IN:
            some = [bytes([v if o is C.LITERAL else v[0] if o is C.RANGE else 32]) for o, v in arg][:3]
        elif op is C.BRANCH:
            some = [x for branch in arg[1] for x in alternatives(branch)]
        elif op is C.SUBPATTERN:
            some = alternatives(arg[3])
        elif op is C.MAX_REPEAT:
            some = [b""] * (arg[0] == 0) + alternatives(arg[2])
        else:
            assert op in (C.ANY, C.ASSERT, C.ASSERT_NOT)
            some = [b"x" if op is C.ANY else b""]
        out = [a + b for a in out for b in some][:3000]
    return out


def test_keywords_hide_no_alternative_of_any_rule():
    for rule in L.rules():
        samples = [t for t in alternatives(parser.parse(rule.pattern.pattern, rule.pattern.flags)) if rule.pattern.search(t)]
        assert samples
        for t in samples:
            assert all(k in t for k in rule.keywords), (rule.label, t)
    assert L.scan("WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND")["labels"] == "warranty"
    assert L.scan("Released under the Expat License")["labels"] == L.scan("X11 License")["labels"] == "mit"


def test_priority_and_containment():
    assert L.scan("Licensed under CC BY-NC 4.0.")["labels"] == "cc-by,cc-by-nc-4.0"
    assert L.scan("the GNU Lesser General Public License v2.1")["labels"] == "gpl,lgpl-2.1"
    assert L.scan("GNU General Public License, version 3.")["labels"] == "gpl,gpl-3.0"
    assert L.scan("Apache License, Version 2.0 and the MIT License")["labels"] == "apache-2.0,mit"
    assert L.scan("permitted apaches")["labels"] == ""
    found = L.scan("SPDX-License-Identifier: GPL-2.0-or-later")["spans"]
    assert [s["label"] for s in found] == ["gpl-2.0"]


def quadratic(found):
    kept = []
    for s, e, rule in sorted(found, key=lambda f: (f[2].priority, f[0] - f[1], f[0], f[2].label)):
        if not any(a <= s and e <= b for a, b, _ in kept):
            kept.append((s, e, rule))
    return sorted(kept, key=lambda f: (f[0], f[1], f[2].label))


def test_resolution_equals_comparing_all_pairs():
    r, some = random.Random(3), random.Random(4).sample(L.rules(), 12)
    for _ in range(100):
        found = []
        for _ in range(60):
            a = r.randint(0, 3000)
            found.append((a, a + r.randint(1, 700), r.choice(some)))
        assert L.resolve(found) == quadratic(found)


def test_documents(make_docs, prose):
    rows = [(1, None), (2, ""), (3, "All rights reserved. All rights reserved."), (3, "x"), (None, "cc by"), (4, prose(1, 20000) + " MIT License"), (5, "\x00\x7f ..")]
    got = {(r["id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["labels"], r["score"]) for r in L.scan_documents(make_docs(rows)).collect()}
    assert got == {
        (1, 0, 0, None, None, "", 0.0), (2, 0, 0, None, None, "", 0.0), (3, 6, 2, 0, 3, "reserved", 0.6), (3, 1, 0, None, None, "", 0.0),
        (None, 2, 1, 0, 0, "cc-by", 0.85), (4, 20002, 0, None, None, "mit", 0.85), (5, 0, 0, None, None, "", 0.0),
    }
    assert L.scan_documents(make_docs([])).count() == 0
