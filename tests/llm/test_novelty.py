import hashlib
import random
import re
import string

import pytest

from peerscore.llm import novelty
from peerscore.llm.novelty import NOVEL, Novelty, identifier_dictionary, scan_documents, secret_spans
from peerscore.llm.queries import op12_secret_scan


def plain_base(text):
    """The base patterns as the contract writes them."""
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


@pytest.fixture()
def known(prose):
    return Novelty(" ".join(sorted(set(prose(1, 3000).split()))).encode())


def spans(text, known, **kind):
    return secret_spans(text, known, **({"min_bytes": 16, "min_share": 1.06} | kind))


def random_string(seed, n):
    r = random.Random(seed)
    return "".join(r.choice(string.ascii_letters + string.digits) for _ in range(n))


def test_base_spans_equal_the_contract(known):
    r = random.Random(5)
    pieces = ["password", "TOKEN", "api_key", "apikey", "Secret", "passwd", "=", ":", " ", "  ", '"', "'", "abc", "x" * 9, "AKIA", "AKIA" + "Z9" * 8,
              "deadbeef" * 3, "0123456789abcdef", "\n", "é", "ſecret=", "toKen=", "token=token: abcdefg", "a=b/c+d.e-f_"]
    for _ in range(3000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 14)))
        assert [s[:3] for s in spans(text, known) if s[0] != NOVEL] == plain_base(text), text


def test_random_strings_in_a_sensitive_context_are_novel_and_words_are_not(known, prose):
    caught = 0
    for k in range(60):
        secret = random_string(k, 16 + k % 30)
        text = f"{prose(k, 120)}\nthe client secret of the account is {secret}\n{prose(k + 1, 120)}"
        at = text.index(secret)
        caught += (NOVEL, at, at + len(secret)) in [s[:3] for s in spans(text, known)]
    assert caught >= 57
    for k in range(60):
        text = f"{prose(k, 120)} the credential of {prose(k + 200, 30)} and the token of session 2024-05-06T10:11:12 {'xy' * 20}"
        assert not spans(text, known), text


def test_novelty_is_measured_against_text_and_dictionary(known, prose):
    before, secret = prose(3, 60), random_string(1, 32)

    def added(measure, text):
        return measure.added(text, len(text) - 32, len(text))

    first = added(known, before + secret)
    assert first >= 32  # nothing known helps
    assert added(known, f"{before}{secret} {before[:100]}{secret}") < first / 3  # the surrounding text holds it
    assert added(Novelty(secret.encode()), secret) < added(Novelty(b""), secret) / 2  # the dictionary holds it


def test_strings_outside_a_sensitive_context_are_left(known, prose):
    assert not spans(f"{prose(1, 50)} {random_string(2, 32)} {prose(2, 50)}", known)
    far = f"the bearer {'word ' * 40}{random_string(2, 32)}"
    assert not spans(far, known)


def test_candidates_are_taken_whole_and_once(known):
    secret = random_string(9, 3000)
    text = f"token token secret {secret} end"
    got = spans(text, known)
    assert [(s[1], s[2]) for s in got] == [(19, 3019)]
    for n in (70, 100, 200, 400):
        assert spans(f"my credential {random_string(n, n)}", known)
        assert not spans(f"my credential {'_'.join(['session', 'identifier', 'of', 'the', 'client'] * n)[:n]}", known)


def test_a_novel_span_does_not_touch_a_base_span(known):
    for k in range(40):
        text = f'secret key "{random_string(k, 20)}" token = "{random_string(k + 50, 30)}" {"0f" * 12}{random_string(k, 16)}'
        got = spans(text, known)
        base = [s for s in got if s[0] != NOVEL]
        assert [s[:3] for s in base] == plain_base(text)
        assert all(s[2] <= b[1] or b[2] <= s[1] for s in got if s[0] == NOVEL for b in base)


def test_the_dictionary_counts_every_row(spark, make_docs, monkeypatch):
    monkeypatch.setattr(novelty, "HELD_WORDS", 3)
    rows = [(i, "alpha beta_1 alpha" if i % 2 else "gamma beta_1 xy 12345") for i in range(50)] + [(99, None), (100, "")]
    assert identifier_dictionary(make_docs(rows), words=3) == b"gamma beta_1 alpha"
    assert identifier_dictionary(make_docs([])) == b""
    scanned = scan_documents(make_docs([(1, "token = abcdef99")]), b"")
    assert [tuple(s) for s in scanned.first()["spans"]] == [("assign", 0, 16, None)]


def test_odd_rows(spark, make_docs):
    rows = [(1, None), (2, ""), (None, "password: hunter22"), (4, "password: hunter22"), (4, "password: hunter22"), (5, "ü😀 token=1234567 " * 3)]
    got = scan_documents(make_docs(rows), b"some words").collect()
    by_id = sorted(((r["id"] or 0, [tuple(s)[:3] for s in r["spans"]]) for r in got))
    assert by_id == [(0, [("assign", 0, 18)]), (1, []), (2, []), (4, [("assign", 0, 18)]), (4, [("assign", 0, 18)]),
                     (5, [("assign", 3, 16), ("assign", 20, 33), ("assign", 37, 50)])]
    assert scan_documents(make_docs([]), b"").count() == 0


def test_query_writes_the_spans(spark, make_docs, prose, tmp_path):
    secret = random_string(4, 40)
    rows = [(i, f"{prose(i, 80)} token = 'abc{i}def' {'0a' * 13} AKIA{'Q' * 16} {prose(i, 20)} bearer {secret} x") for i in range(30)] + [(50, None)]
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in op12_secret_scan(spark, str(tmp_path)).collect()}
    for i, text in rows:
        base = plain_base(text or "")
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        r = got[i]
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == kind for k, _, _ in base) for kind in ("assign", "access", "hex")]
        added = [f"novel:{text.index(secret)}:{text.index(secret) + 40}"] if text else []
        assert r["spans"] == ",".join([*([line] if line else []), *added])
