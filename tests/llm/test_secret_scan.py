from __future__ import annotations

import hashlib
import random
import re
import time

import pytest
from helpers import SF, documents, edge_docs, empty_docs

from demandspark.llm import queries, secret_scan

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def plain_base(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_base_spans_of_whole_table(spark):
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    rows = queries.op1_secret_scans(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert r.n_assign == base.count("assign") and r.n_access == base.count("access") and r.n_hex == base.count("hex")
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))


def test_short_value_uses_up_its_match():
    text = 'token: "secret: abcdefghijk'  # the first match ends at "secret", too short, and is dropped
    assert [s.kind for s in secret_scan.base_spans(text)] == []
    assert plain_base(text) == ""


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ('db_pwd = "hunter2!Xq9"', "literal", "hunter2!Xq9"),
        ("client_credential: 'zK93kd02lslqX'", "literal", "zK93kd02lslqX"),
        ('config["passphrase"] = "q8Zt!kd93Pqm"', "literal", "q8Zt!kd93Pqm"),
        ('dbPassphrase: str = "q8Zt!kd93Pqm"', "literal", "q8Zt!kd93Pqm"),
        ('raw = "A1b2C3d4E5f6G7"\nmid = raw\nsigning_key = mid', "flow", "A1b2C3d4E5f6G7"),
        ("BASE=zK93kd02lslqX\nexport AUTH_CREDENTIAL=$BASE", "flow", "zK93kd02lslqX"),
    ],
)
def test_assignments(text, kind, value):
    assert [(s.kind, text[s.start : s.end]) for s in secret_scan.find(text)] == [(kind, value)]


def test_concatenated_constant():
    text = 'a = "Zx81kQ"\npassphrase = a + "9vTt2"'
    assert [(s.kind, text[s.start : s.end]) for s in secret_scan.find(text)] == [("flow", "Zx81kQ"), ("flow", "9vTt2")]


@pytest.mark.parametrize(
    "text",
    [
        'color = "A1b2C3d4E5f6G7"',
        'db_pwd = "example-password"',
        "credential_file = '/etc/secrets/A1b2C3d4'",
        'pwd_hint = "A1b2C3d4E5f6G7"',
        'passphrase = "the quick brown fox"',
        "if passphrase == x: pass",
        'pin = "1234"',
    ],
)
def test_harmless(text):
    assert secret_scan.find(text) == []


def test_last_value_counts():
    text = 'a = "A1b2C3d4E5f6G7"\na = "plain words"\npassphrase = a'
    assert secret_scan.find(text) == []


def expanded(text):
    """The spans of assignments with every constant written out."""
    known, told, out = {}, set(), []
    for name, terms in secret_scan.assignments(text):
        pieces, direct = [], True
        for value, a, b, quoted in terms:
            source = known.get(value.lstrip("$")) if not quoted and secret_scan.NAME.match(value) else None
            direct &= source is None
            pieces += [(value, a, b)] if source is None else source
        known[name] = pieces
        score = secret_scan.name_score(name) * secret_scan.Traits.of("".join(p[0] for p in pieces)).score()
        for _, a, b in pieces if score >= secret_scan.THRESHOLD else ():
            if (a, b) not in told:
                told.add((a, b))
                out.append((a, b, "literal" if direct else "flow", round(score, 6)))
    return sorted(out)


def test_shared_constants_equal_written_out_ones():
    rng = random.Random(4)
    names = ["a", "b", "c", "auth_token_value", "pwd", "passphrase"]
    for _ in range(400):
        lines = []
        for _ in range(rng.randint(1, 9)):
            terms = []
            for _ in range(rng.randint(1, 3)):
                literal = "".join(rng.choice("abCD12!xample:/ ") for _ in range(rng.randint(0, 9)))
                terms.append(rng.choice([rng.choice(names), f'"{literal}"']))
            lines.append(f"{rng.choice(names)} = {' + '.join(terms)}")
        text = "\n".join(lines)
        assert sorted((s.start, s.end, s.kind, s.score) for s in secret_scan.assigned_spans(text)) == expanded(text), text


def test_doubled_constants_and_long_texts_cost_their_length():
    started = time.monotonic()
    for n in (28, 40, 3000):
        text = "a = 'q1W'\n" + "a = a + a\n" * n + "passphrase = a"
        assert [(s.kind, text[s.start : s.end]) for s in secret_scan.find(text)] == []  # three characters, whatever the length
    text = "a = 'q1W!z9Kd'\n" + "a = a + a\n" * 40 + "passphrase = a"
    assert [(s.kind, text[s.start : s.end]) for s in secret_scan.find(text)] == [("flow", "q1W!z9Kd")]
    chain = "pwd = 'q1W!z9Kd'\n" + "".join(f"pwd = pwd + 'x{i}'\n" for i in range(60_000))
    assert len(secret_scan.find(chain)) == 60_001
    keys = "".join(f'db_pwd_{i} = "q8Zt!kd{i}Pqm"\ntoken: abcdefgh{i}ZZ\n' for i in range(100_000))
    assert len(keys) > 4_500_000
    found = secret_scan.find(keys)
    assert sum(s.kind == "literal" for s in found) == 100_000 and sum(s.kind == "assign" for s in found) == 100_000
    assert time.monotonic() - started < 60


def test_edges_and_redaction(spark):
    rows = secret_scan.scan(edge_docs(spark)).collect()
    assert len(rows) == edge_docs(spark).count()
    assert secret_scan.scan(empty_docs(spark)).count() == 0
    clean = secret_scan.redact(edge_docs(spark))
    assert clean.columns == edge_docs(spark).columns
    found = {r.doc_id: r.text for r in clean.collect()}
    assert found[0] is None and found[1] == ""
    assert found[13] == 'password = "<secret>" token: short secret="${X}" key <secret>'
    assert found[6] == {r.doc_id: r.text for r in edge_docs(spark).collect()}[6]
