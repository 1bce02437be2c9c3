import hashlib
import random
import re

import pytest

from docsheaf.llm import credentials as cr

PATTERNS = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 24),
]


def base_spans(text):
    found = []
    for k, (kind, pattern, good) in enumerate(PATTERNS):
        flags = re.ASCII | (re.IGNORECASE if kind == "assign" else 0)
        found += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text, flags) if good(m)]
    return [span for _, _, span in sorted(found)]


def test_random_texts(table):
    rnd = random.Random(5)
    pieces = ["password", "Token", "api_key", "API" , "KEY", "=", ":", " ", '"', "'", "abcdef12", "é", "😀", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "\n", "x", "ſecret"]
    rows = [(k, "".join(rnd.choices(pieces, k=rnd.randint(0, 14)))) for k in range(800)]
    texts = dict(rows)
    for r in cr.digest(cr.find_secrets(table(rows))).collect():
        spans = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), texts[r.doc_id]
        assert [s for s in r.spans.split(",") if s and not s.startswith("literal")] == spans


@pytest.mark.parametrize(
    "text, literals",
    [
        ('x = "a8F3kd92LmQ0zz"\ndb_password = x\n', ["a8F3kd92LmQ0zz"]),
        ('a=b\nb=c\nc="Q9fkwoe8Xmz2"\nmy_pwd = a', ["Q9fkwoe8Xmz2"]),
        ('AUTH = pre + "Zk39fjQ02mxP"', ["Zk39fjQ02mxP"]),
        ('{"privateKey": "Zk39fjQ02mxP", "name": "Zk39fjQ02mxQ"}', ["Zk39fjQ02mxP"]),
        ('a = b\nb = a\npwd = a', []),
        ('pwd = "changeme123"', []),
        ('see https://host/path?x=1 and note: nothing here', []),
        ('pwd == "Zk39fjQ02mxP"', []),
        ('colour = "Zk39fjQ02mxP"', []),
    ],
)
def test_assigned_literals(text, literals):
    found = [s for s in cr.secrets_of(text) if s["kind"] == "literal"]
    assert [text[s["start"] : s["end"]] for s in found] == literals


def test_odd_rows(odd, odd_extra, empty):
    found = cr.digest(cr.find_secrets(odd)).collect()
    assert len(found) == 9 and sum(r.n_assign for r in found) == 1
    assert cr.digest(cr.find_secrets(odd_extra)).count() == 9
    assert cr.digest(cr.find_secrets(empty)).collect() == []
    mixed = "".join(f"{chr(65 + k % 26)}{k}" for k in range(20_000))
    long = f'pwd = "{mixed}"\n' + "'" * 20_000 + "= :" * 20_000
    assert cr.secrets_of(long)


def test_arrows_assign_literals():
    def found(text):
        return [text[a:b] for a, b, _, score in cr.scored_literals(text) if score >= cr.LEAST_SCORE]

    for text in ("'password' => 'Zk39fjQ02mxP'", 'api_key=>"Zk39fjQ02mxP",', "$a = ['db' => 1, 'secret' => 'Zk39fjQ02mxP'];"):
        assert found(text) == ["Zk39fjQ02mxP"]
    assert found("password => password.length") == found("token => { return 'Zk39fjQ02mxP' }") == found("x => 'Zk39fjQ02mxP'") == []
