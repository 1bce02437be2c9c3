import random
import re
from collections import defaultdict

import pytest

from docsheaf.llm import line_runs as lr

WORD = re.compile(r"[^ \t-\r]+")


def brute(rows, least):
    """Delete each run with an earlier copy, by comparing all places."""
    keys = sorted({(doc is not None, doc or 0, text or "") for doc, text in rows})
    # documents with equal identifiers are ordered by a hash; the tests have none that differ
    lines = [[(k, line, len(WORD.findall(line))) for k, line in enumerate(t.split("\n")) if WORD.search(line)] for _, _, t in keys]
    where = defaultdict(list)
    for d, own in enumerate(lines):
        for k, (_, line, _) in enumerate(own):
            where[line].append((d, k))
    out = {}
    for d, own in enumerate(lines):
        gone = set()
        for k in range(len(own)):
            longest = 0
            for e, j in where[own[k][1]]:
                if (e, j) >= (d, k):
                    break
                n = 0
                while k + n < len(own) and j + n < len(lines[e]) and own[k + n][1] == lines[e][j + n][1]:
                    n += 1
                longest = max(longest, n)
            if sum(x[2] for x in own[k : k + longest]) >= least:
                gone |= {x[0] for x in own[k : k + longest]}
        has, doc, text = keys[d]
        kept = "\n".join(line for k, line in enumerate(text.split("\n")) if k not in gone)
        out[doc if has else None, text] = (kept, len(own), len(gone))
    return out


def check(df, rows, least):
    expected = brute(rows, least)
    got = lr.without_repeated_runs(df, least).select("row.doc_id", "row.text", "text", "n_lines", "n_removed").collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[2:]) == expected[r[0], r[1] or ""]


@pytest.mark.parametrize("least", [1, 3, 7])
def test_random_lines(table, least):
    rnd = random.Random(least)
    lines = ["a", "b", "a b", "c d e", "", " ", "é f", "x y z w"]
    rows = [(k, "\n".join(rnd.choices(lines, k=rnd.randint(0, 25)))) for k in range(60)]
    check(table(rows), rows, least)


def test_a_run_inside_a_run_of_one_line(table):
    rows = [(1, "\n".join(["a b"] * 30)), (2, "\n".join(["a b"] * 40 + ["c"]))]
    check(table(rows), rows, 8)


def test_odd_rows(odd, odd_extra, empty):
    rows = [tuple(r) for r in odd.collect()]
    check(odd, rows, 5)
    found = lr.without_repeated_runs(odd_extra, 5)
    assert found.select("row.*").columns == odd_extra.columns and found.count() == 9
    assert lr.without_repeated_runs(empty, 5).collect() == []
