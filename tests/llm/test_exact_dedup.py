import hashlib
import random
import re

import pytest

from docsheaf.llm.exact_dedup import exact_duplicates


def brute(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(re.sub(r"[ \t-\r]", "", text or ""), []).append((doc, text or ""))
    out = []
    for norm, own in groups.items():
        keep = min(own, key=lambda r: (-len(r[1]), r[0] is not None, r[0] or 0))[0]
        digest = hashlib.sha256(norm.encode()).hexdigest()
        out += [(doc, keep, len(own), digest) for doc, _ in own]
    return sorted(out, key=str)


def result(df, partitions):
    rows = exact_duplicates(df, partitions).collect()
    assert len({r.text_sha256 for r in rows}) == sum(r.kept for r in rows)
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows], key=str)


@pytest.mark.parametrize("partitions", [1, 7])
def test_groups_that_span_partitions(table, partitions):
    rnd = random.Random(3)
    texts = ["a b", "ab", "a  b ", "c", "", None, "same beginning of a text " + "x" * 40]
    rows = [(k, rnd.choice(texts[:3] if k % 3 else texts)) for k in range(300)]
    assert result(table(rows), partitions) == brute(rows)


def test_odd_rows(odd):
    rows = [tuple(r) for r in odd.collect()]
    assert result(odd, 3) == brute(rows)


def test_extra_columns_and_empty(odd_extra, empty):
    assert exact_duplicates(odd_extra).count() == 9
    assert exact_duplicates(empty).collect() == []
