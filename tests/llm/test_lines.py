import hashlib
import re
import string
from collections import defaultdict

import pytest
from corpus_fixtures import edge_docs, no_docs, sf  # noqa: F401
from regpanel.llm import op12_lines as ln

SHARED = "All rights reserved by the owners of this fine page."
ASCII_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows, least_chars=40, least_docs=5):
    """Result per row by plain Python over all rows: (doc_id, kept text, lines, dropped)."""
    split = [(i, (t or "").split("\n")) for i, t in rows]
    keyed = lambda line: re.sub(r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line).translate(ASCII_LOWER)
    holders = defaultdict(set)
    for i, lines in split:
        for line in lines:
            if len(keyed(line)) >= least_chars:
                holders[keyed(line)].add(i)
    keep = {k: max((i for i in h if i is not None), default=None) for k, h in holders.items() if len(h) >= least_docs}
    out = []
    for i, lines in split:
        stays = [line for line in lines if keep.get(keyed(line), i) == i]
        out.append((i, "\n".join(stays), len(lines), len(lines) - len(stays)))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def check(spark, rows, **settings):
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, line_key string").repartition(5)
    got = [tuple(r) for r in ln.dedup_lines(df, **settings).select("doc_id", "text", "n_lines", "n_dropped").collect()]
    assert ordered(got) == ordered(brute(rows, **settings))
    return got


def test_shared_lines_stay_in_the_largest_id(spark):
    rows = [(i, f"own line {i}\n  {SHARED.upper()}\t\nend {i}") for i in range(5)] + [(9, SHARED + "\n\n" + SHARED)]
    rows += [(i, SHARED.replace("fine", "nice")) for i in range(20, 24)]
    got = {r[0]: r for r in check(spark, rows)}
    assert got[9][1:] == (SHARED + "\n\n" + SHARED, 3, 0) and got[0][1:] == ("own line 0\nend 0", 3, 1) and got[20][3] == 0


def test_white_space_and_case_by_code_point(spark):
    # Only ASCII blanks are stripped, and only A-Z lower-cased; other line ends split nothing.
    base = "É" * 39
    rows = [(i, f"\x0b\x0c{base}A\r") for i in range(5)] + [(i, f" {base}a") for i in range(5, 8)]
    rows += [(i, f"{base} ") for i in range(10, 16)] + [(i, f"{base}  ") for i in range(20, 27)] + [(i, f"{base}   ") for i in range(30, 37)]
    rows += [(40, f"\x85 {base}xyz \x85")] + [(i, "é" * 40 if i % 2 else "É" * 40) for i in range(50, 58)]
    check(spark, rows)


def test_edge_rows(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = [tuple(r) for r in ln.dedup_lines(edge_docs).select("doc_id", "text", "n_lines", "n_dropped").collect()]
    assert ordered(got) == ordered(brute(rows)) and ln.dedup_lines(no_docs).collect() == []
    # Repeated ids are one document; rows without an id are one, and the least; a text may lose all lines.
    rows = [(1, SHARED)] * 7 + [(2, SHARED), (2, "x\n" + SHARED), (None, SHARED), (None, SHARED + "\n"), (None, None), (3, ""), (4, "\n"), (5, SHARED)]
    assert ordered(check(spark, rows)) == ordered(r for r in brute(rows))
    dropped = {r[0]: r for r in check(spark, [*rows, (6, SHARED)])}
    assert dropped[1] == (1, "", 1, 1) and dropped[6] == (6, SHARED, 1, 0)


@pytest.mark.parametrize("share", [3, 10_000])
def test_hot_lines_either_way(spark, monkeypatch, share):
    monkeypatch.setattr(ln, "HOT_SHARE", share)
    rows = [(i, "\n".join([SHARED] * (1 + i % 3) + [f"{i % 7} " + SHARED, f"own text of the document {i}, which nobody else has at all"])) for i in range(60)]
    check(spark, rows)
    check(spark, rows, least_chars=60, least_docs=3)


def test_a_long_text_with_many_shared_lines(spark):
    body = "\n".join(f"line number {i} of a body that is shared by all of them" for i in range(3000))
    check(spark, [(i, f"{body}\nown {i}") for i in range(6)])


def test_digests_and_plan(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = ln.line_digests(ln.dedup_lines(docs))
    want = {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, d in brute([(r.doc_id, r.text) for r in docs.collect()])}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in out.collect()} == want
    plan = out._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
