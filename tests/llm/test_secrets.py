"""Secret spans against Python's regular expressions, and the ownership verdict."""

import hashlib
import re

import pytest

from wirestar.llm import secrets as m
from wirestar.sources.staging import Staging

HEX = "0123456789abcdef" * 2
ROWS = [
    (1, f'token = "{HEX}" and {HEX}ff', "a"),
    (2, f"Ü𝒯 TOKEN={HEX}; Password : hunter2 secret: abcdefghijk", "b"),
    (3, "api_key='short' apikey=longenough1 token=password=abcdefgh", "a"),
    (4, None, "a"),
    (5, "", None),
    (6, "AKIA" + "A" * 11 + " AKIA" + "B" * 12 + " xAKIAAKIAAKIAAKIA", "c"),
    (7, f"secret: secret: {HEX}", None),
    (8, "Bearer " + "Z9" * 15 + " " + "A1" * 16, "a"),
    (9, "x " * 50_000 + f"passwd=abcdefgh1 {HEX} " * 60, "c"),
    (9, "Bearer " + "Z9" * 15, "a"),
    (11, "Bearer " + "Q7" * 15, "a"), (12, "Bearer " + "Q7" * 15, "b"), (13, "Bearer " + "Q7" * 15, "c"),
]
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)


def base(text):
    text = text or ""
    found = [(x.start(), 0, x.end()) for x in ASSIGN.finditer(text) if len(x[2]) >= 8]
    found += [(x.start(), 1, x.end()) for x in re.finditer("AKIA[A-Z0-9]+", text) if len(x[0]) >= 16]
    found += [(x.start(), 2, x.end()) for x in re.finditer("[0-9a-f]+", text) if len(x[0]) >= 32]
    return sorted(found)


@pytest.fixture(scope="module")
def result(spark):
    df = spark.createDataFrame([(*r, 0) for r in ROWS], "doc_id long, text string, source string, kind int")
    with Staging(spark) as staging:
        return m.digest(m.scan(df, staging)).collect()


def test_base_spans_equal_python(result):
    want = []
    for i, text, _ in ROWS:
        found = base(text)
        line = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in found)
        counts = tuple(sum(k == n for _, k, _ in found) for n in range(3))
        want.append((i, *counts, hashlib.sha256(line.encode()).hexdigest()))
    got = [(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in result]
    assert sorted(got) == sorted(want)


def test_added_spans_are_reported_with_their_verdict(result):
    by_id = {r.doc_id: r for r in result}
    assert by_id[8].spans == "bearer:0:37,upper_hex:38:70" and by_id[8].n_live == 2
    # Copies of one text are one owner, so their value is no example.
    assert [(by_id[i].spans, by_id[i].n_live) for i in (11, 12, 13)] == [("bearer:0:37", 1)] * 3


def test_copied_value_is_an_example(result):
    by_id = {r.doc_id: r for r in result}
    assert by_id[1].most_owners == 4 and by_id[1].n_example == 2  # a, b, c and none
    assert by_id[2].n_live == 1  # the secret that only b has


def test_empty_table(spark, staging):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert m.digest(m.scan(empty, staging)).count() == 0


def test_masking_live_secrets(spark, staging):
    df = spark.createDataFrame([(*r, 0) for r in ROWS], "doc_id long, text string, source string, kind int")
    rows = m.mask_live(df, staging)
    assert rows.columns == df.columns
    by_id = {r.doc_id: r.text for r in rows.collect() if r.doc_id != 9}
    assert rows.count() == len(ROWS)
    assert by_id[1] == f'token = "{HEX}" and [SECRET]' and by_id[4] is None and by_id[5] == ""  # an example stays
    assert by_id[2] == f"Ü𝒯 TOKEN={HEX}; Password : hunter2 [SECRET]"
    assert by_id[6] == "AKIAAAAAAAAAAAA [SECRET] x[SECRET]"
    assert by_id[8] == "[SECRET] [SECRET]"


def test_copies_of_one_text_are_one_owner(spark, staging):
    value = "Bearer " + "Q7" * 15
    rows = [(i, "Use  " + value if i % 2 else "use " + value, "abc"[i % 3]) for i in range(30)]
    shown = "Bearer " + "R8" * 15
    rows += [(100 + i, f"{i}: {shown}", "abc"[i]) for i in range(3)]  # three texts, three owners
    rows += [(200, f"own {shown[7:]}", "a"), (201, "x " + "A1" * 16, "a"), (202, "y " + "A1" * 16, "a"), (203, "z " + "A1" * 16, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    by_id = {r.doc_id: r for r in m.digest(m.scan(df, staging)).collect()}
    assert all((r.n_live, r.n_example, r.most_owners) == (1, 0, 1) for i, r in by_id.items() if i < 30)
    assert by_id[0].spans == "bearer:4:41" and by_id[1].spans == "bearer:5:42"
    assert [(by_id[i].spans, by_id[i].n_live, by_id[i].n_example) for i in (100, 101, 102)] == [("bearer:3:40", 0, 1)] * 3
    assert (by_id[203].n_live, by_id[203].most_owners) == (1, 2)
    texts = {r.doc_id: r.text for r in m.mask_live(df, staging).collect()}
    assert texts[0] == "use [SECRET]" and texts[1] == "Use  [SECRET]" and texts[101] == f"1: {shown}"
