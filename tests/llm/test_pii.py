"""Personal data: base spans against Python's plain patterns, added kinds, masking."""

import random
import re

import pytest
from pyspark.sql import functions as F

from starloom.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def plain(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def made():
    rng = random.Random(8)
    pieces = [
        "a.b@c.de", "x@y", "@", "a@b.c.@d.e", "a@b.co_x@y.com", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.1.1", "007.0.000.255", "4111 1111 1111 1111", "4111-1111-1111-1111 4",
        "4111111111111112", "6011000990139424", "12", "+1 (415) 555-2671", "+49 30 1234567890123", "++1 23", "+1--2345678", "é", "😀", "\n", " ", "  ", ".", "-", "word", "1",
        "00000000000000000000", "1.1.1.99999999999999999999999",
    ]
    texts = ["".join(rng.choice(pieces) + rng.choice(["", " ", "", "\n"]) for _ in range(rng.randint(0, 25))) for _ in range(150)]
    return [*texts, None, "", "a" * 200_000, "1." * 50_000, "4 " * 50_000, "mail a@b.de " * 2_000]


def test_base_spans_are_pythons(documents):
    rows = list(enumerate(made()))
    got = pii.found_spans(documents(*rows, (0, rows[0][1]), (None, "x@y.de"))).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        base = [(s.kind, s.start, s.end) for s in r.spans if s.base]
        assert base == (plain(rows[r.doc_id][1]) if r.doc_id is not None else [("email", 0, 6)]), r.doc_id
    assert pii.found_spans(documents()).collect() == []


def test_added_kinds_and_masks(documents):
    rows = [(i, f"Name: Maria Lopez{i}x, password=ab{i}cd9fe12345 key AKIAABCDEFGHIJ{i:02d}KLMN, mail ab{i}@c.org.") for i in range(30)]
    rows += [(100, "nothing here"), (101, None), (102, "")]
    found = {r.doc_id: {s.kind for s in r.spans} for r in pii.found_spans(documents(*rows)).collect()}
    assert all({"email", "secret"} <= found[i] for i in range(30)) and not found[100] | found[101] | found[102]
    hidden = pii.masked(documents(*rows).withColumn("proposed_spans", F.lit(4)))
    assert hidden.columns == [*documents().columns, "proposed_spans"] or set(hidden.columns) == {*documents().columns, "proposed_spans"}
    texts = {r.doc_id: r.text for r in hidden.collect()}
    assert texts[100] == "nothing here" and texts[101] is None and texts[102] == ""
    for i in range(30):
        assert "@" not in texts[i] and "AKIA" not in texts[i] and "<EMAIL>." in texts[i] and "mail" in texts[i]


def test_estimates_tell_reliable_votes():
    good, bad = (1, 1, 1, 1, 0), (-1, 0, 0, -1, -1)
    found = pii.estimated([(0, good, 500), (0, bad, 500), (0, (1, 0, 1, 1, 0), 50)])
    assert found[0, good] > 0.95 and found[0, bad] < 0.05 and found[0, (1, 0, 1, 1, 0)] > 0.8
    assert pii.estimated([]) == {} and len(pii.trained([], {})) == 1 + len(pii.KINDS) + 2 * len(pii.VOTERS) + sum(pii.TRAITS.values()) - len(pii.TRAITS)


def kinds_found(documents, texts):
    rows = pii.found_spans(documents(*enumerate(texts))).collect()
    return {r.doc_id: {(s.kind, texts[r.doc_id][s.start : s.end]) for s in r.spans} for r in rows}


def test_names_are_learned_from_what_stands_before_them(documents):
    texts = [f"As Dr. Priya Sharma{'x' * i} wrote, New York and Old Town are far away." for i in range(5)]
    texts += [f"Her name is Wei Zhang{'x' * i}. The Red House is closed." for i in range(5)]
    texts += ["Yesterday Priya Kapoor met Wei Li in New York", "Alice Cooper sings", "hundred Blue Birds", "address New Jersey", "Mr Unseen Person"]
    got = kinds_found(documents, texts)
    assert all(("person", f"Priya Sharma{'x' * i}") in got[i] and ("person", f"Wei Zhang{'x' * i}") in got[5 + i] for i in range(5))
    assert got[10] == {("person", "Priya Kapoor"), ("person", "Wei Li")} and got[11] == {("person", "Alice Cooper")}
    assert not got[12] and not got[13] and got[14] == {("person", "Unseen Person")}
    assert not any("New York" in s or "Red House" in s for spans in got.values() for _, s in spans)


def test_hashes_calls_and_part_numbers_are_no_secrets(documents):
    rng = random.Random(4)
    hex40 = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(60)]
    texts = [f'and token = "{h}" or so' for h in hex40[:20]] + [f"see commit {h} of it" for h in hex40[20:40]] + [f"sha256 checksum: {h}" for h in hex40[40:]]
    texts += ["token=function(a,b)", "if token=callback then", "part no 123-45-6789 is sold out", "her ssn 123-45-6789", "password=Xy7pq9zz"]
    got = kinds_found(documents, texts)
    assert all(got[i] == {("secret", hex40[i])} for i in range(20))
    assert not any(got[i] for i in range(20, 63)), [(texts[i], got[i]) for i in range(20, 63) if got[i]]
    assert got[63] == {("ssn", "123-45-6789")} and got[64] == {("secret", "password=Xy7pq9zz")}


def test_estimates_keep_their_classes_in_a_large_corpus():
    plain, known = (0, -1, 0, 0, 0), (0, 1, 0, 0, 0)
    found = pii.estimated([(6, plain, 5_000_000), (6, known, 40_000), (6, (0, 1, 1, 0, 0), 10_000), (6, (0, 0, 1, 0, 0), 3_000)])
    assert found[6, plain] < 0.4 and found[6, known] > 0.5 and found[6, (0, 1, 1, 0, 0)] > 0.9 and found[6, (0, 0, 1, 0, 0)] > 0.5
    commits = pii.estimated([(7, (1, 0, 1, 1, 0), 30), (7, (1, 0, 0, 1, -1), 30_000), (7, (-1, -1, 0, 1, 0), 30)])
    assert commits[7, (1, 0, 1, 1, 0)] > 0.8 and commits[7, (1, 0, 0, 1, -1)] < 0.2


@pytest.mark.xfail(strict=True, reason="known fault: where commit hashes are nearly all candidates, rare calls count as secrets (0.64)")
def test_calls_are_no_secrets_among_many_hashes():
    commits = pii.estimated([(7, (1, 0, 1, 1, 0), 30), (7, (1, 0, 0, 1, -1), 30_000), (7, (-1, -1, 0, 1, 0), 30)])
    assert commits[7, (-1, -1, 0, 1, 0)] < 0.2
