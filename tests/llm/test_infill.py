"""Fill-in-the-middle against a plain reading of the rules."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import infill, queries

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def by_rule(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, None)))
    spm = h[3] % 100 < 80
    return doc_id, len(units), "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(8)
    shared = ["".join(rng.choice("ab é中\n\t😀") for _ in range(3000)) for _ in range(4)]
    made = [None, "", " ", "\n\n", "a", " a", "a ", "<P>", "a <S", "x <M> y", "\x0b\x0c\r\x1c\x85 z", "<P", "<" * 300, " " * 20_000, "a" * 20_000, "é" * 9000, "a " * 9000]
    for _ in range(120):
        cut = rng.choice(shared)
        made.append("".join(rng.choice("xy zß\n") for _ in range(rng.randint(0, 900))) + cut[rng.randint(0, 999) :] + rng.choice(["", " ", "<", "<S"]))
    return made


@pytest.mark.parametrize("block", [97, infill.BLOCK])
def test_chunks_join_to_the_text_and_end_with_characters(monkeypatch, block):
    monkeypatch.setattr(infill, "BLOCK", block)
    for text in texts():
        data = (text or "").encode()
        chunks = list(infill.chunked(data, 0, len(data), infill.breaks(np.frombuffer(data, np.uint8)).tolist()))
        assert b"".join(chunks) == data and all(c.decode() and len(c) <= infill.MOST for c in chunks)


def test_shared_passages_share_chunks():
    rng = random.Random(1)
    passage = "".join(rng.choice("abcdef ") for _ in range(20_000)).encode()
    kept = infill.Chunks()
    for lead in (b"", b"one", b"another beginning of some length "):
        data = lead + passage
        infill.Units(infill.chunked(data, 0, len(data), infill.breaks(np.frombuffer(data, np.uint8)).tolist()), kept)
    assert kept.held < 1.2 * len(passage)  # three times the passage, kept about once
    small = infill.Chunks(most=1000)
    infill.Units(infill.chunked(passage, 0, len(passage), []), small)
    assert small.held <= 1000 + infill.MOST


def test_every_cut_of_a_text():
    kept = infill.Chunks()
    for text in texts():
        text = (text or "")[:4000]
        data = text.encode()
        units, want = infill.Units(infill.chunked(data, 0, len(data), infill.breaks(np.frombuffer(data, np.uint8)).tolist()), kept), UNIT.findall(text)
        assert units.n == len(want)
        for k in {0, 1, 2, len(want) // 2, len(want) - 1, len(want)} & set(range(len(want) + 1)):
            begin = "".join(want[:k])
            assert units.cut(k) == (len(begin.encode()), len(begin))


def test_texts_are_those_of_the_rule_and_come_back(documents):
    rows = list(enumerate(texts())) + [(None, "no id here at all"), (5, "again"), (5, "again"), (-3, "minus three is an id too")]
    got = infill.infilled(documents(*rows)).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(r)[:-1] for r in got), key=repr) == sorted((by_rule(*r) for r in rows), key=repr)
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert infill.infilled(documents()).collect() == []


def test_a_very_long_text(documents):
    text = "ab " * 3_000_000 + "é" * 1_000_000 + " " * 1_000_000
    got = infill.infilled(documents(*[(i, text) for i in range(3)])).withColumn("same", infill.restored(F.col("output"), F.col("form")) == text).collect()
    assert all(r.same and r.n == 3_000_002 for r in got)


def test_the_query_gives_what_its_sql_gives(spark):
    folder = "/root/testdata/sf0.001"
    got = queries.op11_chunked_infill(spark, folder)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = connection.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.oracle_sql()['op11_chunked_infill']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
