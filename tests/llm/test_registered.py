"""The registered opN_ queries and the pipeline on the smallest data set, against plain readings of their contracts."""

import hashlib
import json
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from starloom.llm import decontam, langid, queries
from verify_queries import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents_given(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def run(spark, name):
    return contract.queries()[name](spark, SF).collect()


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_sql(spark, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    assert compare(spark, connection, name, SF).endswith(" ok")


def test_all_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.queries())
    assert numbers == list(range(1, 14)) and "pipeline" in contract.queries()


def test_op1(spark):
    rows = [r for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r.embedding and np.isfinite(np.array(r.embedding, float)).all() and any(r.embedding)]
    points, ids = np.array([r.embedding for r in rows], dtype=np.float64), np.array([r.vec_id for r in rows])
    got = defaultdict(list)
    for r in sorted(run(spark, "op1_adaptive_scan"), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.score, r.vec_id))
    assert set(got) == {i for i in ids.tolist() if i % 100 == 0}
    hits = total = 0
    for q, found in got.items():
        far = np.sqrt(((points - points[ids == q][0]) ** 2).sum(axis=1))
        order = [k for k in np.lexsort((ids, far)).tolist() if ids[k] != q][:10]
        want = {int(ids[k]) for k in order}
        hits, total = hits + len(want & {i for _, i in found}), total + len(want)
        assert found == sorted(found) and all(abs(s - far[ids == i][0]) < 1e-12 for s, i in found)
    assert hits >= 0.9 * total


def pieces_hold(pieces, documents_given, end):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    of, filled = defaultdict(list), {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        of[p.doc_id].append(p)
    assert set(of) == set(documents_given)
    for doc_id, own in of.items():
        ids = np.array([*library.encode(documents_given[doc_id].text or "", add_special_tokens=False).ids, end], dtype="<u4")
        assert [p.start for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))] and sum(p.length for p in own) == len(ids)
        assert all(p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) for p in own)
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled.get(p.sequence_id, 0)
        filled[p.sequence_id] = p.offset + p.length
    assert max(filled.values()) <= 1024
    return of, filled


def test_op3(spark, documents_given):
    of, filled = pieces_hold(run(spark, "op3_mixture_packing"), documents_given, 0)
    assert all(p.doc_tokens == sum(q.length for q in own) for own in of.values() for p in own)
    assert sum(n < 1024 for n in filled.values()) <= 1


def test_op12(spark, documents_given):
    of, filled = pieces_hold(run(spark, "op12_bin_completion_packing"), documents_given, 2)
    assert all([p.piece for p in own] == list(range(len(own))) and all(p.length == 1024 for p in own[1:]) for own in of.values())
    assert len(filled) <= 1.02 * sum(filled.values()) / 1024 + 1


KINDS = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda t: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda t: all(int(x) <= 255 for x in t.split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda t: luhn(re.sub("[^0-9]", "", t))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda t: 8 <= len(re.sub("[^0-9]", "", t)) <= 15),
]


def luhn(digits):
    twice = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in twice) % 10 == 0


def test_op4(spark, documents_given):
    got = {r.doc_id: r for r in run(spark, "op4_weak_supervision_pii")}
    assert set(got) == set(documents_given)
    for doc_id, doc in documents_given.items():
        spans = [(kind, m.start(), m.end()) for kind, pattern, good in KINDS for m in pattern.finditer(doc.text or "") if good(m.group())]
        r = got[doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k, *_ in KINDS]
        listed = [":".join(map(str, s)) for s in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest() and set(listed) <= set(r.spans.split(",")) | {""}


def test_op5(spark, documents_given):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in run(spark, "op5_merge_token_counts")}
    numbers = {i: len(library.encode(d.text or "", add_special_tokens=False).ids) for i, d in documents_given.items()}
    assert got == {i: (len((d.text or "").encode()), numbers[i], numbers[i] > 2048) for i, d in documents_given.items()}


def test_op6(spark, documents_given):
    got = {r.doc_id: r for r in run(spark, "op6_compression_language")}
    assert set(got) == set(documents_given)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in got.items())
    seen = [(r.lang_pred == documents_given[i].lang) for i, r in got.items() if r.held_out and documents_given[i].lang and re.search(r"[^\W\d_]", documents_given[i].text or "")]
    assert sum(seen) >= 0.95 * len(seen) > 0


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def components(texts, n, percent=80):
    """Smallest id reachable over links between all pairs."""
    sets = {i: shingles(t, n) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_op7(spark, documents_given):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in run(spark, "op7_minhash_near_dedup")}
    assert got == components({i: d.text for i, d in documents_given.items()}, 4)


def folded(text):
    return re.sub(r"[^a-z0-9\x80-\U0010ffff]+", " ", (text or "").lower()).strip()


def test_op8_finds_every_whole_item(spark, documents_given):
    items = {r.item_id: folded(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id) for r in run(spark, "op8_qgram_decontamination")}
    texts = {i: folded(d.text) for i, d in documents_given.items()}
    whole = {(i, k) for i, t in texts.items() for k, item in items.items() if len(item) >= decontam.LEAST and item in t}
    assert whole and whole <= found


def test_stages_of_the_pipeline(spark, documents_given):
    texts = {i: d.text for i, d in documents_given.items()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    shape, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == shape
        kept[name] = {r.doc_id: r for r in docs.collect()}
    # Language: what its operator rejects, and nothing else.
    learned = langid.learned_dictionaries(spark.read.parquet(f"{SF}/documents.parquet").where(~langid.held_out()))
    judged = langid.predicted(spark.read.parquet(f"{SF}/documents.parquet"), learned).collect()
    assert set(kept["language"]) == {r.doc_id for r in judged if not r.rejected}
    assert not any(re.search(r"[^\W\d_]", texts[i] or "") is None for i in kept["language"])
    # Near duplicates: one of each group of all pairs.
    groups = components({i: texts[i] for i in kept["language"]}, 5)
    assert set(kept["near_duplicates"]) == {i for i, (_, root) in groups.items() if i == root}
    # Benchmark passages: none is left whole, and what went has one or most of one.
    items = [folded(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = set(kept["near_duplicates"]) - set(kept["decontamination"])
    assert not any(item in folded(texts[i]) for i in kept["decontamination"] for item in items)
    grams = [{item[k : k + 10] for k in range(len(item) - 9)} for item in items]
    assert all(max(sum(g in folded(texts[i]) for g in some) for some in grams) >= 40 for i in gone)
    # Personal data: no base span is left, texts without any are as they were but for added kinds, n_chars follows.
    clean = 0
    for i, d in kept["personal_data"].items():
        assert not any(good(m.group()) for _, pattern, good in KINDS for m in pattern.finditer(d.text or ""))
        assert d.n_chars == len(d.text or "")
        clean += d.text == texts[i]
    assert set(kept["personal_data"]) == set(kept["decontamination"]) and clean >= 0.5 * len(kept["personal_data"])
    # Packing: all ids of what is left.
    pieces = corpus_pipeline.packed(spark, docs, SF).collect()
    pieces_hold(pieces, kept["personal_data"], 0)
    whole = sorted(map(tuple, corpus_pipeline.run(spark, SF).select(*pieces[0].__fields__).collect()), key=repr)
    assert [p[:4] for p in whole] == [p[:4] for p in sorted(map(tuple, pieces), key=repr)]


def test_stages_take_odd_tables(spark, tmp_path):
    spark.createDataFrame([(1, "an item of the benchmark that is long enough to be looked for, said twice over")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    shape = "doc_id long, text string, lang string, source string, n_chars int, id string, kept boolean, start long, component long"
    rows = [(1, None, None, None, None, "x", True, 1, 1), (2, "", "en", "s", 0, None, None, None, None), (None, "no id but words enough", None, None, 3, "", False, 0, 0)]
    rows += [(3, "the same words in every row", "en", "s", 27, "x", True, 1, 1)] * 3 + [(4, "ein anderer Satz steht hier", "de", None, 27, "y", False, 2, 2)]
    for docs in (spark.createDataFrame(rows, shape), spark.createDataFrame([], shape)):
        for _, stage in corpus_pipeline.STAGES:
            last, docs = docs, corpus_pipeline.materialize(stage(spark, docs, str(tmp_path)), "odd")
            assert docs.count() >= 0
        assert docs.columns[:2] == ["doc_id", "source"] and last.columns == [c.split()[0] for c in shape.split(", ")]


def test_nothing_but_plain_rows_is_returned(spark):
    for name in ("op9_rarest_token_url_rules", "op11_chunked_infill"):
        json.dumps([r.asDict() for r in contract.queries()[name](spark, SF).limit(3).collect()])
    assert contract.queries()["op13_lanczos_whitening"](spark, SF).where(F.col("component") > 8).isEmpty()
