"""Bin completion against the best packing of small sets, and packing as a round trip."""

import random
import signal

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starloom.llm import bestfit, completion

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def least_bins(items, size):
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins) if b + items[i] <= size}.values():
            bins[k] += items[i]
            place(i + 1, bins)
            bins[k] -= items[i]
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best[0]


def check(solution, counts, size):
    held = np.zeros(size + 1, dtype=np.int64)
    for bins, lengths in solution.patterns:
        assert bins > 0 and 0 < sum(lengths) <= size
        for length in lengths:
            held[length] += bins
    assert (held == counts).all() and solution.bins == sum(bins for bins, _ in solution.patterns) >= solution.bound


def test_small_sets_are_packed_best():
    rng, better = random.Random(6), 0
    for trial in range(150):
        size = rng.choice([10, 20, 30, 50])
        low, high = (1, size) if trial % 3 == 0 else (size // 5, size // 2 + 1)
        items = [rng.randint(low, high) for _ in range(rng.randint(1, 12))]
        counts = np.bincount(items, minlength=size + 1)
        solution = completion.completed(counts, size, nodes=10**6)
        check(solution, counts, size)
        assert solution.bins == least_bins(items, size), items
        better += solution.bins < sum(n for n, _ in completion.best_fit(counts, size))
    assert better  # some of them are beyond best fit


def test_undominated_fillings_are_all_there():
    rng = random.Random(3)

    def all_fillings(counts, room, upto):
        yield ()
        for length in range(min(upto, room), 0, -1):
            if counts[length]:
                counts[length] -= 1
                yield from ((length, *rest) for rest in all_fillings(counts, room - length, length))
                counts[length] += 1

    def holds(larger, smaller):
        """Whether the smaller's lengths fit into the larger's, as into bins."""
        if not smaller:
            return True
        return any(holds([*larger[:k], room - smaller[0], *larger[k + 1 :]], smaller[1:]) for k, room in enumerate(larger) if room >= smaller[0])

    for _ in range(40):
        room, counts = rng.randint(5, 16), np.array([0, *(rng.choice([0, 0, 1, 2]) for _ in range(16))])
        got = [f for _, f in completion.fillings(counts, room, room)]
        assert len(got) == len(set(got))
        for filling in set(all_fillings(counts.copy(), room, 16)):
            assert any(holds(list(one), list(filling)) for one in got) or not got and not filling


@pytest.fixture
def seconds():
    """Ends what takes longer."""

    def late(*_):
        raise TimeoutError

    before = signal.signal(signal.SIGALRM, late)
    yield signal.alarm
    signal.alarm(0)
    signal.signal(signal.SIGALRM, before)


def test_many_lengths_are_not_all_gone_through(seconds):
    counts = np.array([0, *[5] * 600])
    seconds(20)
    assert list(completion.fillings(counts, 600, 0)) == [(0, (600,))]
    counts[1:41] = 0  # without short lengths some waste can be had, too
    assert [f for f in completion.fillings(counts, 600, 40) if len(f[1]) == 1] == [(0, (600,))]


@pytest.mark.parametrize("n, times", [(0, 1), (1, 1000), (7, 1000), (5000, 1), (5000, 1000)])
def test_large_counts_lose_nothing(n, times):
    rng = np.random.default_rng(n)
    counts = np.bincount(rng.integers(1, 1025, n), minlength=1025) * times
    solution = completion.completed(counts, 1024, nodes=300)
    check(solution, counts, 1024)
    assert solution.bins <= sum(b for b, _ in completion.best_fit(counts, 1024))
    if n >= 5000:  # many lengths leave little waste; of a few lengths the bound says less
        assert solution.bins - solution.bound <= 0.01 * solution.bound


def test_bound_is_never_above_the_best():
    rng = random.Random(2)
    for _ in range(200):
        items = [rng.randint(1, 20) for _ in range(rng.randint(1, 9))]
        assert completion.lower_bound(np.bincount(items, minlength=21), 20) <= least_bins(items, 20)


ODD = [None, "", " ", "a", " " * 5000, "word " * 1023, "word " * 1022 + "word", "word " * 5000, "x<|endoftext|>y", "é\U0001f600" * 700, "a\x00b"]


def test_pieces_hold_every_document_and_sequences_have_no_gaps(spark):
    rng, library = random.Random(5), Tokenizer.from_file(BYTES)
    texts = [*ODD, *("".join(rng.choice(["word ", "or ", "ünd ", "\n"]) for _ in range(rng.randint(0, 2500))) for _ in range(150))]
    rows = [(i, t, 1, 2, "x") for i, t in enumerate(texts)] + [(None, "no id", 1, 2, "x"), (3, "a", 1, 2, "x"), (3, "a", 1, 2, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int, length int, ids string").repartition(5)
    result = bestfit.packed(docs, BYTES)
    pieces = result.collect()
    want = {}
    for i, text, *_ in rows:
        want.setdefault(i, []).append([*library.encode(text or "", add_special_tokens=False).ids, 2])
    got = {}
    for p in sorted(pieces, key=lambda p: (str(p.doc_id), p.piece)):
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length <= 1024 and (p.piece > 0) == (p.start > 0) and (p.piece == 0 or p.length == 1024)
        got.setdefault(p.doc_id, []).append((p.piece, p.start, ids))
    for i, documents in want.items():
        if i == 3:
            assert got[3] == [(0, 0, documents[0])] * 3
            continue
        assert [start for _, start, _ in got[i]] == [sum(len(x) for _, _, x in got[i][:k]) for k in range(len(got[i]))]
        assert sum((ids for _, _, ids in got[i]), []) == documents[0] and len(got[i]) == -(-len(documents[0]) // 1024)
    filled, whole = {}, {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled.get(p.sequence_id, 0)
        filled[p.sequence_id] = p.offset + p.length
        whole[p.sequence_id] = whole.get(p.sequence_id, b"") + bytes(p.ids)
    assert sorted(filled) == list(range(len(filled))) and max(filled.values()) <= 1024
    assert {r.sequence_id: bytes(r.ids) for r in bestfit.sequences(result).collect()} == whole
    tokens = sum(filled.values())
    assert len(filled) <= 1.02 * tokens / 1024 + 1


def test_no_documents(documents):
    assert bestfit.packed(documents(), BYTES).collect() == []
