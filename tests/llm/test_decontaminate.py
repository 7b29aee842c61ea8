"""Operator 7 and the FM-index against brute force."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from duotower.llm.decontaminate import BitCount, Windows, decontaminate, occurrences, shard_codes, words_of
from duotower.llm.fm_index import FmIndex, suffix_array


def brute(text, items, width):
    words = words_of(text)
    hit, names = set(), set()
    for name, item in items:
        own = words_of(item)
        for k in range(max(1, len(own) - width + 1) if own else 0):
            win = own[k:k + width]
            for p in range(len(words) - len(win) + 1):
                if words[p:p + len(win)] == win:
                    hit.update(range(p, p + len(win)))
                    names.add(name)
    return len(words), hit, sorted(names)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=40), min_size=1, max_size=5))
def test_suffix_array(parts):
    codes = np.array([c for p in parts for c in [*p, 0]], np.uint32)
    def key(p):
        end = p + int(np.flatnonzero(codes[p:] == 0)[0])
        return [*codes[p:end].tolist(), 0], p
    assert suffix_array(codes).tolist() == sorted(range(len(codes)), key=key)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab c", max_size=120), min_size=1, max_size=6), st.lists(st.text("abc ", max_size=25), min_size=1, max_size=4), st.integers(1, 5))
def test_shard_search(texts, items, width):
    named = [(str(k), t) for k, t in enumerate(items)]
    w = Windows(named, width)
    codes, skipped, first, sizes = shard_codes(texts, w.vocabulary)
    assert codes[-1] == 0
    parts = FmIndex.parts(codes)
    fm = FmIndex(*parts.values())
    at, window = occurrences(fm, w)
    count = BitCount(np.packbits(codes == 0, bitorder="little").tobytes(), len(codes), skipped)
    doc = np.searchsorted(first, at, side="right") - 1
    word = count.words_before(at) - count.words_before(first[doc])
    got = {(int(d), int(p), tuple(w.patterns[k, :w.lengths[k]].tolist())) for d, p, k in zip(doc, word, window)}
    want = set()
    for d, text in enumerate(texts):
        own = [w.vocabulary.get(x, -1) for x in words_of(text)]
        assert sizes[d] == len(own)
        for k, n in enumerate(w.lengths):
            pattern = w.patterns[k, :n].tolist()
            want |= {(d, p, tuple(pattern)) for p in range(len(own) - n + 1) if own[p:p + n] == pattern}
    assert got == want and len(at) == len(want)


ITEMS = [("a", "one two three four five six seven eight nine ten eleven twelve"), ("b", "Short, item!"), (None, "null id item here"), ("c", None), ("d", "... !"),
         ("a", "again the very same name with other words and so on and on"), ("é", "Größe der Straße von heute an")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_decontaminate(spark, make_docs, block_bytes):
    texts = ["", None, "nothing here", "x ONE two three-four five six seven, eight nine ten eleven twelve y", "two three four five six seven eight nine ten eleven",
             "short item short item SHORT item", "null id item here", "größe der straße von heute an", "GRÖSSE der Straße von heute an",
             "one two three four five six seven eight nine", "again the very same name with other words and so on and on " * 50, "!!! ???"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[5])]
    bench = spark.createDataFrame([(n, t, 1) for n, t in ITEMS], "item_id string, text string, doc_id int")
    items = [(n or "", t) for n, t in ITEMS]
    got = sorted(decontaminate(make_docs(rows).withColumnRenamed("lang", "spans"), bench, shard_words=100, block_bytes=block_bytes).collect(), key=str)
    want = []
    for i, t in rows:
        n, hit, names = brute(t, items, 10)
        want.append((i, n, hit, names))
    assert sorted(((r.doc_id, r.n_words, {p for s in r.spans for p in range(s.start, s.start + s.length)}, r["items"]) for r in got), key=str) == sorted(want, key=str)
    assert all(sum(s.length for s in r.spans) == len({p for s in r.spans for p in range(s.start, s.start + s.length)}) for r in got)


def test_empty_tables(spark, make_docs):
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    docs = make_docs([(1, "short item"), (2, None)])
    assert decontaminate(docs.limit(0), bench).count() == 0
    got = decontaminate(docs, bench.limit(0)).collect()
    assert sorted((r.doc_id, r.n_words, r.spans, r["items"]) for r in got) == [(1, 2, [], []), (2, 0, [], [])]


def test_repeated_benchmark_rows_count_once(spark, make_docs):
    """A third of the table being one item does not fill one block, and the hits are those of the distinct items."""
    words = [f"w{k}" for k in range(60)]
    items = [("a", " ".join(words[:15]))] * 400 + [(str(k), " ".join(words[k:k + 12])) for k in range(20, 40)] + [(None, "w1")]
    bench = spark.createDataFrame([(i, t) for i, t in items], "item_id string, text string")
    docs = make_docs([(1, "x " + " ".join(words[:30])), (2, "clean text"), (3, None)])
    size = sum(len(t) for _, t in set(items))
    got = {r.doc_id: (r.n_words, r["items"]) for r in decontaminate(docs, bench, block_bytes=size // 3).collect()}
    want = {i: brute(t or "", [(n or "", x) for n, x in set(items)], 10) for i, t in ((1, "x " + " ".join(words[:30])), (2, "clean text"), (3, None))}
    assert got == {i: (n, names) for i, (n, _, names) in want.items()}
