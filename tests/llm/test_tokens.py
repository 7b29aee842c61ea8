"""Operators 1, 6 and 8 against the tokenizers library, and their parts against brute force."""

import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from duotower.llm.packing import RoundRobin, exact_weights, pack
from duotower.llm.token_counts import frequent_head, head_key, pretoken_table, token_counts
from duotower.llm import token_file
from duotower.llm.token_file import read_documents, token_at, token_file_round_trip, token_occurrences, write_token_file
from duotower.llm.wavelet import WaveletMatrix
from duotower.llm.wordbpe import _CHARS, BYTES, WHOLE, WORDS, WordBpe, word_bpe

FILE = "word_bpe_49k.json"
TEXTS = ["", None, "Hello world, it's 2024!", "a  b\n\tc", "x <|endoftext|> y <|ENDOFTEXT|> <|startoftext|>", "Größe ß ŉ İstanbul", "é Å ẛ̣",
         "日本語 テスト 123", "\x1c\x1d a\x85b c d", "we'll they're don't 'sup ''s", "word " * 3000, "½²³ 1٣", "É" * 50, "###&&& $$$", "ΑΣ ΟΔΟΣ Σ", "\U0001f600 ok"]


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(public_tokenizers.path(FILE))


def ids_of(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def test_every_plain_character_matches_the_library(tok):
    bpe = word_bpe(FILE)
    texts = [f"a{c}b {c} 1{c}{c}'{c}s'S" for c in _CHARS]
    flat, sizes = bpe.encode(texts)
    ends = np.cumsum(sizes)
    for text, end, n in zip(texts, ends, sizes):
        assert flat[end - n:end].tolist() == ids_of(tok, text), text
        words, special = bpe.pretokens(text)
        assert sum(bpe.piece_counts(words)) + special == n


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aAsStT'<|> \n0é")), max_size=30), max_size=6))
def test_random_texts_match_the_library(texts):
    bpe = word_bpe(FILE)
    tok = bpe.tok
    flat, sizes = bpe.encode(texts)
    assert flat.tolist() == [i for t in texts for i in ids_of(tok, t)]
    for t, n in zip(texts, sizes):
        words, special = bpe.pretokens(t)
        assert sum(bpe.piece_counts(words)) + special == n == len(ids_of(tok, t))


def test_lookup_table_is_cleared_at_its_bound(tok):
    bpe = WordBpe(FILE, cache_words=3)
    for text in ("one two three four", "five six seven eight", "one nine"):
        flat, _ = bpe.encode([text])
        assert flat.tolist() == ids_of(tok, text)
        assert len(bpe.index) <= 4


@pytest.mark.parametrize("head", [0, 5, 100_000])
def test_token_counts(spark, make_docs, tok, head):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(2, TEXTS[2]), (None, "null id"), (3, "other text")]
    docs = make_docs(rows).withColumnRenamed("lang", "pretoken").withColumnRenamed("n_chars", "uid").withColumnRenamed("source", "key")
    got = Counter(tuple(r) for r in token_counts(docs, FILE, head_size=head, over=5).collect())
    want = Counter((i, len((t or "").encode()), n := len(ids_of(tok, t)), n > 5) for i, t in rows)
    assert got == want
    assert token_counts(docs.limit(0), FILE).count() == 0


def test_long_frequent_pretokens_are_answered_from_the_head(spark, make_docs, tok):
    """A ruler line, a long line in another script and a very long run, each in every document."""
    rulers = ["=" * 80, "語" * 90, "-" * 5000]
    rows = [(i, "\n".join([f"word{i} only", *rulers, "x" * (70 + i)])) for i in range(60)]
    docs = make_docs(rows)
    table = pretoken_table(docs, FILE).cache()
    head = frequent_head(table, 40)
    assert len(head) <= 40 and all(len(k) <= 65 for k in head)
    for r in rulers:
        assert head[head_key(r)] == len(ids_of(tok, r))
    assert {r["n"] for r in table.collect() if head_key(r["pretoken"]) not in head} <= {1, 2, 3, 4, 5, 6, 7}     # a run of "x" once each, digits a few times
    got = {r.doc_id: r.n_tokens for r in token_counts(docs, FILE, head_size=40).collect()}
    assert got == {i: len(ids_of(tok, t)) for i, t in rows}


@pytest.mark.parametrize("kind", [WORDS, BYTES, WHOLE])
def test_other_tokenizer_files(spark, make_docs, tmp_path, kind):
    name = public_tokenizers.path(FILE if kind == WORDS else "byte_bpe_50k.json")
    if kind == WHOLE:       # the same vocabulary behind another normalizer, with truncation asked for
        from tokenizers import normalizers

        other = Tokenizer.from_file(name)
        other.normalizer = normalizers.Lowercase()
        other.enable_truncation(4)
        name = str(tmp_path / "other.json")
        other.save(name)
    library = Tokenizer.from_file(name)
    library.no_truncation()
    assert WordBpe(name).kind == kind
    flat, sizes = WordBpe(name).encode([t or "" for t in TEXTS])
    assert flat.tolist() == [i for t in TEXTS for i in ids_of(library, t)] and sizes.tolist() == [len(ids_of(library, t)) for t in TEXTS]
    got = {r.doc_id: r.n_tokens for r in token_counts(make_docs(list(enumerate(TEXTS))), name).collect()}
    assert got == {i: len(ids_of(library, t)) for i, t in enumerate(TEXTS)}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=200))
def test_wavelet_matrix(numbers):
    a = np.array(numbers, np.uint32)
    alphabet = np.unique(a)
    planes = np.concatenate(WaveletMatrix.planes_of(np.searchsorted(alphabet, a), len(alphabet))) if len(a) else np.zeros(0, np.uint8)
    for w in ([WaveletMatrix.build(a)] if len(a) else []) + [WaveletMatrix.load(alphabet.tobytes(), planes.tobytes(), len(a))]:
        assert w.decode().tolist() == numbers
        if numbers:
            assert w.access(np.arange(len(a))).tolist() == numbers
            for x in {numbers[0], numbers[-1], 71}:
                where = np.flatnonzero(a == x)
                assert w.count(x) == len(where) and w.occurrences(x).tolist() == where.tolist()
                code, found = w.code_of(x)
                if found[0]:
                    p = np.arange(len(a) + 1)
                    assert w.rank_code(np.full(len(p), code[0]), p).tolist() == [int((a[:k] == x).sum()) for k in p]


def test_token_file(spark, make_docs, tok, tmp_path):
    rows = [(i * 3, t) for i, t in enumerate(TEXTS)] + [(3, "again"), (3, "again"), (None, "null id")]
    docs = make_docs(rows)
    write_token_file(docs, str(tmp_path / "f"), FILE, 1, shard_tokens=500)
    got = read_documents(spark, str(tmp_path / "f")).orderBy("start").collect()
    assert Counter((r.doc_id, r.ids) for r in got) == Counter((i, np.array(ids_of(tok, t) + [1], "<u4").tobytes()) for i, t in rows)
    ids = [r.doc_id if r.doc_id is not None else -1 for r in got]
    assert ids == sorted(ids)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert token_file_round_trip(docs.limit(0), FILE).count() == 0


@pytest.mark.parametrize("shard_tokens,bits", [(300, 8), (1 << 22, 20)])
def test_token_file_lookups_equal_the_decoded_ids(spark, make_docs, tmp_path, monkeypatch, shard_tokens, bits):
    """Access, counts and occurrences from the planes of the file, over shards smaller and larger than a block of positions."""
    monkeypatch.setattr(token_file, "BLOCK_BITS", bits)
    path = str(tmp_path / "f")
    write_token_file(make_docs(list(enumerate(TEXTS)) + [(3, TEXTS[3])]), path, FILE, 1, shard_tokens=shard_tokens)
    flat = np.concatenate([np.frombuffer(r.ids, "<u4") for r in read_documents(spark, path).orderBy("start").collect()]).tolist()
    asked = list(dict.fromkeys(flat))[::3] + [1, 1, 49_000, 4_000_000_000]
    counts = {r.id: r.n for r in token_file.token_counts(spark, path, asked).collect()}
    assert counts == {x: flat.count(x) for x in asked} and counts[4_000_000_000] == 0
    found = Counter((r.id, r.position) for r in token_occurrences(spark, path, asked).collect())
    assert found == Counter((x, k) for k, x in enumerate(flat) if x in set(asked))
    spots = [0, 0, 7, None, -1, len(flat) - 1, len(flat), *range(3, len(flat), 11)]
    frame = spark.createDataFrame([(p, "x") for p in spots], "position long, id string").repartition(3)
    got = Counter((r.position, r.id) for r in token_at(frame, path).collect())
    assert got == Counter((p, flat[p] if p is not None and 0 <= p < len(flat) else None) for p in set(spots))
    whole = token_at(spark.range(len(flat)), path, "id").orderBy("position").collect()
    assert [r.id for r in whole] == flat


def test_token_file_lookups_in_an_empty_file(spark, make_docs, tmp_path):
    path = str(tmp_path / "f")
    write_token_file(make_docs([(1, "x")]).limit(0), path, FILE, 1)
    assert [tuple(r) for r in token_file.token_counts(spark, path, [5]).collect()] == [(5, 0)]
    assert token_occurrences(spark, path, [5]).count() == 0 and token_file.token_counts(spark, path, []).count() == 0
    assert [tuple(r) for r in token_at(spark.range(1), path, "id").collect()] == [(0, None)]


def brute_round_robin(totals, weights, window, grain):
    """The stream of (queue, place) by playing every round."""
    earned, given, out, r = [0] * len(totals), [0] * len(totals), [], 0
    while any(g < t for g, t in zip(given, totals)):
        r += 1
        for s, t in enumerate(totals):
            upto = min(grain * (r * window * weights[s] // (sum(weights) * grain)), t)
            out += [(s, k) for k in range(given[s], upto)]
            given[s] = upto
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 60), min_size=1, max_size=8), st.integers(1, 9)), min_size=1, max_size=4), st.integers(1, 7))
def test_round_robin_equals_played_rounds(queues, grain):
    window = 16
    sizes, weights = [q for q, _ in queues], [w for _, w in queues]
    totals = [sum(q) for q in sizes]
    want = {x: at for at, x in enumerate(brute_round_robin(totals, weights, window, grain))}
    queue = np.array([s for s, q in enumerate(sizes) for _ in q])
    place = np.array([p for q in sizes for p in np.cumsum([0] + q[:-1])])
    size = np.array([n for q in sizes for n in q])
    doc, start, length, at = RoundRobin(totals, weights, window, grain).pieces(queue, place, size)
    got = {(queue[d], place[d] + a + k): p + k for d, a, n, p in zip(doc, start, length, at) for k in range(n)}
    assert got == want
    assert (at // window == (at + length - 1) // window).all()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 400), min_size=1, max_size=6), st.integers(2, 9))
def test_round_robin_with_weights_beyond_64_bits(totals, grain):
    """The same pieces with weights scaled far past 64 bits, and as played."""
    scaled = RoundRobin(totals, [t * 10 ** 25 for t in totals], 16, grain)
    plain = RoundRobin(totals, totals, 16, grain)
    args = (np.arange(len(totals)), np.zeros(len(totals), np.int64), np.array(totals))
    for a, b in zip(scaled.pieces(*args), plain.pieces(*args)):
        assert (a == b).all()


@pytest.mark.parametrize("totals", [[50_000_000, 50, 151, 40_000], [3_000_000, *range(1000, 1500)], [10 ** 13, 10 ** 7, 3 * 10 ** 6]])
def test_every_window_has_the_mixture_to_one_grain(totals):
    """Shares of 1e-6 and 500 sources: at the end of every round each queue has given its part, short of less than a grain."""
    lanes = [(str(k), t) for k, t in enumerate(totals)]
    weights = exact_weights(lanes, {None: 1.0})
    robin, whole = RoundRobin(totals, weights, 4096, 128), sum(totals)
    assert [Fraction(w, sum(weights)) for w in weights] == [Fraction(t, whole) for t in totals]
    last = whole // 4096
    rounds = np.unique(np.linspace(0, last, 400).astype(np.int64))
    for s, t in enumerate(totals):
        due = [Fraction(int(r) * 4096 * t, whole) for r in rounds]
        given = robin.given(rounds, s).tolist()
        assert all(0 <= d - g < 128 for d, g in zip(due, given))


def test_targets_are_kept_exactly():
    lanes = [("a", 10 ** 9), ("b", 10 ** 6), ("c", 5), (None, 10 ** 7)]
    weights = exact_weights(lanes, {"a": 0.3, "b": 0.000001, None: 0.7})
    share = [Fraction(w, sum(weights)) for w in weights]
    assert share[0] / share[1] == 300_000 and share[3] / share[2] == 2_000_000 and share[0] / (share[2] + share[3]) == Fraction(3, 7)


@pytest.mark.parametrize("queues,target", [(64, None), (2, None), (64, {"a": 3.0, None: 1.0})])
def test_pack(spark, make_docs, tok, queues, target):
    rows = [(i, t, "en", ["a", "b", None, "c"][i % 4]) for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], "en", "a")]
    got = pack(make_docs(rows), FILE, window=64, grain=8, queues=queues, target=target).collect()
    spans, docs = {}, {}
    for r in got:
        assert len(r.ids) == 4 * r.length and r.length > 0
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.doc_id, []).append(r)
    last = max(spans)
    for s, parts in spans.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 64 or s == last and at <= 64
    for i, t in enumerate(TEXTS):
        ids = np.array(ids_of(tok, t) + [2], "<u4").tobytes()
        pieces = sorted(docs[i], key=lambda r: r.start)
        assert Counter(r.ids for r in pieces if r.doc_tokens * 4 == len(ids)) and sum(r.length for r in pieces) * 4 == len(ids) * (2 if i == 2 else 1)
        if i != 2:
            assert b"".join(r.ids for r in pieces) == ids and [r.start for r in pieces] == np.cumsum([0] + [r.length for r in pieces])[:-1].tolist()
    assert pack(make_docs(rows).limit(0), FILE).count() == 0


def test_pack_keeps_the_mixture(spark, make_docs):
    rows = [(i, "one two three four five six seven eight " * 20, "en", "hot" if i % 3 else f"s{i % 4}") for i in range(120)]
    got = pack(make_docs(rows), FILE, window=256, grain=8).groupBy("sequence_id", "source").sum("length").collect()
    last = max(r[0] for r in got)
    hot = [r[2] for r in got if r[1] == "hot" and r[0] < last]
    share = sum(hot) / (256 * last)
    assert len(hot) == last and abs(share - 2 / 3) < 0.01 and all(abs(h - share * 256) <= 8 * 5 for h in hot)


def test_pack_deals_small_sources_and_keeps_targets(spark, make_docs):
    # 40 sources of 3 to 9 documents, 4 of them with a queue of their own
    rows = [(100 * s + i, "one two three four five six seven eight " * 6, "en", f"s{s:02d}") for s in range(40) for i in range(3 + s % 7)]
    got = pack(make_docs(rows), FILE, window=512, grain=8, queues=5).collect()
    total, last = Counter(), max(r.sequence_id for r in got)
    for r in got:
        total[r.source] += r.length
    ids = sum(total.values())
    for w in range(1, last + 1):
        given = Counter()
        for r in got:
            if r.sequence_id < w:
                given[r.source] += r.length
        assert all(abs(given[s] - t * 512 * w / ids) <= 8 * 4 for s, t in total.items()), w
    # the least source has a target of its own: three quarters of a window as long as it lasts
    least = min(total, key=lambda s: (total[s], s))
    aimed = pack(make_docs(rows), FILE, window=64, grain=8, queues=5, target={least: 3.0, None: 1.0}).where("sequence_id = 0").collect()
    assert abs(sum(r.length for r in aimed if r.source == least) - 48) <= 8
    # a length-1 grain per document and more sources than ids in a window
    many = [(i, "one", "en", f"t{i}") for i in range(300)]
    packed = pack(make_docs(many), FILE, window=64, grain=8, queues=2).collect()
    assert Counter(r.doc_id for r in packed for _ in range(r.length)) == Counter({i: packed[0].doc_tokens for i in range(300)})
    assert sorted((r.sequence_id * 64 + r.offset + k) for r in packed for k in range(r.length)) == list(range(300 * packed[0].doc_tokens))
