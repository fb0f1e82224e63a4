import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from habitra.llm import bpe, packing, token_counts, tokenbin
from habitra.llm.queries import BYTE_BPE, PIECE_BPE, WORD_BPE, tokenizer_path
from habitra.llm.tokenizing import ChunkEncoder, TrieBPE

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def byte_lib():
    return tokenizers.Tokenizer.from_file(tokenizer_path(BYTE_BPE))


@pytest.fixture(scope="module")
def word_lib():
    return tokenizers.Tokenizer.from_file(tokenizer_path(WORD_BPE))


@pytest.fixture(scope="module")
def trie():
    return TrieBPE(tokenizer_path(BYTE_BPE))


def ids_of(lib, text):
    return lib.encode(text or "", add_special_tokens=False).ids


def test_encode_and_decode_as_the_library(docs, byte_lib):
    path = tokenizer_path(BYTE_BPE)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in bpe.decode(bpe.encode(docs, path), path).collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == ids_of(byte_lib, texts[r.doc_id])
        assert r.text == byte_lib.decode(ids, skip_special_tokens=False)


def test_bpe_odd_rows(odd, none, byte_lib):
    path = tokenizer_path(BYTE_BPE)
    got = sorted((str(r.doc_id), r.ids, r.text) for r in bpe.decode(bpe.encode(odd, path), path).collect())
    want = sorted((str(r.doc_id), b"".join(struct.pack("<I", i) for i in ids_of(byte_lib, r.text)), r.text or "") for r in odd.collect())
    assert got == want
    assert bpe.decode(bpe.encode(none, path), path).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_trie_equals_the_library_on_any_text(trie, byte_lib, texts):
    assert [np.frombuffer(x, "<u4").tolist() for x in trie.encode_texts(texts)] == [ids_of(byte_lib, t) for t in texts]


def test_every_code_point_splits_as_in_the_library(trie, byte_lib):
    marks = [chr(c) for c in [*range(0x20, 0x3000, 3), *range(0x1F300, 0x1F700, 7)]]
    texts = ["a" + "".join(marks[i : i + 40]) + " b" for i in range(0, len(marks), 40)]
    assert [np.frombuffer(x, "<u4").tolist() for x in trie.encode_texts(texts)] == [ids_of(byte_lib, t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aAbB'sS .,…!-é́İΣ\n\t<|>")), max_size=40), max_size=5))
def test_chunks_equal_whole_texts(word_lib, chunk_encoder, texts):
    assert [np.frombuffer(x, "<u4").tolist() for x in chunk_encoder.encode_texts(texts)] == [ids_of(word_lib, t) for t in texts]


@pytest.fixture(scope="module")
def chunk_encoder():
    return ChunkEncoder(tokenizer_path(WORD_BPE))


@given(st.lists(st.integers(0, 5000), min_size=1, max_size=300))
def test_elias_fano_round_trip(gaps):
    values = np.cumsum(gaps)
    ef = tokenbin.EliasFano.of(values)
    assert ef.all().tolist() == values.tolist()
    assert [ef.select(i) for i in range(len(values))] == values.tolist()
    back, _ = tokenbin.EliasFano.load(ef.n, ef.low_bits, memoryview(ef.dump()))
    assert back.all().tolist() == values.tolist()
    bits = 8 * (len(ef.low) + len(ef.high) + 4 * len(ef.places))
    assert bits <= len(values) * (2 + max(0, np.log2(max(values[-1], 1) / len(values))) + 1) + 128


def test_shards_hold_documents_in_order(docs, word_lib):
    blocks = tokenbin.write(docs, tokenizer_path(WORD_BPE), end_id=2, block_ids=4000)
    assert blocks.count() > 4
    texts = dict(docs.select("doc_id", "text").collect())
    start = 0
    got = {r.doc_id: r for r in tokenbin.read(blocks).collect()}
    assert len(got) == len(texts)
    for doc in sorted(texts):
        ids = [*ids_of(word_lib, texts[doc]), 2]
        assert np.frombuffer(got[doc].ids, "<u4").tolist() == ids
        assert (got[doc].start, got[doc].n_tokens) == (start, len(ids))
        start += len(ids)


def test_shards_odd_rows_and_damage(odd, none):
    path = tokenizer_path(WORD_BPE)
    rows = tokenbin.read(tokenbin.write(odd, path, end_id=2)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 1, 2, 3, 4, 4, 7, 8]
    assert rows[3].n_tokens == rows[4].n_tokens == 1
    assert tokenbin.read(tokenbin.write(none, path, end_id=2)).count() == 0
    data = bytearray(tokenbin.Block.pack([1, 2], [np.array([5, 6]), np.array([7])], 2))
    assert tokenbin.Block(bytes(data)).ids(1).tolist() == [7]
    data[-6] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        tokenbin.Block(bytes(data))


@pytest.mark.parametrize("ids", [[None, None, -(2**63), -5, -5, 0, 7, 2**63 - 1], [None], [], [3] * 200, list(range(-1000, 5000, 7))])
def test_doc_ids_of_a_block(tmp_path, ids):
    """Near-minimal lists instead of a table of 64 bits, and a file that opens without Spark."""
    texts = [np.arange(k % 5 + 1) for k in range(len(ids))]
    data = tokenbin.Block.pack(ids, texts, 2, shard=3, block=4, first=99)
    (tmp_path / "b.eftk").write_bytes(data)
    block = tokenbin.Block.open(str(tmp_path / "b.eftk"))
    assert (block.shard, block.block, block.first, block.n) == (3, 4, 99, len(ids))
    assert block.doc_ids() == ids == [block.doc_id(i) for i in range(len(ids))]
    assert all(block.ids(i).tolist() == x.tolist() for i, x in enumerate(texts))
    if len(ids) > 500:
        assert len(data) < 5 * len(ids) + 2 * sum(map(len, texts)) + 200


def test_select_past_a_long_document():
    ends = np.cumsum([1] * 100 + [5_000_000] + [2] * 100)
    ef = tokenbin.EliasFano.of(ends)
    assert [ef.select(i) for i in range(len(ends))] == ends.tolist()


def test_files_open_without_spark(docs, word_lib):
    rows = tokenbin.write(docs, tokenizer_path(WORD_BPE), end_id=2, block_ids=4000).orderBy("shard", "block").collect()
    held = [(d, block.ids(i).tolist()) for r in rows for block in [tokenbin.Block.open(r.path)] for i, d in enumerate(block.doc_ids())]
    texts = dict(docs.select("doc_id", "text").collect())
    assert held == [(d, [*ids_of(word_lib, texts[d]), 2]) for d in sorted(texts)]


def check_packing(slots, capacity):
    by = {}
    for r in slots:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), min_size=1), st.just(40))
def test_plan_is_gapless_best_fit(counts, capacity):
    runs = packing.plan(counts, capacity)
    places = {}
    for length, rank, n, first, offset in runs:
        for k in range(n):
            places.setdefault(first + k, []).append((offset, length))
    assert {k: sum(1 for p in places.values() for x in p if x[1] == k) for k in counts} == counts
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(k * n for k, n in counts.items())
    assert len(places) <= 11 / 9 * -(-total // capacity) * 1.35 + 1


def test_packing(docs, word_lib):
    cut = packing.pieces(docs, tokenizer_path(WORD_BPE), end_id=1, capacity=512)
    slots = packing.assign(cut, 512).collect()
    n = check_packing(slots, 512)
    texts = dict(docs.select("doc_id", "text").collect())
    by = {}
    for r in slots:
        by.setdefault(r.doc_id, []).append(r)
    total = 0
    for doc, text in texts.items():
        ids = [*ids_of(word_lib, text), 1]
        total += len(ids)
        parts = sorted(by[doc], key=lambda r: r.piece)
        assert [r.start for r in parts] == list(range(0, len(ids), 512))
        for r in parts:
            part = ids[r.start : r.start + 512]
            assert r.length == len(part) and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    assert n <= 1.02 * -(-total // 512) + 1
    built = packing.sequences(cut, packing.assign(cut, 512)).collect()
    assert sum(len(r.ids) // 4 for r in built) == total and max(len(r.ids) // 4 for r in built) <= 512


def test_packing_odd_rows(odd, none):
    slots = packing.pack(odd, tokenizer_path(WORD_BPE), end_id=1, capacity=64).collect()
    check_packing(slots, 64)
    assert sorted(r.length for r in slots if r.doc_id in (2, 3)) == [1, 1]
    assert len([r for r in slots if r.doc_id == 1]) == 2 and any(r.doc_id is None for r in slots)
    assert packing.pack(none, tokenizer_path(WORD_BPE), end_id=1).count() == 0


def brute_unigram(word, scores):
    best = [(0.0, 0)] + [(-1e18, 0)] * len(word)
    for i in range(1, len(word) + 1):
        options = [(best[j][0] + scores[word[j:i]], best[j][1] - 1) for j in range(i) if word[j:i] in scores]
        if word[i - 1 : i] not in scores:
            options.append((best[i - 1][0] + token_counts.UNKNOWN, best[i - 1][1] - 1))
        best[i] = max(options)
    return -best[-1][1]


def test_counts_equal_a_full_search(docs):
    model = token_counts.TrieUnigram(tokenizer_path(PIECE_BPE))
    texts = dict(docs.select("doc_id", "text").collect())
    for r in token_counts.token_counts(docs, tokenizer_path(PIECE_BPE)).collect():
        words = texts[r.doc_id].encode().split()[:80] if r.doc_id % 10 == 0 else []
        for w in words:
            assert model.count_words([token_counts.WORD_MARK + w.decode()])[token_counts.WORD_MARK + w.decode()] == brute_unigram(token_counts.WORD_MARK + w.decode(), model.scores)
        assert r.n_words == len(texts[r.doc_id].encode().split())


@given(st.lists(st.text("▁abeht日é🤣z", max_size=30), max_size=30, unique=True), st.sampled_from([1, 4, 200]), st.sampled_from([7, 2_000_000]))
def test_levels_equal_a_full_search(words, most, chars):
    """Words on either side of the length where the walk changes, and tries cut small."""
    scores = {"a": -1.0, "b": -1.0, "ab": -2.0, "aba": -2.5, "e": -3.0, "the": -2.0, "▁": -1.5, "▁th": -1.0, "日": -4.0, "é日": -1.0, "zzzz": -1.0}
    model = token_counts.TrieUnigram.of(scores)
    before = token_counts.LEVEL_CHARS, token_counts.TRIE_CHARS
    token_counts.LEVEL_CHARS, token_counts.TRIE_CHARS = most, chars
    try:
        words = [w for w in words if w]
        assert model.count_words(words) == {w: brute_unigram(w, scores) for w in words}
        met = model.piece_counts({w: k + 1 for k, w in enumerate(words)})
        pieces = model.segment_words(words)
        for p in scores:
            assert met[p] == sum((k + 1) * pieces[w].count(p) for k, w in enumerate(words))
    finally:
        token_counts.LEVEL_CHARS, token_counts.TRIE_CHARS = before


def test_counts_equal_the_library(docs):
    model = token_counts.TrieUnigram(tokenizer_path(PIECE_BPE))
    lib = tokenizers.models.Unigram([("<unk>", -100.0), *model.scores.items()], 0, False)
    words = {token_counts.WORD_MARK + w for r in docs.limit(40).collect() for w in r.text.split()}
    words = [w for w in words if all(c in model.scores for c in w)]
    got = model.count_words(words)
    assert words and all(got[w] == len(lib.tokenize(w)) for w in words)


def test_whole_documents_with_fitted_scores(docs):
    """The fit against the same rounds by plain search, and every document's count against plain search of its words."""
    path = tokenizer_path(PIECE_BPE)
    some = docs.orderBy("doc_id").limit(60)
    texts = dict(some.select("doc_id", "text").collect())
    mark = token_counts.WORD_MARK
    words = {}
    for t in texts.values():
        for w in t.encode().split():
            words[mark + w.decode()] = words.get(mark + w.decode(), 0) + 1

    def pieces(word, scores):
        best = [(0.0, 0, 0)]
        for i in range(1, len(word) + 1):
            options = [(best[j][0] + scores[word[j:i]], best[j][1] - 1, j) for j in range(max(0, i - 40), i) if word[j:i] in scores]
            if word[i - 1 : i] not in scores:
                options.append((best[i - 1][0] + token_counts.UNKNOWN, best[i - 1][1] - 1, i - 1))
            best.append(max(options, key=lambda x: (x[0], x[1], -x[2])))
        out, at = [], len(word)
        while at:
            out.append(word[best[at][2] : at])
            at = best[at][2]
        return out

    got = token_counts.fit(some, path, rounds=2)
    scores = token_counts.TrieUnigram(path).scores
    for _ in range(2):
        met = {}
        for w, n in words.items():
            for p in pieces(w, scores):
                met[p] = met.get(p, 0) + n
        met = {p: n for p, n in met.items() if p in scores}
        total = np.log(sum(met.values()) + len(scores))
        scores = {p: np.log(met.get(p, 0) + 1) - total for p in scores}
    assert got.keys() == scores.keys()
    off = [p for p in scores if abs(got[p] - scores[p]) > 1e-9]
    assert len(off) <= 0.001 * len(scores)  # ties may be cut elsewhere
    cost = {w: len(pieces(w, got)) for w in words}
    for r in token_counts.token_counts(some, path, got).collect():
        own = [mark + w.decode() for w in texts[r.doc_id].encode().split()]
        assert (r.n_words, r.n_tokens) == (len(own), sum(cost[w] for w in own))
    assert token_counts.fit(docs.limit(0), path) == token_counts.TrieUnigram(path).scores


def test_counts_odd_rows(odd, none):
    rows = {(r.doc_id, r.n_words): r.n_tokens for r in token_counts.token_counts(odd, tokenizer_path(PIECE_BPE)).collect()}
    assert rows[2, 0] == rows[3, 0] == 0 and rows[8, 3001] > 3000 and len(rows) == 8
    assert token_counts.token_counts(none, tokenizer_path(PIECE_BPE)).count() == 0
