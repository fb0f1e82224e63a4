import hashlib
import itertools

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from habitra.llm import components, merkle, simhash, suffix_dedup


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(nodes, near):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in itertools.combinations(sorted(nodes), 2):
        if near(a, b) and find(a) != find(b):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {n: find(n) for n in nodes}


def test_simhash_groups(docs):
    got = simhash.groups(simhash.fingerprints(docs)).collect()
    prints = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
    assert {r.doc_id: int.from_bytes(r.fp, "big") for r in got} == prints
    assert {r.doc_id: r.component_id for r in got} == brute_groups(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)


@pytest.mark.parametrize("hot", [0, 3, 48])
def test_hot_buckets_lose_no_link(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    g = np.random.default_rng(3)
    base = [int(x) for x in g.integers(0, 2**63, 6)]
    prints = {}
    for i in range(240):
        x = base[i % 6]
        for b in g.integers(0, 64, int(g.integers(0, 6))):
            x ^= 1 << int(b)
        prints[i] = x
    rows = spark.createDataFrame([(i, x.to_bytes(8, "big")) for i, x in prints.items()], "doc_id long, fp binary")
    got = {r.doc_id: r.component_id for r in simhash.groups(rows).collect()}
    assert got == brute_groups(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)


def test_simhash_odd_rows(odd, none):
    got = {(r.doc_id, r.fp): r.component_id for r in simhash.groups(simhash.fingerprints(odd)).collect()}
    assert {c for (d, _), c in got.items() if d in (2, 3)} == {2}
    assert {c for (d, _), c in got.items() if d in (1, 4)} == {1}  # both texts of id 4 join the group of its copy
    assert all(d is not None for d, _ in got)
    assert simhash.groups(simhash.fingerprints(none)).count() == 0


def test_keep_one(spark, docs):
    base = docs.where(F.length("text") > 800).limit(20).select("doc_id", "text", "source")
    near = base.select((F.col("doc_id") + 100_000).alias("doc_id"), F.concat("text", F.lit(" tail")).alias("text"), "source")
    kept = simhash.keep_one(base.unionByName(near))
    ids = {r.doc_id for r in kept.collect()}
    assert not any(i >= 100_000 for i in ids) and kept.columns == ["doc_id", "text", "source"]
    empty = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (1, "a b c"), (1, "a b c")], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in simhash.keep_one(empty).collect()) == ["1", "None", "None"]


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (7, 7), (200, 201), (201, 202), (202, 200)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(2, 41)} | {101: 100, 201: 200, 202: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(rows):
    """(id, bytes) -> kept bytes, by every string of 50 bytes."""
    first = {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    out = []
    for i, text in order:
        key = float("inf") if i is None else i
        gone = bytearray(len(text))
        for p in range(len(text) - 49):
            if first.setdefault(text[p : p + 50], key) < key:
                gone[p : p + 50] = b"\1" * 50
        out.append((i, bytes(x for x, g in zip(text, gone) if not g)))
    return out


@pytest.mark.parametrize("small, hot", [(False, None), (True, None), (True, 3), (False, 1)])
def test_repeats(docs, odd, monkeypatch, small, hot):
    if hot:  # anchors of more postings are dealt by context
        real, found = suffix_dedup._hot_anchors, []
        monkeypatch.setattr(suffix_dedup, "HOT_STRIDE", 1)
        monkeypatch.setattr(suffix_dedup, "_hot_anchors", lambda blocks, names, count, limit: found.append(real(blocks, names, count, hot)) or found[0])
    if small:  # many blocks, slices and buckets
        monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 30_000)
        monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 500)
        monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 50_000)
    both = docs.select("doc_id", "text").unionByName(odd.where("doc_id IS NULL OR doc_id = 8").select(F.col("doc_id") + 10_000, "text").toDF("doc_id", "text"))
    got = sorted(((r.doc_id, bytes(r.kept_bytes)) for r in suffix_dedup.dedup(both).collect()), key=str)
    want = sorted(brute_repeats([(r.doc_id, (r.text or "").encode()) for r in both.collect()]), key=str)
    assert got == want
    assert not hot or len(found[0]) > 20


def test_an_anchor_in_many_contexts(spark, monkeypatch):
    """One anchor stands in every document with other neighbours; its contexts don't meet in one bucket."""
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 3000)
    monkeypatch.setattr(suffix_dedup, "HOT_STRIDE", 1)
    g = np.random.default_rng(5)
    text = lambda n: "".join(map(chr, g.integers(97, 123, n)))
    shared = text(66)
    rows = [(i, text(int(g.integers(0, 60))) + shared[int(g.integers(0, 10)) :] + text(int(g.integers(0, 60)))) for i in range(300)]
    seen, real = [], suffix_dedup._hot_anchors
    monkeypatch.setattr(suffix_dedup, "_hot_anchors", lambda *a: seen.append(real(*a)) or seen[0])
    got = sorted((r.doc_id, bytes(r.kept_bytes)) for r in suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    assert len(seen[0]) and got == sorted(brute_repeats([(i, t.encode()) for i, t in rows]))


def test_repeats_odd_rows(odd, none):
    rows = suffix_dedup.dedup(odd.select("doc_id", "text", "source")).collect()
    assert len(rows) == 9
    assert sorted(((r.doc_id, bytes(r.kept_bytes)) for r in rows), key=str) == sorted(brute_repeats([(r.doc_id, (r.text or "").encode()) for r in odd.collect()]), key=str)
    assert suffix_dedup.dedup(none).count() == 0
    kept = suffix_dedup.strip_repeats(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 2 AND text IS NULL").count() == 1


def test_pieces_grow_with_the_square_root():
    sizes = [suffix_dedup.grown(suffix_dedup.BLOCK_BYTES, t << 30) >> 20 for t in (0, 1, 4, 16, 10**5)]
    assert sizes == [2, 2, 4, 8, 8]


def test_cuts_keep_whole_characters():
    text = "aé日b".encode()
    assert suffix_dedup.whole_characters(text, [[2, 5]]) == [[3, 3]] or suffix_dedup.whole_characters(text, [[2, 5]]) == []
    for s, e in itertools.combinations(range(len(text) + 1), 2):
        suffix_dedup.without(text, suffix_dedup.whole_characters(text, [[s, e]])).decode()


def test_merkle_tree():
    a = merkle.Tree("One. Two! Three?\nFour five.\n\nSix\n\n\nSeven eight. Nine")
    assert a.root == merkle.Tree("One. Two! Three?\nFour five.\n\nSix\n\n\nSeven eight. Nine").root
    b = merkle.Tree("One. Two! Three?\nFour FIVE.\n\nSix\n\n\nSeven eight. Nine")
    assert a.root != b.root and 0.5 < merkle.likeness(a, b) < 1
    text = "One. Two! Three?\nFour FIVE.\n\nSix\n\n\nSeven eight. Nine"
    assert [text[s:e] for s, e in merkle.edits(a, b)[1]] == ["Four FIVE.\n\n"] or [text[s:e].strip() for s, e in merkle.edits(a, b)[1]] == ["Four FIVE."]
    assert merkle.likeness(merkle.Tree(""), merkle.Tree("")) == 1.0
    assert merkle.likeness(merkle.Tree(""), merkle.Tree("x")) == 0.0
    leaves = [t for s in a.spans for p in s for t in p]
    assert leaves[0][0] == 0 and all(x[1] == y[0] for x, y in itertools.pairwise(leaves)) and leaves[-1][1] == len("One. Two! Three?\nFour five.\n\nSix\n\n\nSeven eight. Nine")


@pytest.mark.parametrize("parts", [1, 5, 64])
def test_edited_texts(docs, parts):
    rows = sorted(docs.select("doc_id", "text").collect())
    got = {r.doc_id: r for r in merkle.compare_edited(merkle.with_next(docs, parts=parts)).collect()}
    assert len(got) == len(rows)
    for k, (doc, text) in enumerate(rows):
        half = len(text) // 2
        after = rows[(k + 1) % len(rows)][1]
        edited = text[: len(text) - half] + after[:half]
        assert got[doc].edited == edited and got[doc].n_chars == len(text)
        assert (got[doc].fingerprint == got[doc].edited_fingerprint) == (text == edited)
        assert (got[doc].near_next == 1.0) == (text == after)
    long = [got[d].near_edited for d, t in rows if len(t) > 2000]
    assert 0.3 < np.mean(long) < 0.9
    prints = {r.doc_id: r.fingerprint for r in merkle.fingerprints(docs).collect()}
    assert prints == {d: r.fingerprint for d, r in got.items()}
    assert (len(set(prints.values())) == len({hashlib.sha256(t.encode()).digest() for _, t in rows}))


def brute_leaves(text):
    """Sentences or pieces of at most 160 code points of each line, with the line's end, as strings."""
    out = []
    for line in text.splitlines(keepends=True) if not set("\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029") & set(text) else [x + "\n" for x in text.split("\n")[:-1]] + [x for x in text.split("\n")[-1:] if x]:
        at = 0
        while at < len(line):
            end = at
            while end < len(line) and line[end] not in ".!?" and end - at < 160:
                end += 1
            stop = end
            while stop < len(line) and line[stop] in ".!?":
                stop += 1
            if stop > end:
                while stop < len(line) and line[stop].isspace():
                    stop += 1
            out.append(line[at:stop])
            at = stop
    return out


def test_likeness_against_all_leaves(docs):
    """Twice the leaves that two texts share over all of them, without any tree."""
    from collections import Counter

    rows = sorted(docs.select("doc_id", "text").collect())
    got = {r.doc_id: r for r in merkle.compare_edited(merkle.with_next(docs)).collect()}

    def like(a, b):
        x, y = Counter(brute_leaves(a)), Counter(brute_leaves(b))
        return 2 * (x & y).total() / (x.total() + y.total()) if a != b else 1.0

    for k, (doc, text) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(text) // 2
        assert got[doc].near_edited == pytest.approx(like(text, text[: len(text) - half] + after[:half]))
        assert got[doc].near_next == pytest.approx(like(text, after))


def test_edited_odd_rows(odd, none):
    got = merkle.compare_edited(merkle.with_next(odd)).collect()
    assert len(got) == 9
    one = odd.where("doc_id = 8")
    assert merkle.compare_edited(merkle.with_next(one)).first().near_next == 1.0
    assert merkle.compare_edited(merkle.with_next(none)).count() == 0


@pytest.mark.parametrize(("hot", "shingles"), [(3, 1 << 20), (48, 1 << 20), (3, 1500), (48, 1500)])
def test_near_copies_against_all_pairs(spark, monkeypatch, hot, shingles):
    """Groups of copies with more and more words changed, through hot buckets and large groups and without."""
    monkeypatch.setattr(simhash, "HOT", hot)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    monkeypatch.setattr(simhash, "BLOCK_SHINGLES", shingles)
    g = np.random.default_rng(9)
    texts = {}
    for base in range(3):
        words = [f"w{x}" for x in g.integers(0, 5000, 300)]
        for k in range(25):
            own = list(words)
            for at in g.integers(0, 300, k // 3):
                own[at] = f"n{g.integers(0, 10**9)}"
            texts[base * 100 + k] = " ".join(own)
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(296)} for i, t in texts.items()}
    want = brute_groups(texts, lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert kept == set(want.values())


def test_near_copies_count_a_repeated_shingle_once(spark):
    """A line of 20 words: ten times and once in a copy, and forty times in two texts that differ otherwise."""
    g = np.random.default_rng(11)
    words = lambda n: [f"w{x}" for x in g.integers(0, 10**6, n)]
    line, body = words(20), words(320)
    once = [*body[:160], *line, *body[160:]]
    often = [*body[:160], *line * 10, *body[160:]]

    def between(own):
        return [w for k in range(40) for w in (*own[k * 20 : k * 20 + 20], *line)]

    texts = {1: once, 2: often, 11: between(words(820)), 12: between(words(820))}
    sets = {i: {tuple(t[k : k + 5]) for k in range(len(t) - 4)} for i, t in texts.items()}
    alike = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in itertools.combinations(texts, 2)}
    assert alike[1, 2] >= 0.8 and alike[11, 12] < 0.5
    print1, print2 = (int.from_bytes(simhash.fingerprint(" ".join(texts[i]), 5, 9), "big") for i in (1, 2))
    assert (print1 ^ print2).bit_count() > 130  # by fingerprints that count repeats these two never meet
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")).collect()}
    assert kept == {1, 11, 12}


def test_a_line_that_repeats(spark):
    """Once or many times is nearly the same set; a line that two texts repeat doesn't make them alike."""
    g = np.random.default_rng(21)
    words = lambda n: [f"w{x}" for x in g.integers(0, 10**6, n)]
    body, line = words(300), words(8)
    texts = {1: [*body, *line], 2: [*body, *line * 10], 3: [*body, *line * 100], 11: [*line * 100, *words(20)], 12: [*line * 100, *words(20)]}
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")).collect()}
    assert kept == {1, 11, 12}


def test_recall_by_similarity(spark):
    """Pairs of texts of 25 to 600 words, each with one near copy: of those of 0.8 or more at least 0.98 are found, of others none."""
    g = np.random.default_rng(4)
    texts, want = {}, {}
    for k in range(600):
        n = int(g.choice([25, 60, 200, 600]))
        own = [f"w{x}" for x in g.integers(0, 10**7, n)]
        other = list(own)
        for at in range(int(g.integers(0, 1 + n // 25))):
            other[int(g.integers(0, n))] = f"n{k}x{at}"
        a, b = ({tuple(t[i : i + 5]) for i in range(n - 4)} for t in (own, other))
        texts[2 * k], texts[2 * k + 1] = " ".join(own), " ".join(other)
        want[2 * k + 1] = len(a & b) / len(a | b)
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    near = [i for i, j in want.items() if j >= 0.8]
    assert {i for i, j in want.items() if j < 0.8} <= kept and len(near) > 200
    assert len(kept & set(near)) <= 0.02 * len(near)
    edge = [i for i in near if want[i] < 0.85]
    assert len(edge) > 50 and len(kept & set(edge)) <= 0.05 * len(edge)


def test_one_row_of_a_repeated_id(spark):
    """Texts of one id count as one group, and the least by its text stays, however the rows are dealt."""
    rows = [(5, "b " * 30, 1), (5, "a " * 30, 2), (9, "a " * 30, 3), (9, "z y x w v u t", 4), (None, "a " * 30, 5)]
    for parts in (1, 4):
        got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, __id int").withColumnRenamed("__id", "c").repartition(parts)).collect()
        assert sorted((str(r.doc_id), r.c) for r in got) == [("5", 2), ("None", 5)]


@pytest.mark.parametrize("hot", [3, 48])
def test_close_fingerprints_link_by_their_sets_only(spark, monkeypatch, hot):
    """All fingerprints nearly alike: only the sets tell the groups."""
    monkeypatch.setattr(simhash, "HOT", hot)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    g = np.random.default_rng(5)
    texts = {}
    for k in range(40):
        own = [f"b{k % 4}w{x}" for x in range(100)]
        for at in range(k // 8 + k % 3):
            own[at * 5] = f"n{k}x{at}"
        texts[k + 1] = " ".join(own)
    rows = [(i, bytes(72 - 2) + int(g.integers(1, 2**16)).to_bytes(2, "big")) for i in texts]
    monkeypatch.setattr(simhash, "fingerprints", lambda df, *a, **k: spark.createDataFrame(rows, "doc_id long, fp binary"))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(96)} for i, t in texts.items()}
    want = brute_groups(texts, lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    assert 4 < len(set(want.values())) < 40
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert kept == set(want.values())


def test_pairs_of_many_bits_are_settled_by_their_sets(spark, monkeypatch):
    """A pair at a Jaccard of 0.8 may differ in more bits than the mean by up to 5 deviations."""
    words = [f"w{x}" for x in range(340)]
    near = [*words[:305], *[f"n{x}" for x in range(35)]]
    sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in (words, near)]
    assert 0.8 <= len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.82
    texts = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(f"x{k}" for k in range(340)))]
    rows = [(1, bytes(72)), (2, bytes(57) + b"\xff" * 15), (3, bytes(57) + b"\x0f" * 15)]  # 120, 60 and 60 bits apart
    monkeypatch.setattr(simhash, "fingerprints", lambda df, *a, **k: spark.createDataFrame(rows, "doc_id long, fp binary"))
    assert {r.doc_id for r in simhash.keep_one(spark.createDataFrame(texts, "doc_id long, text string")).collect()} == {1, 3}


@pytest.mark.parametrize("ids", [(7, 7), (None, None)])
def test_repeated_and_null_ids_in_other_blocks(spark, monkeypatch, ids):
    """Rows of one id in different blocks lose the edges of a passage that a lesser document has in part."""
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 400)
    g = np.random.default_rng(2)
    text = lambda n: "".join(map(chr, g.integers(97, 123, n)))
    passages = [text(130) for _ in range(12)]
    rows = [(1, "".join(text(40) + p[:90] for p in passages))]
    rows += [(i, "".join(text(40) + p for p in passages)) for i in ids] + [(ids[0], "".join(p[10:] + text(30) for p in passages))]
    got = sorted(((r.doc_id, bytes(r.kept_bytes)) for r in suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(1)).collect()), key=str)
    assert got == sorted(brute_repeats([(i, t.encode()) for i, t in rows]), key=str)
