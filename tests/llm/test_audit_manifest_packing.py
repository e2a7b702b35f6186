"""Source audit, Merkle manifest and packing against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from meterloom.llm import merkle, packing, sourceaudit, tokenfile  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, tree string, term string, i int"


def corpus(seed=3):
    rng = random.Random(seed)
    words = ["Ab", "ab", "été", "漢字", "x", "yy", "Zz", "ß", "don't", "a1b", "ÀB"]
    rows = []
    for i in range(160):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(0, 40)))
        rows.append((i, text, rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "ü", None])))
    rows += [(200, None, "en", "a"), (201, "", "fr", "only"), (202, "123 !?", "fr", "other"), (None, "no id", "en", "b")]
    rows += [(5, "twice the id", "en", "a"), (None, "no id", "en", "b"), (None, None, None, None)]
    rows += [(7, "same row", "en", "c")] * 40
    rows.append((300, " ".join(f"v{i}" for i in range(9000)), "en", "a"))
    rows.append((301, "q" * 60000, "de", "b"))
    return [(i, t, lang, s, rng.choice([None, 3, 2**63 - 1]), "k", "t", "w", 1) for i, t, lang, s in rows]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# -- source audit ------------------------------------------------------------------------------------------------------


def plain_audit(rows, min_docs=10, top=10):
    n, in_docs, groups = Counter(), Counter(), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        found = ["".join(c.lower() if c.isascii() else c for c in w) for w in found]
        groups.add((lang, source))
        n.update((lang, source, w) for w in found)
        in_docs.update((lang, w) for w in set(found))
    kept = defaultdict(list)
    for (lang, w), docs in in_docs.items():
        if docs >= min_docs:
            kept[lang].append(w)

    def shares(lang, counts):
        total = sum(counts.values()) + 2 * len(kept[lang])
        return {w: 1 + 10**9 * (c + 2) // total for w, c in counts.items()}

    f = lambda p, q: (p - q) ** 2 // (p + q)
    out = set()
    for lang in {g[0] for g in groups}:
        sources = [s for a, s in groups if a == lang]
        counts = {s: {w: n[lang, s, w] for w in kept[lang]} for s in sources}
        p = {s: shares(lang, counts[s]) for s in sources}
        q = shares(lang, {w: sum(counts[s][w] for s in sources) for w in kept[lang]})
        for s in sources:
            pairs = [(-sum(f(p[s][w], p[o][w]) for w in kept[lang]), o.encode()) for o in sources if o != s]
            terms = [(-f(p[s][w], q[w]), w.encode()) for w in kept[lang] if counts[s][w] and p[s][w] > q[w]]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, w.decode(), -v, r + 1) for r, (v, w) in enumerate(ranked)}
    return out


@pytest.mark.parametrize("min_docs", [1, 10, 10**6])
def test_audit_equals_a_plain_count(docs, rows, min_docs, monkeypatch):
    monkeypatch.setattr(sourceaudit, "SHARD_TERMS", 3)
    got = sourceaudit.audit(docs, min_docs).select("lang", "source", "part", "item", "value", "rank").collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == plain_audit(rows, min_docs)


def test_audit_in_blocks_of_sources(docs, rows, monkeypatch):
    monkeypatch.setattr(sourceaudit, "SHARD_TERMS", 1000)
    monkeypatch.setattr(sourceaudit, "TEXT_BYTES", 500)
    monkeypatch.setattr(sourceaudit, "HELD_COUNTS", 50)
    many = docs.withColumn("source", F.concat(F.coalesce("source", F.lit("")), (F.coalesce("doc_id", F.lit(0)) % 90).cast("string")))
    plain = [(i, t, lang, f"{s or ''}{(i or 0) % 90}") for i, t, lang, s, *_ in rows]
    got = {tuple(r) for r in sourceaudit.audit(many, 5).select("lang", "source", "part", "item", "value", "rank").collect()}
    assert got == plain_audit(plain, 5)


def test_audit_splits_sources_into_blocks():
    import pyarrow as pa

    key = tuple(pa.scalar(x) for x in ("en", 0, 0, 1))
    first, second = 3, sourceaudit.BLOCK_SOURCES + 1
    table = pa.table({"place": [first, second, second, 4], "term": [None, None, "w", None], "p": [5, 7, 20, 5]})
    out = sourceaudit._compare(key, table)
    assert {tuple(r.values()) for r in out.to_pylist()} == {("en", 3, second, 15**2 // 25), ("en", 4, second, 15**2 // 25)}


def test_audit_of_nothing(nothing):
    assert sourceaudit.audit(nothing).collect() == []


# -- Merkle manifest ---------------------------------------------------------------------------------------------------


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, more=0):
    i, text, lang, source, n_chars, *_ = row
    n_chars = None if n_chars is None else n_chars + more
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n_chars, text)))


def plain_tree(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[a : a + arity]) for a in range(0, len(below), arity)])
    return levels


def plain_manifest(rows, tampered, arity=2):
    leaves = [(i, r, plain_leaf(r), plain_leaf(r, 1) if tampered(r) else plain_leaf(r)) for i, r in ((r[0], r) for r in rows)]
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {lang: sorted((x for x in leaves if x[1][2] == lang), key=lambda x: (x[0] is not None, x[0] or 0, x[2])) for lang in langs}
    trees = {lang: plain_tree([x[2] for x in own[lang]], arity) for lang in langs}
    crown = plain_tree([trees[lang][-1][0] for lang in langs], arity)
    out = Counter()
    for at, lang in enumerate(langs):
        for k, (doc_id, _, leaf, node) in enumerate(own[lang]):
            siblings, i = "", k
            for levels, place in ((trees[lang], k), (crown, at)):
                i = place
                for level in levels[:-1]:
                    a = i - i % arity
                    left, right = "".join(level[a:i]), "".join(level[i + 1 : a + arity])
                    siblings += left + right
                    node, i = digest(left, node, right), i // arity
            root = crown[-1][0]
            out[doc_id, leaf, trees[lang][-1][0], root, digest(siblings), node, node == root] += 1
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize(("arity", "levels"), [(2, 1), (2, 2), (2, 10), (3, 2), (5, 1)])
def test_manifest_equals_a_plain_tree(docs, rows, arity, levels):
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).alias("n_chars")
    changed = merkle.leaf([F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text")])
    out = merkle.manifest(docs, F.when(F.col("doc_id") % 3 == 0, changed), merkle.Chunks(arity, levels))
    got = Counter(tuple(r) for r in out.select(*COLUMNS).collect())
    assert got == plain_manifest(rows, lambda r: r[0] is not None and r[0] % 3 == 0, arity)
    assert {r.verified for r in out.select("verified").collect()} == {True, False}


def test_paths_lead_from_a_leaf_to_the_root(docs):
    out = merkle.manifest(docs, chunks=merkle.Chunks(2, 3)).collect()
    assert all(r.verified for r in out)
    for r in out:
        node = r.leaf
        for left, right in zip(r.left, r.right, strict=True):
            node = digest(left, node, right)
        assert node == r.root and digest(*(a + b for a, b in zip(r.left, r.right, strict=True))) == r.proof_sha256


def test_folding_hashes_nothing_to_the_left():
    tree = merkle.Tree([f"{i}".encode() for i in range(7)], 3)
    tree.levels[0][2], tree.levels[0][6] = b"gone", b"gone"  # to the left of place 3, and the place itself
    assert tree.fold(3, b"3") == tree.top == tree.fold(6, b"6")
    assert tree.fold(3, b"x") != tree.top


def test_manifest_of_one_row_and_of_nothing(docs, nothing):
    (row,) = merkle.manifest(docs.filter("doc_id = 300")).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof_sha256 == digest() and row.verified
    assert merkle.manifest(nothing).collect() == []


# -- packing -----------------------------------------------------------------------------------------------------------


def test_tournament_finds_the_first_bin_with_room():
    rng = random.Random(4)
    for _ in range(200):
        length = rng.choice([10, 64, 2048])
        sizes = [rng.randrange(1, length + 1) for _ in range(rng.randrange(1, 60))]
        bins, want = [], [None] * len(sizes)
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            spot = next((b for b, used in enumerate(bins) if used + sizes[i] <= length), len(bins))
            bins += [0] if spot == len(bins) else []
            want[i] = (spot, bins[spot])
            bins[spot] += sizes[i]
        assert packing.first_fit_decreasing(sizes, length) == want


@pytest.fixture(scope="module")
def parts(docs):
    return packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), length=64)


def encoded(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return Counter((r[0], *tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1) for r in rows)


@pytest.mark.parametrize("group", [1, 16, 10**6])
def test_every_id_is_packed_once(parts, rows, group):
    placed = packing.place(parts, 64, group).collect()
    blobs = {r.key: r.ids for r in parts.select("key", "ids").collect()}
    assert sorted(blobs) == sorted(r.key for r in placed)
    assert all(zlib.crc32(blobs[r.key]) == r.ids_crc32 and len(blobs[r.key]) == 4 * r.length <= 256 for r in placed)
    ids = lambda raw: [int.from_bytes(raw[a : a + 4], "little") for a in range(0, len(raw), 4)]
    # Pieces of a document have consecutive keys.
    texts, held = Counter(), []
    for r in sorted(placed, key=lambda r: r.key):
        assert r.start == len(held)
        held += ids(blobs[r.key])
        if len(held) == r.doc_tokens:
            texts[(r.doc_id, *held)] += 1
            held = []
    assert not held and texts == encoded(rows)
    inside = defaultdict(list)
    for r in placed:
        inside[r.sequence_id].append((r.offset, r.length))
    for spots in inside.values():
        spots.sort()
        assert [o for o, _ in spots] == [sum(n for _, n in spots[:k]) for k in range(len(spots))]
        assert sum(n for _, n in spots) <= 64


def test_sequences_hold_the_ids_of_their_pieces(parts):
    placed = packing.place(parts, 64)
    got = packing.sequences(parts, placed).collect()
    n = placed.agg(F.sum("length"), F.count_distinct("sequence_id")).first()
    assert sum(r.n_tokens for r in got) == n[0] and len(got) == n[1]
    assert all(len(r.ids) == 4 * r.n_tokens and sum(p.length for p in r.pieces) == r.n_tokens for r in got)
    crcs = {(r.doc_id, r.start, r.ids_crc32) for r in placed.collect()}
    for r in got:
        at = 0
        for p in r.pieces:
            raw = bytes(r.ids[at : at + 4 * p.length])
            assert (p.doc_id, p.start, zlib.crc32(raw)) in crcs
            at += 4 * p.length
    total = packing.padding(placed, 64).first()
    sizes = [r.n_tokens for r in got]
    assert total.tokens == sum(sizes) and total.padding == sum(64 - s for s in sizes if s & (s - 1))


def test_packing_nothing(nothing):
    parts = packing.pieces(nothing, public_tokenizers.path("word_bpe_49k.json"))
    assert packing.place(parts).collect() == [] and packing.sequences(parts, packing.place(parts)).collect() == []


# -- words of the token encoder ----------------------------------------------------------------------------------------


def test_every_letter_before_a_sign_is_encoded_as_the_library_does():
    import numpy as np
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        vocabulary = f.read()
    library, encoder = Tokenizer.from_str(vocabulary), tokenfile.Encoder(vocabulary)
    letters = [chr(c) for c in range(128, 0x3400) if chr(c).isalpha()]
    texts = [f"a{c}." for c in letters] + [f"{c}," for c in letters] + [f"{c}b" for c in letters]
    want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert encoder.by_word and encoder.encode(texts) == want


def test_other_vocabularies_are_given_whole_texts():
    import numpy as np
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        vocabulary = f.read()
    texts = ["Two  Words\n", "", "É."]
    want = [np.array(e.ids, "<u4").tobytes() for e in Tokenizer.from_str(vocabulary).encode_batch(texts, add_special_tokens=False)]
    assert tokenfile.Encoder(vocabulary).encode(texts) == want
