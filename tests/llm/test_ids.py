"""Shards, whitening and the alignment of two tokenizers against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from leafmill.llm import alignment, sharding, whitening
from tests.llm.data import frame, found, prose, rows

# Shards.


def plain_shard(key, weights):
    bids = []
    for shard, w in enumerate(weights):
        u = (int(hashlib.md5(f"{key}@{shard}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        bids.append((-math.log(u) / w, shard))
    return min(bids)[1]


def plain_placements(data, shards):
    out, slots = [], defaultdict(int)

    def order(r):
        i, body = r[0], (r[1] or "").encode()
        key = f"{'' if i is None else i}/{len(body) + 1}/{zlib.crc32(body)}"
        return hashlib.md5(key.encode()).hexdigest()[:13], i is not None, i or 0, len(body), zlib.crc32(body)

    for i, text, _ in sorted(data, key=order):
        body, key = (text or "").encode(), "" if i is None else str(i)
        shard = plain_shard(key, [1.0] * shards)
        out.append((i, len(body) + 1, zlib.crc32(body), "key", shard, slots[shard], plain_shard(key, [1.0] * (shards + 1))))
        slots[shard] += 1
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket", [4096, 3])
def test_placements(spark, monkeypatch, bucket):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(sharding, "COPIES", 4)
    data = rows() + [(7, "again", "x")] * 11 + [(None, None, None)] * 3 + [(None, "a", "x")]
    assert found(sharding.placements(frame(spark, data, bucket == 3))) == plain_placements(data, 8)
    assert sharding.placements(frame(spark, [])).collect() == []


def test_weights_set_the_shares_and_growth_moves_into_the_new_shard_only(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    weights = [1.0, 2.0, 0.5]
    shards = {}
    for name, w in (("old", weights), ("more", [*weights, 1.5]), ("heavier", [1.0, 3.0, 0.5])):
        shards[name] = {r["doc_id"]: r["shard"] for r in sharding.sharded(ids, w).collect()}
    share = Counter(shards["old"].values())
    assert [share[i] / 20_000 for i in range(3)] == pytest.approx([w / 3.5 for w in weights], abs=0.02)
    assert all(shards["old"][i] == plain_shard(str(i), weights) for i in range(0, 20_000, 97))
    assert {s for i, s in shards["more"].items() if s != shards["old"][i]} == {3}
    assert {s for i, s in shards["heavier"].items() if s != shards["old"][i]} == {1}
    with pytest.raises(ValueError):
        sharding.sharded(ids, [1.0, 0.0])


def test_written_shards_hold_every_row(spark, tmp_path):
    docs = frame(spark, rows() * 2, True)
    sharding.write_shards(docs, str(tmp_path / "out"), [1.0] * 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert found(back.select(*(f"`{c}`" for c in docs.columns))) == found(docs)
    assert all(r["shard"] == plain_shard(str(r["doc_id"]), [1.0] * 4) for r in back.collect())


# Whitening.

VECTORS = "vec_id long, embedding array<float>, label int, x string, n int"


def vectors(spark, data):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in data], VECTORS).repartition(3)


def plain_whitened(data, dim, wanted=4):
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in data if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(v) for _, v in kept}), float)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    centred = fit - fit.mean(axis=0)
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1], turn[:, ::-1]
    return kept, n, sums, values[:wanted], turn[:, :wanted], values.sum()


def check_whitened(got, data, dim):
    kept, n, sums, values, turn, trace = plain_whitened(data, dim)
    count = min(4, dim)
    by_id = defaultdict(list)
    for r in got:
        by_id[r["vec_id"]].append(r)
    assert len(got) == count * len(kept) and set(by_id) == {i for i, _ in kept}
    want, have = defaultdict(list), []
    for i, v in kept:
        z = (np.array(v) - np.array(sums) / n) @ turn / np.sqrt(values)
        for c in range(count):
            want[i].append((c + 1, n, sum((n * x - s) ** 2 for x, s in zip(v, sums, strict=True)), z[c]))
    sign = np.zeros(count)
    for i, rs in by_id.items():
        for r, w in zip(sorted(rs, key=lambda r: r["component"]), sorted(want[i], key=lambda w: w[0]), strict=True):
            assert (r["component"], r["n"], r["deviation"]) == w[:3]
            assert abs(r["whitened"]) == pytest.approx(abs(w[3]), abs=1e-9)
            s = np.sign(r["whitened"] * w[3])
            assert abs(w[3]) < 1e-6 or sign[r["component"] - 1] in (0, s)
            sign[r["component"] - 1] = s
            assert r["explained"] == pytest.approx(values[r["component"] - 1] / trace, rel=1e-9)
            assert r["identity_error"] < 1e-9
            have.append(r)
    return have


def test_whitened_table_matches_a_dense_solution(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    data = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    check_whitened(whitening.whitened(table).collect(), data, 64)


def test_nulls_repeats_and_odd_vectors(spark):
    dice = np.random.default_rng(5)
    data = [(i, dice.normal(size=6).tolist()) for i in range(60)]
    data += [(100, data[0][1]), (100, data[0][1]), (101, None), (102, [1.0] * 5 + [None]), (103, [float("nan")] + [0.0] * 5), (104, [float("inf")] + [0.0] * 5)]
    data += [(105, []), (106, [1.0, 2.0]), (107, [-0.0] * 6), (None, data[3][1])]
    check_whitened(whitening.whitened(vectors(spark, data)).collect(), data, 6)


def test_few_vectors_and_flat_directions(spark):
    assert whitening.whitened(vectors(spark, [])).collect() == []
    assert whitening.whitened(vectors(spark, [(1, [1.0, 2.0])] * 3)).collect() == []
    got = whitening.whitened(vectors(spark, [(1, [1.0, 2.0, 0.0]), (2, [2.0, 4.0, 0.0])])).collect()
    assert sorted((r["vec_id"], r["component"]) for r in got) == [(1, 1), (2, 1)]
    assert sorted(r["whitened"] for r in got) == pytest.approx([-1, 1]) and got[0]["explained"] == pytest.approx(1)


def test_deviations_beyond_a_long_are_null_and_exact_below():
    x = np.array([[2**40, 0], [2**30, -5]])
    assert whitening._deviations(x, 1, (0, 0)) == [None, 2**60 + 25]


@pytest.mark.parametrize("spectrum", ["flat", "steep", "equal"])
def test_eigenpairs(spectrum):
    dim, dice = 120, np.random.default_rng(2)
    values = {"flat": np.linspace(2, 1, dim), "steep": 2.0 ** -np.arange(dim), "equal": np.r_[[5.0, 5.0, 4.0, 3.0], np.ones(dim - 4)]}[spectrum]
    turn = np.linalg.qr(dice.standard_normal((dim, dim)))[0]
    v = turn * values @ turn.T
    passes = []

    def times(q):
        passes.append(q.shape[1])
        return v @ q

    got, vectors, products = whitening.eigenpairs(times, dim, 4)
    assert got == pytest.approx(values[:4], rel=1e-12) and len(passes) < 150
    assert np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-12
    assert np.abs(products - vectors * got).max() < 1e-12 * got[0]
    if spectrum != "equal":
        assert np.abs(np.abs((vectors * turn[:, :4]).sum(axis=0)) - 1).max() < 1e-12


# Alignment.

BYTE = Tokenizer.from_file(f"{alignment.TOKENIZERS}/{alignment.BYTE_BPE}")
BYTE.encode_special_tokens = True
PIECE = sentencepiece.SentencePieceProcessor(model_file=f"{alignment.TOKENIZERS}/{alignment.PIECE_BPE}")
LETTERS = alignment.byte_letters()
SPELT = {i: bytes(LETTERS[c] for c in t) for t, i in BYTE.get_vocab().items() if all(c in LETTERS for c in t)}


def plain_tokens(text):
    """Ids and bytes of both tokenizers' tokens; none where their bytes are not the text's."""
    if not text:
        return [], [], [], []
    a, b = BYTE.encode(f" {text}", add_special_tokens=False).ids, PIECE.encode(text)
    a_bytes = [SPELT[i] for i in a]
    pieces = [PIECE.id_to_piece(i) for i in b]
    b_bytes = [bytes([int(p[3:5], 16)]) if PIECE.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces, strict=True)]
    whole = f" {text}".encode()
    return (a, b, a_bytes, b_bytes) if b"".join(a_bytes) == whole == b"".join(b_bytes) else ([], [], [], [])


def plain_groups(text):
    a, b, a_bytes, b_bytes = plain_tokens(text)
    groups, i, j, at_a, at_b, left, right = [], 0, 0, 0, 0, [], []
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a):
            left.append(a[i])
            at_a += len(a_bytes[i])
            i += 1
        else:
            right.append(b[j])
            at_b += len(b_bytes[j])
            j += 1
        if at_a == at_b:
            groups.append((left, right))
            left, right = [], []
    return groups


def plain_report(data):
    groups = [plain_groups(t) for _, t, _ in data]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    docs = Counter(k for own in links for k in own)
    best = defaultdict(int)
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    out = []
    for (i, _, _), g, own in zip(data, groups, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        told = hashlib.sha256(text.encode()).hexdigest() if text else ""
        n_best = sum(n for k, n in own.items() if docs[k] == best[k[0]])
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(own.values()), n_best, sum(n * docs[k] for k, n in own.items()), told))
    return sorted(out, key=repr)


def awkward():
    rng = random.Random(4)
    texts = ["", " ", "  ", "a ", " a", "a  b", "\n", "a\n b", "x\n\n  y \t z", "a▁b", "<|endoftext|> <s> </s>", "it's ’tis don't", "漢字かな交じり文", "ﬁ a　b\x1f c", "é́", "\x00 a"]
    texts += ["".join(rng.choice("ab \n\té漢▁<>0") for _ in range(rng.randrange(60))) for _ in range(40)]
    texts += ["=" * 3000, " " * 3000 + "x", prose(rng, 3000, 10**6), "a" * 5000 + " b", "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(2000))]
    return [(1000 + i, t, "x") for i, t in enumerate(texts)]


@pytest.mark.parametrize("small", [False, True])
def test_link_report(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(alignment, "BUCKET_PAIRS", 300)
        monkeypatch.setattr(alignment, "SLICE_PAIRS", 100)
    data = rows() + awkward() + [(5, "a b c", "x")] * 3 + [(None, "again and again", None)] * 2
    assert found(alignment.link_report(frame(spark, data, small))) == plain_report(data)
    assert alignment.link_report(frame(spark, [])).collect() == []


def test_alignments(spark):
    data = awkward()
    got = {r["doc_id"]: r for r in alignment.alignments(frame(spark, data)).collect()}
    for i, text, _ in data:
        r, groups = got[i], plain_groups(text)
        a, b = [0, *r["a_cuts"]], [0, *r["b_cuts"]]
        assert [(r["a"][a[g] : a[g + 1]], r["b"][b[g] : b[g + 1]]) for g in range(len(groups))] == groups
        assert len(r["a_cuts"]) == len(r["b_cuts"]) == len(groups)


ENCODER = alignment.Encoder(alignment.Tokenizers.read())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab c\n\té漢▁'s.0 \x1f "), max_size=40) | st.text(max_size=30), max_size=5))
def test_words_are_encoded_as_in_their_text(texts):
    ids, bounds = ENCODER.encoded(texts)
    for n, text in enumerate(texts):
        a, b, _, _ = plain_tokens(text)
        assert [ids[s][bounds[s][n] : bounds[s][n + 1]].tolist() for s in (0, 1)] == [a, b]


def test_words_kept_and_forgotten(monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_WORDS", 5)
    monkeypatch.setattr(alignment, "LONG_WORD", 4)
    encoder = alignment.Encoder(alignment.Tokenizers.read())
    rng = random.Random(8)
    for _ in range(10):
        texts = [prose(rng, 20, 50) + rng.choice(["", " ", " longer words follow here", "\n"]) for _ in range(3)]
        ids, bounds = encoder.encoded(texts)
        for n, text in enumerate(texts):
            a, b, _, _ = plain_tokens(text)
            assert [ids[s][bounds[s][n] : bounds[s][n + 1]].tolist() for s in (0, 1)] == [a, b]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)), st.integers(60, 70)), max_size=4))
def test_common_ends(cases):
    ends, bounds, want, base = [[], []], [[0], [0]], [], 0
    for a, b, last in cases:
        sides = [sorted({*x, last}) for x in (a, b)]
        want += [(len(ends[0]) + i + 1, len(ends[1]) + sides[1].index(x) + 1) for i, x in enumerate(sides[0]) if x in sides[1]]
        for s in (0, 1):
            ends[s] += [base + x for x in sides[s]]
            bounds[s].append(len(ends[s]))
        base += last
    got = alignment.common_ends([np.array(e, np.int64) for e in ends], [np.array(b, np.int64) for b in bounds])
    assert list(zip(*(g.tolist() for g in got), strict=True)) == want


def test_large_groups_are_linked_in_chunks(monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK", 7)
    rng = np.random.default_rng(3)
    ids = [rng.integers(0, 5, 40), rng.integers(0, 4, 33)]
    a_cut, b_cut, of = np.array([3, 4, 30, 40]), np.array([1, 9, 30, 33]), np.array([0, 0, 1, 2])
    want = Counter()
    for g in range(4):
        for x in ids[0][(a_cut[g - 1] if g else 0) : a_cut[g]]:
            for y in ids[1][(b_cut[g - 1] if g else 0) : b_cut[g]]:
                want[int(of[g]), int(x * 4 + y)] += 1
    got = alignment._linked_pairs(ids, a_cut, b_cut, of, 5, 4)
    assert {(t, p): n for t, p, n in zip(*(x.tolist() for x in got), strict=True)} == want
