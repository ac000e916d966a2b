"""Cross-tokenizer alignment, source mixing and whitening against brute force."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tables import documents, mixed_texts, prose
from trovelake.llm import embedding_whitening, source_mixing, token_alignment

# -- alignment -------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, _, b_path, _ = token_alignment.public_paths()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=b_path)


def tokens_with_bytes(encoders, text):
    """[(id, end)] of both sides by way of offsets and decoded pieces, token by token."""
    a, b = encoders
    if not text:
        return [], []
    from tokenizers.pre_tokenizers import ByteLevel

    letters = sorted(ByteLevel.alphabet())
    order = {}
    spare = 256
    for value in range(256):
        if 33 <= value <= 126 or 161 <= value <= 172 or 174 <= value <= 255:
            order[chr(value)] = value
        else:
            order[chr(spare)] = value
            spare += 1
    assert sorted(order) == letters
    whole = (" " + text).encode()
    sides = []
    for ids, piece in (
        (a.encode(" " + text, add_special_tokens=False).ids,
         lambda i: bytes(order[c] for c in a.id_to_token(i))),
        (b.encode(text), lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
         else b.id_to_piece(i).replace("▁", " ").encode()),
    ):
        end, side, joined = 0, [], b""
        for i in ids:
            joined += piece(i)
            end += len(piece(i))
            side.append((i, end))
        if joined != whole:
            return [], []
        sides.append(side)
    return sides


def brute_alignment(encoders, texts):
    found, counts = [], Counter()
    for text in texts:
        a, b = tokens_with_bytes(encoders, text)
        ends = sorted({e for _, e in a} & {e for _, e in b})
        groups, low = [], 0
        for end in ends:
            groups.append(([i for i, e in a if low < e <= end], [i for i, e in b if low < e <= end]))
            low = end
        links = [(i, j) for i, e in a for j, f in b if e == f]
        counts.update(links)
        found.append((len(a), len(b), groups, links))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    rows = []
    for n_a, n_b, groups, links in found:
        digest = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((n_a, n_b, len(groups), len(links),
                     sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
                     hashlib.sha256(digest.encode()).hexdigest() if digest else ""))
    return rows


ODD = ["a  b\t\tc", " lead", "trail ", "ﬁligree Å ½", "naïve café 中文 😀😀", "x" * 300, "=" * 77,
       "<s> </s> <unk> <|endoftext|>", "▁odd▁", "1234567890 3.14", "​ zero", "ⅷ Ⅷ ٣",
       "don't WON'T", "\x00\x01"]


def test_alignment_equals_brute_force(spark, encoders, monkeypatch):
    monkeypatch.setattr(token_alignment, "CHUNK_BYTES", 700)
    monkeypatch.setattr(token_alignment, "SEGMENT_BYTES", 64)
    texts = mixed_texts(seed=11, n=12) + ODD
    ids = [*range(len(texts) - 3), 1, None, None]      # repeated and null ids
    docs = documents(spark, texts, ids).repartition(3)
    rows = token_alignment.aligned(docs).collect()
    got = sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
                  r.groups_sha256) for r in rows)
    want = sorted((str(i), *row) for i, row in zip(ids, brute_alignment(encoders, texts)))
    assert got == want


def test_links_of_all_kinds(spark, encoders, monkeypatch):
    monkeypatch.setattr(token_alignment, "SEGMENT_BYTES", 32)
    texts = ["unbelievable tokenizers", "", None, prose(random.Random(3), 5), ODD[4]]
    docs = documents(spark, texts)
    want = {"overlap": set(), "end": set(), "group": set()}
    for key, text in enumerate(texts):
        a, b = tokens_with_bytes(encoders, text)
        starts_a, starts_b = ([0, *(e for _, e in side)] for side in (a, b))
        common = {e for _, e in a} & {e for _, e in b}
        for i, (x, e) in enumerate(a):
            for j, (y, f) in enumerate(b):
                row = (key, i, j, x, y)
                if max(starts_a[i], starts_b[j]) < min(e, f):
                    want["overlap"].add(row)
                if e == f:
                    want["end"].add(row)
                if min(c for c in common if c >= e) == min(c for c in common if c >= f):
                    want["group"].add(row)
    for kind, rows in want.items():
        got = token_alignment.links(docs, kind).collect()
        assert len(got) == len(rows) and set(map(tuple, got)) == rows, kind


def test_products_equal_dense_ones():
    rng = np.random.default_rng(4)
    left, right = (rng.random(shape) < 0.3 for shape in ((9, 12), (12, 7)))

    def sparse(dense):
        starts = np.concatenate([[0], np.cumsum(dense.sum(axis=1))])
        return token_alignment.Incidence(starts, np.nonzero(dense)[1], dense.shape[1])

    rows, columns, values = token_alignment.product(sparse(left), sparse(right))
    dense = np.zeros((9, 7), dtype=int)
    dense[rows, columns] = values
    assert (dense == left.astype(int) @ right.astype(int)).all()
    turned = sparse(left).transposed()
    assert (turned.starts == sparse(left.T).starts).all()
    assert (turned.indices == sparse(left.T).indices).all()


def test_fast_encoder_equals_the_other_on_plain_letters(encoders):
    """Every letter that is left to the fast encoder, beside letters, digits, spaces."""
    known = token_alignment.Tokenizers(*token_alignment.public_paths())
    letters = [c for c in map(chr, range(0x10000))
               if not 0xD800 <= ord(c) < 0xE000 and token_alignment.PLAIN.fullmatch(c)]
    texts = [f" a{c} {c}{c}1{c}  {c}\n" for c in letters]
    slow = [e.ids for e in encoders[0].encode_batch(texts, add_special_tokens=False)]
    assert len(letters) > 20_000
    assert [t for t, ids in zip(texts, slow) if known.fast.encode_ordinary(t) != ids] == []


def test_alignment_of_an_empty_table(spark):
    assert token_alignment.aligned(documents(spark, [])).collect() == []


# -- mixing ---------------------------------------------------------------------


def brute_targets(sizes, weights=(1, 2, 3)):
    """Targets in exact fractions, round by round."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = Fraction(sum(sizes.values())), {}
    while True:
        free = [s for s in order if s not in full]
        over = sum(weight[s] for s in free)
        level = (total - sum(full.values())) / over if free else 0
        new = {s: Fraction(3 * sizes[s]) for s in free if weight[s] * level >= 3 * sizes[s]}
        if not new:
            return {**full, **{s: weight[s] * level for s in free}}
        full |= new


def mixture(spark, rows):
    schema = "doc_id long, text string, source string, size string, n long, rank int, key int"
    docs = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], schema).repartition(3)
    return docs, source_mixing.mixed(docs)


def test_mix_reaches_targets(spark):
    rng = random.Random(8)
    rows = []
    for i in range(900):       # a hot source, small sources, a null one
        source = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"s{i % 11}"
        rows.append((i, " ".join(["w"] * rng.choice([1, 400, rng.randint(1, 120)]) + [str(i)]), source))
    rows += [(2000 + i, "the same text " * 9, "hot") for i in range(300)]   # copies
    rows += [(5000, "one row again and again", "s3")] * 40                  # repeated rows
    rows += [(None, "no id", "s4")] * 5 + [(6000, None, "s4"), (6001, "  ", "é"), (6002, "", "z")]
    docs, chosen = mixture(spark, rows)
    got = chosen.collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    wanted = brute_targets(sizes)
    taken, texts = Counter(), {}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert math.isclose(r.target, wanted[r.source], rel_tol=1e-12, abs_tol=1e-9)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        assert math.floor(r.expected) <= r.copies <= math.floor(r.expected) + 1
        taken[r.source] += r.taken
    for source, want in wanted.items():
        assert abs(taken[source] - want) <= max(3, 0.01 * want), source
    # copies of a text share the place of one
    one = [r.expected for r in got if r.source == "hot" and r.doc_id < 2000]
    copy = [r.expected for r in got if r.source == "hot" and r.doc_id >= 2000]
    assert max(copy) < min(one) / 200
    again = Counter((r.doc_id, r.source, r.copies) for r in source_mixing.mixed(
        docs.repartition(5)).collect())
    assert again == Counter((r.doc_id, r.source, r.copies) for r in got)
    written = source_mixing.written(docs, chosen)
    assert written.columns == docs.columns
    have = Counter((r.doc_id, r.text) for r in written.collect())
    want = Counter()
    by_key = {r.key: (r.doc_id, r.size) for r in got}
    for r in got:
        want[by_key[r.key][0], r.key] += r.copies
    assert sorted(have.values()) == sorted(n for n in want.values() if n)


def test_sampling_follows_the_expected_copies(spark, monkeypatch):
    """Over many seeds, a document is drawn about as often as expected."""
    rows = [(i, f"w{i} " * 4 if i < 140 else "copy of one", "a" if i % 2 else "b")
            for i in range(200)]
    drawn, expected, runs = Counter(), {}, 3
    for seed in range(runs):
        monkeypatch.setattr(source_mixing, "SEED", f"seed {seed}")
        for r in mixture(spark, rows)[1].collect():
            drawn[r.doc_id < 140, r.source] += r.copies
            expected[r.doc_id] = (r.doc_id < 140, r.source, r.expected)
    for group in set(e[:2] for e in expected.values()):
        mean = sum(e[2] for e in expected.values() if e[:2] == group) * runs
        assert abs(drawn[group] - mean) <= 4 * math.sqrt(mean) + runs


def test_mix_of_odd_tables(spark):
    for rows in ([], [(1, None, None)], [(1, "", "a"), (2, None, "b")]):
        assert [r.taken for r in mixture(spark, rows)[1].collect()] == [0] * len(rows)
    alone = mixture(spark, [(1, "a b c", "x"), (2, "d", None)])[1].collect()
    assert all(r.copies <= 3 for r in alone)


# -- whitening ----------------------------------------------------------------------


def brute_whitening(vectors, k=8):
    rows = [v for v in vectors if v is not None and all(c is not None and math.isfinite(c)
                                                        for c in v)]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in rows]
    n = len(x)
    sums = [sum(column) for column in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums)] for v in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return n, deviation, centred @ vectors / np.sqrt(values), values / (centred ** 2).sum() * n


def frame(spark, vectors, ids=None):
    schema = "vec_id long, embedding array<float>, component int, n string"
    rows = [(i if ids is None else ids[i], v, 5, "x") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, schema).repartition(4)


def test_whitening_equals_a_dense_solver(spark, monkeypatch):
    monkeypatch.setattr(embedding_whitening, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(6)
    spread = np.array([9, 7, 5, 4, 3, 2.5, 2, 1.5, 1, .5, .2, .1])
    vectors = [[float(np.float32(c)) for c in v] for v in rng.standard_normal((700, 12)) * spread]
    vectors += [vectors[0]] * 300          # many equal vectors
    odd = [None, [None] * 12, [float("nan")] * 12, [float("inf")] * 12, [1.0, 2.0], []]
    rows = embedding_whitening.whitened(frame(spark, vectors + odd)).collect()
    n, deviation, white, explained = brute_whitening(vectors)
    assert len(rows) == n * 8 and {r.n for r in rows} == {n}
    assert max(r.identity_error for r in rows) < 1e-9
    signs = {}
    for r in rows:
        want = white[r.vec_id, r.component - 1]
        sign = signs.setdefault(r.component, math.copysign(1, r.whitened * want))
        assert math.isclose(r.whitened * sign, want, rel_tol=1e-7, abs_tol=1e-9)
        assert math.isclose(r.explained, explained[r.component - 1], rel_tol=1e-9)
        assert r.deviation == deviation[r.vec_id]


def test_whitening_of_degenerate_tables(spark):
    def run(vectors, **options):
        return embedding_whitening.whitened(frame(spark, vectors), **options).collect()

    assert run([]) == run([None, [float("nan")]]) == run([[1.0, 2.0]] * 5) == []
    plane = run([[float(i), float(2 * i), 0.0] for i in range(20)])
    assert {r.component for r in plane} == {1} and plane[0].explained > 0.999
    huge = run([[3e38, 1.0], [-3e38, 2.0], [0.0, 3.0]])
    assert {r.component for r in huge} == {1} and {r.deviation for r in huge} != {None}
    square = run([[a, b] for a in (0.0, 1.0) for b in (0.0, 1.0)])   # equal eigenvalues
    assert len(square) == 8 and max(r.identity_error for r in square) < 1e-12
    repeated = embedding_whitening.whitened(frame(
        spark, [[0.0, 1.0], [2.0, 0.5], [2.0, 0.5]], [None, 7, 7])).collect()
    assert sorted(str(r.vec_id) for r in repeated if r.component == 1) == ["7", "7", "None"]


@pytest.mark.parametrize("matrix", [
    np.eye(6), np.diag([3.0, 3, 3, 1, 1, 0]), np.diag([1e9, 1, 1e-9]), np.array([[2.0]]),
    np.array([[2.0, 1], [1, 2]]), np.ones((5, 5)), np.diag([1.0, 2]) + 1e-14,
], ids=str)
def test_leading_pairs(matrix):
    values, vectors = embedding_whitening.leading_pairs(matrix, 4)
    want = np.linalg.eigvalsh(matrix)[::-1][:4]
    scale = abs(want).max()
    assert np.allclose(values, want, atol=1e-14 * scale, rtol=1e-13)
    assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-13)
    assert np.allclose(matrix @ vectors.T, vectors.T * values, atol=1e-13 * scale)
