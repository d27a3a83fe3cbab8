"""Whitening against eigh, spelling variants against all pairs, sentence pieces against the library."""

import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tablepact.llm import spelling_variants as V
from tablepact.llm import whitening as W
from tablepact.llm.sentence_pieces import Pieces, decode, encode

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# ---------------------------------------------------------------- whitening
def whitened(spark, rows, kind="float"):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", 1) for i, v in rows],
                               f"vec_id long, embedding array<{kind}>, component string, n int")
    return W.whiten(df).toPandas()


def brute(vectors):
    x = np.floor(64 * np.asarray(vectors, dtype=np.float32).astype(float)).astype(np.int64) + 1000000
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    c = u - s / n
    values, vecs = np.linalg.eigh(c.T @ c / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    k = min(16, int((values > 1e-9 * values[0]).sum()))
    dev = ((n * x.astype(object) - s.astype(object)) ** 2).sum(axis=1)
    return (x - s / n) @ vecs[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum(), [int(d) for d in dev], n


def test_whitening_like_eigh(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(300, 20)) * np.linspace(1, 3, 20)
    v[50:90] = v[7]
    odd = [None, [], [None] * 20, [float("nan")] * 20, [float("inf")] + [0.0] * 19, [1.0, 2.0], [1e300] * 20]
    got = whitened(spark, [*enumerate(v), *((1000 + i, o) for i, o in enumerate(odd)), (None, v[3]), (4, v[4])])
    want, explained, dev, n = brute(v)
    assert len(got) == 302 * 16 and set(got.n) == {n} and got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9
    assert not got.vec_id.ge(1000).any() and got.vec_id.isna().sum() == 16 and (got.vec_id == 4).sum() == 32
    one = got[got.vec_id.notna()].drop_duplicates(["vec_id", "component"])
    table = one.pivot(index="vec_id", columns="component", values="whitened").loc[range(300)].to_numpy()
    assert np.abs(table * np.sign((table * want).sum(axis=0)) - want).max() < 1e-8
    assert np.allclose(one.groupby("component").explained.first(), explained, rtol=1e-10)
    assert one[one.component == 1].set_index("vec_id").loc[range(300)].deviation.tolist() == dev


@pytest.mark.parametrize("vectors, components", [
    (np.vstack([np.eye(5), -np.eye(5)]), 5),  # one eigenvalue, five times
    (np.random.default_rng(0).integers(-50, 50, (40, 3)) @ np.random.default_rng(1).integers(-3, 3, (3, 8)), 3),  # rank 3
    (np.outer(np.arange(50), [1, 0]) + np.outer(np.arange(50) % 2, [0, 0.015625]), 2),  # eigenvalues far apart
    (np.array([[1.0, 2.0], [1.0, 2.0]]), 0), (np.array([[3.0, 4.0]]), 0)])
def test_whitening_of_degenerate_tables(spark, vectors, components):
    got = whitened(spark, list(enumerate(vectors)), "double")
    assert len(got) == components * len(vectors)
    if components:
        assert got.identity_error.max() < 1e-9 and abs(got.groupby("component").explained.first().sum() - 1) < 1e-9


def test_whitening_of_nothing(spark):
    assert len(whitened(spark, [])) == 0 and len(whitened(spark, [(1, None)])) == 0


def test_huge_components_are_exact(spark):
    v = np.random.default_rng(3).normal(size=(30, 3)) * 1e12
    got = whitened(spark, list(enumerate(v)), "double")
    assert len(got) == 90 and got.identity_error.max() < 1e-9 and got.deviation.isna().all()


def test_characteristic_polynomial(spark):
    a = np.random.default_rng(2).integers(-9, 9, (12, 6))
    m = (a.T @ a).tolist()
    c = W.characteristic_polynomial(spark, m)
    assert np.allclose(np.poly(np.array(m, dtype=float))[::-1], np.array(c, dtype=float), rtol=1e-9)
    diagonal = [[5 * (i == j) * (i < 3) + 2 * (i == j == 3) for j in range(5)] for i in range(5)]
    roots = W.largest_roots(W.characteristic_polynomial(spark, diagonal), 5)
    assert [(round(r.low / 2**r.shift, 9), r.multiplicity) for r in roots] == [(5, 3), (2, 1)]
    tiny = 10**9
    p = [1, 0]  # (t - 10^9)(t - 10^9 - 1)(t - 1): neighbours a billionth apart
    c = [1]
    for root in (tiny, tiny + 1, 1):
        c = [a - root * b for a, b in zip([0, *c], [*c, 0], strict=True)]
    roots = W.largest_roots(c, 3)
    assert [(r.low / 2**r.shift, r.multiplicity) for r in roots] == [(tiny + 1, 1), (tiny, 1), (1, 1)] and p


# ---------------------------------------------------------------- spelling variants
def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(docs):
    import re
    counts = {}
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    around = {w: [v for v in words if near(w, v)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v), default=None) for w, vs in around.items()}
    form = {w: v if v is not None and words[v] >= 5 * words[w] else None for w, v in best.items()}

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(around[w]), words[form[w]] if form[w] else None) for w, n in words.items())


def rows(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    stems = ["colour", "calour", "colours", "analyse", "analyze", "banana", "bananas", "Größere", "größern", "ÀÉÎÕÜß", "aaaaaa", "aaaaaaa", "aaaaaab", "listen", "silent", "tinsel"]
    docs = []
    for i in range(400):
        words = [rng.choice(stems[: 1 + rng.randrange(len(stems))]) for _ in range(rng.randrange(60))]
        docs.append((i, rng.choice([" ", "-", "1"]).join(words)))
    return [*docs, (500, None), (501, ""), (None, "colour " * 30), (502, "Colour" * 3), (502, "x" * 20000), docs[3], docs[3]]


@pytest.mark.parametrize("tile", [4096, 2])
def test_variants_like_all_pairs(spark, texts, monkeypatch, tile):
    monkeypatch.setattr(V, "TILE", tile)
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in texts], "doc_id long, text string, n int, word string")
    got = rows(V.variants(df))
    assert got == plain_variants(texts) and len(got) > 10 and any(r[1] for r in got)


def test_chains_of_forms_end_at_the_root(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "zzzzzz": 9, "zzzzzy": 44, "zzzzyy": 44}
    got = V.grouped(spark.createDataFrame(list(counts.items()), "word string, n long"))
    root = {r["word"]: r["root"] for r in got.collect()}
    assert {root[w] for w in list(counts)[:5]} == {"aabbbb"} and root["zzzzzz"] == "zzzzzz"
    assert V.grouped(spark.createDataFrame([], "word string, n long")).count() == 0


def test_every_near_pair_shares_a_signature(spark):
    rng = random.Random(8)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randint(6, 9))) for _ in range(700)}
    df = spark.createDataFrame([(w, 5) for w in sorted(words)], "word string, n long")
    got = {tuple(r) for r in V.near_pairs(df).select("a", "b").collect()}
    assert got == {(a, b) for a in words for b in words if a != b and near(a, b)}


# ---------------------------------------------------------------- sentence pieces
@pytest.fixture(scope="module")
def pieces():
    with open(MODEL, "rb") as f:
        return Pieces(f.read())


def test_pieces_like_the_library(pieces):
    rng = random.Random(7)
    vocabulary = list(pieces.id)
    signs = "abcdefgthe  \n\t\r▁éß中文字😀0123.,'-<>_AB́\x00"
    texts = ["", " ", "\n", "▁", "<s>", "<0x41>", "<unk>", "ab" * 5000, "x" * 3000, " " * 500, "​", "a\u0000b"]
    for _ in range(3000):
        texts.append("".join(rng.choice(signs) for _ in range(rng.choice([3, 12, 60]))))
        texts.append("".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 6))).replace("▁", rng.choice([" ", "▁"])))
        texts.append("".join(rng.choice([" " * rng.randint(1, 40), "the", "=", "\n", "}"]) for _ in range(rng.randint(1, 8))))
    for t in texts:
        ids = pieces.encode(t)
        assert ids.tolist() == pieces.library.encode(t), t
        assert pieces.decode(ids) == (pieces.library.decode(ids.tolist()) if len(ids) else "")


def test_backtracking_needs_no_merging_of_whole_chunks(pieces):
    for word in ("▁unbelievable", "▁international", "zzzzzzyx", "▁aabbaabb"):
        assert pieces.backtracked(word) == pieces.merged(word)


def test_encode_and_decode_tables(spark):
    texts = ["Hello  world\n", None, "", "naïve 中文 " * 3000, "Hello  world\n"]
    df = spark.createDataFrame([(i, t, "kept", [1]) for i, t in enumerate(texts)], "doc_id long, text string, made string, ids array<int>")
    got = {r["doc_id"]: r for r in decode(encode(df, MODEL), MODEL).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for i, t in enumerate(texts):
        assert got[i]["ids"] == library.encode(t or "") and got[i]["made"] == "kept" and got[i]["text"] == t
        assert got[i]["decoded"] == (library.decode(got[i]["ids"]) if got[i]["ids"] else "")
    assert encode(df.filter(F.lit(False)), MODEL).count() == 0


def test_models_that_are_not_merge_types_are_refused():
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    with pytest.raises(ValueError):
        Pieces(proto.SerializeToString())


def test_quality_reads_each_text_once(spark, sf, monkeypatch):
    import corpus_pipeline

    seen, score = [], corpus_pipeline.score
    monkeypatch.setattr(corpus_pipeline, "score", lambda docs, model: seen.append(docs.dtypes) or score(docs, model))
    docs = corpus_pipeline.table(spark, sf, "documents").select("doc_id", "text", "lang")
    kept = corpus_pipeline.quality(spark, docs, sf)
    assert seen[0] == docs.dtypes and kept.dtypes == docs.dtypes
    named = docs.withColumn("score", docs["lang"])  # a column of the table that has the score's name stays
    same = corpus_pipeline.quality(spark, named, sf)
    assert same.dtypes == named.dtypes and sorted(same.drop("score").collect()) == sorted(kept.collect())
    assert same.filter("score = lang").count() == same.filter("lang IS NOT NULL").count()
