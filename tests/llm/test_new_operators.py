"""Operators 11 to 13 against plain versions and the tokenizers library."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from starlane.llm import bpe, conversation_trie, list_ranking, whitening
from starlane.llm.oracle import ORACLE
from starlane.llm.queries import QUERIES, tokenizer_path
from tests.llm import brute_new
from tests.llm.cases import SMALL, awkward, pairs, small_documents, write_tables

CONVERSATIONS = "conv_id long, turn long, role string, text string"
VECTORS = "vec_id long, embedding array<float>, label int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fuzzed(n, seed=3):
    r = random.Random(seed)
    letters = "aäöüßéñabcdeXYZ'ÄÉ  \t\n.,;:!?0129²½ªµº×÷İſ́̇  日本語😀<|>endoftextΣσςẞǅ_-/@#Å한\x1c\x00\x7f"
    return ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_codec_agrees_with_the_library(name):
    from tokenizers import Tokenizer

    path = tokenizer_path(name)
    library, own = Tokenizer.from_file(path), bpe.BpeCodec(path)
    texts = [*fuzzed(3000), *[t for _, t in small_documents()], None, "", "a" * 5000, "xyz" * 700 + "é" * 300]
    texts += ["<|endoftext|>a<|startoftext|>don't we'll I'M <|endoftext|><|ENDOFTEXT|>", "a\n<|startoftext|>\n"]
    for at in range(0, len(texts), 400):
        part = texts[at : at + 400]
        ids = own.encode(pa.array(part, pa.string()))
        want = [library.encode(t or "", add_special_tokens=False).ids for t in part]
        assert ids.to_pylist() == want
        assert own.decode(ids).to_pylist() == [library.decode(x, skip_special_tokens=False) for x in want]


def test_codec_forgets_and_learns_anew(monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_PIECES", 10)
    own = bpe.BpeCodec(tokenizer_path("word_bpe_49k.json"))
    texts = pa.array([t for _, t in small_documents()][:50])
    first = own.encode(texts)
    assert own.encode(texts).equals(first) and own.encode(texts.slice(5, 20)).to_pylist() == first.to_pylist()[5:25]


def test_codec_merges_long_words_by_the_same_order():
    own = bpe.BpeCodec(tokenizer_path("word_bpe_49k.json")).bpe
    r = random.Random(1)
    for _ in range(200):
        word = "".join(r.choice("abnthei") for _ in range(r.randint(2, 90))).encode()
        parts = own.first[list(word)].tolist()
        parts[-1] = int(own.last[word[-1]])
        assert own.merge([word])[0].tolist() == own._merge_long(parts)


@pytest.fixture(scope="module")
def odd_documents(spark, tmp_path_factory):
    return write_tables(spark, str(tmp_path_factory.mktemp("odd11")), awkward())


def test_codec_query(spark, odd_documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    for folder, rows in ((SMALL, small_documents()), (odd_documents, pairs(awkward()))):
        want = []
        for d, t in rows:
            ids = library.encode(t or "", add_special_tokens=False).ids
            want.append((d, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
        got = QUERIES["op11_bpe_codec"](spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
        assert sorted(map(tuple, got.collect())) == sorted(want)


def test_codec_decodes_lists_of_ids(spark):
    path = tokenizer_path("word_bpe_49k.json")
    docs = spark.createDataFrame([(1, "Some words"), (None, None)], "doc_id long, text string")
    back = bpe.decoded(bpe.encoded(docs, path), path)
    assert {(r.doc_id, r.text) for r in back.collect()} == {(1, "some</w> words</w>"), (None, "")}
    odd = spark.createDataFrame([(1, None), (2, [-1, 10**6, 0])], "doc_id long, ids array<int>")
    assert {(r.doc_id, r.text) for r in bpe.decoded(odd, path).collect()} == {(1, ""), (2, "!")}


def talks():
    """A long conversation, ties, nulls, copies, a common first turn, turnless ones, negative ids."""
    rows = [(c, t, "user" if t % 2 else None, f"turn {t} of {c % 7 if c < 60 else 3}") for c in range(0, 130, 3) for t in range(c % 5 + 1)]
    rows += [(40, t, "user", f"word {t % 11}") for t in range(3500)] + [(41, t, "user", f"word {t % 11}") for t in range(2200)]
    rows += [(c, None, None, None) for c in (2, 2, 7, 1000)] + [(c, 5, "user", "same") for c in (7, 7, 1001)]
    rows += [(-3, 0, "user", "below zero"), (-20, 0, "user", "base"), (2**40, 1, "a", "x y"), (None, 1, "user", "nobody"), (5, 1, "user", " \n ")]
    rows += [(c, 0, "system", "the same first turn") for c in range(2000, 2090)]
    return rows


@pytest.fixture(scope="module")
def odd_talks(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd12"))
    frame = spark.createDataFrame(talks(), CONVERSATIONS).selectExpr("*", "'x' as a", "1 as words", "2 as `part`", "3 as seq", "4 as _r")
    frame.repartition(5).write.parquet(f"{path}/conversations.parquet")
    return path


def trie_rows(frame):
    return sorted(map(tuple, frame.select(*brute_new.TRIE_COLUMNS).collect()))


def test_trie_of_small_and_odd_conversations(spark, odd_talks):
    small = duckdb.sql(f"select conv_id, turn, role, text from '{SMALL}/conversations.parquet'").fetchall()
    assert trie_rows(QUERIES["op12_conversation_trie"](spark, SMALL)) == brute_new.trie(small)
    # Ties of one turn are ordered by a hash, so the plain version gets them equal.
    assert trie_rows(QUERIES["op12_conversation_trie"](spark, odd_talks)) == brute_new.trie(talks())


@pytest.mark.parametrize("block", [2, 64, 3000])
def test_trie_does_not_depend_on_blocks(spark, odd_talks, block):
    found = conversation_trie.prefix_trie(spark, spark.read.parquet(f"{odd_talks}/conversations.parquet").where("conv_id <> 40 and conv_id <> 41"), block=block)
    assert trie_rows(found) == brute_new.trie([r for r in talks() if r[0] not in (40, 41)])


def test_trie_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], CONVERSATIONS).write.parquet(f"{tmp_path}/conversations.parquet")
    assert QUERIES["op12_conversation_trie"](spark, str(tmp_path)).count() == 0


def test_trie_sql_agrees_with_the_plain_version(spark):
    duckdb.sql(f"create or replace view conversations as select * from '{SMALL}/conversations.parquet'")
    names = [c for c in brute_new.TRIE_COLUMNS if c != "n_nodes"]
    got = duckdb.sql(f"select {', '.join(names)} from ({ORACLE['op12_conversation_trie']})").fetchall()
    want = brute_new.trie(duckdb.sql("select conv_id, turn, role, text from conversations").fetchall())
    at = brute_new.TRIE_COLUMNS.index("n_nodes")
    assert sorted(got) == sorted(r[:at] + r[at + 1 :] for r in want)


def test_list_is_ranked_wherever_its_elements_lie(spark):
    r = random.Random(4)
    order = list(range(900))
    r.shuffle(order)
    weights = [r.randint(0, 9) for _ in order]
    rows = [(i, i % 2, *((order[k + 1], order[k + 1] % 2) if k + 1 < len(order) else (None, None)), 1, weights[i], 0) for k, i in enumerate(order)]
    found = {x.r: (x.steps, x.leaves) for x in list_ranking.suffix_sums(spark, spark.createDataFrame(rows, list_ranking.ELEMENT), block=50).collect()}
    total, want = 0, {}
    for k, i in enumerate(reversed(order)):
        total += weights[i]
        want[i] = (k + 1, total)
    assert found == want


def vector_table(spark, path, rows):
    spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' as x", "1 as id", "2 as n").write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def check_whitening(rows, got, wanted=4, scale=1e-9):
    n, shares, deviation, white = brute_new.whitening(rows, wanted)
    by_id = {}
    for r in got:
        by_id.setdefault((r.vec_id, r.component), []).append(r)
    assert len({(i, c) for i, c in by_id}) == len(white) * len(shares)
    signs = {}
    for (i, c), found in by_id.items():
        for r in found:
            assert r.n == n and r.deviation == deviation[i] and math.isclose(r.explained, shares[c - 1], rel_tol=1e-9)
            sign = signs.setdefault(c, 1 if r.whitened * white[i][c - 1] > 0 else -1) if abs(white[i][c - 1]) > 0.1 else signs.get(c)
            assert sign is None or abs(sign * r.whitened - white[i][c - 1]) < scale
            assert r.identity_error < 1e-9


def test_whitening_of_small_and_odd_vectors(spark, tmp_path):
    small = duckdb.sql(f"select vec_id, embedding from '{SMALL}/embeddings.parquet'").fetchall()
    check_whitening(small, QUERIES["op13_embedding_whitening"](spark, SMALL).collect())
    r = np.random.default_rng(2)
    rows = [(i, (r.standard_normal(6) * [3, 2, 1, 0.5, 0.2, 0.1] + 40).astype(np.float32).tolist(), None) for i in range(80)]
    rows += [rows[3], (None, rows[4][1], 1), (100, rows[5][1], 1)]
    bad = [(200, None, 1), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (202, [float("nan")] * 6, 1), (203, [1.0] * 5 + [float("-inf")], 1), (204, [], 1), (205, [1.0], 1)]
    folder = vector_table(spark, tmp_path / "odd", rows + bad)
    found = QUERIES["op13_embedding_whitening"](spark, folder).collect()
    assert len(found) == 4 * len(rows)
    check_whitening([x[:2] for x in rows], found)


@pytest.mark.parametrize(
    "vectors,components",
    [([], 0), ([[1.0, 2.0]] * 5, 0), ([[0.0, 0.0], [1.0, 1.0]], 1), ([[1.0], [2.0], [4.0]], 1), ([[1.0, 0.0], [0.0, 1.0], [-1.0, 0.0], [0.0, -1.0]], 2)],
)
def test_whitening_with_few_components(spark, tmp_path, vectors, components):
    folder = vector_table(spark, tmp_path, [(i, v, 0) for i, v in enumerate(vectors)])
    found = QUERIES["op13_embedding_whitening"](spark, folder).collect()
    assert len(found) == components * len(vectors)
    assert all(r.identity_error < 1e-12 for r in found)


def test_whitening_sums_wide_entries_exactly():
    x = np.array([[2**40, -3], [2**40 + 1, 2**33], [-(2**41), 5]])
    wide = x.astype(object)
    want = [3, *wide.sum(0), *[(wide[:, i] * wide[:, j]).sum() for i, j in ((0, 0), (0, 1), (1, 1))]]
    assert whitening._products(x) == want
    small = np.array([[5, -3], [7, 2]])
    assert whitening._products(small) == [2, 12, -1, 74, -1, 13]
    sums = wide.sum(0).tolist()
    assert whitening._deviations(x, 3, sums).tolist() == [sum((3 * a - s) ** 2 for a, s in zip(row, sums)) for row in wide.tolist()]


@pytest.mark.parametrize(
    "diagonal", [[5, 5, 5, 5, 5, 1, 0, 0], [4, 3, 2, 1.0000001, 1, 0.9, 0.5, 0.1], [10.0**-k for k in range(20)], [7], [0, 0], [3, 0, 0], [2, 2, 2]]
)
def test_feast_finds_the_leading_eigenpairs(diagonal):
    d = len(diagonal)
    q, _ = np.linalg.qr(np.random.default_rng(5).standard_normal((d, d)))
    v = q @ np.diag(diagonal) @ q.T
    v = (v + v.T) / 2
    want = sorted(diagonal, reverse=True)
    e, x = whitening.leading_components(v)
    assert len(e) == min(4, sum(w > 0 for w in diagonal))
    assert np.allclose(e, want[: len(e)], rtol=1e-12, atol=1e-13)
    assert np.abs(v @ x - x * e).max(initial=0) < 1e-12 and np.abs(x.T @ x - np.eye(len(e))).max(initial=0) < 1e-12
    for shift in (0.05, 0.95, 2.5):
        assert whitening.count_above(v, shift) == sum(w > shift for w in diagonal)
