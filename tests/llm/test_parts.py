"""The numpy parts by themselves."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starlane.llm import huffman, packing, partenum, pii, quality_gbt, shingles, sketch, substring
from tests.llm import brute
from tests.llm.cases import prose


def _sets(texts, lower=True):
    return shingles.shingle_sets(shingles.words(*shingles.utf8(pa.array(texts, pa.string())), lower=lower))


@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té😀\x0b ", max_size=40)), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words_and_shingles_agree_with_plain_python(texts):
    w = shingles.words(*shingles.utf8(pa.array(texts, pa.string())))
    assert w.count().tolist() == [len(brute.words(t)) for t in texts]
    flat = [x for t in texts for x in brute.words(t)]
    assert len(set(flat)) == len(set(w.hashes.tolist()))
    sets, off = _sets(texts)
    assert np.diff(off).tolist() == [len(brute.shingle_set(t)) for t in texts]


def test_equal_words_hash_alike_anywhere():
    a = shingles.words(*shingles.utf8(pa.array(["x yy zzz", "zzz x"]))).hashes
    assert a[0] == a[4] and a[2] == a[3] and len({*a.tolist()}) == 3


@given(st.lists(st.integers(1, 10**6), min_size=1, max_size=60), st.integers(7, 12))
@settings(max_examples=60, deadline=None)
def test_code_lengths_are_limited_and_complete(counts, limit):
    lengths = huffman.code_lengths(np.array(counts), limit)
    assert lengths.max() <= limit
    if len(counts) > 1:
        assert sum(2.0 ** -int(x) for x in lengths) == 1.0
        order = np.argsort(counts, kind="stable")
        assert all(np.diff(lengths[order]) <= 0)


def test_code_lengths_are_optimal_without_a_tight_limit():
    import heapq

    counts = [random.Random(3).randint(1, 1000) for _ in range(40)]
    heap, cost = sorted(counts), 0
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    assert int((huffman.code_lengths(np.array(counts), 30) * np.array(counts)).sum()) == cost


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 1000, 70_000])
def test_huffman_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 50_000).astype(np.int64)
    used, counts = np.unique(np.append(ids, [3, 4]), return_counts=True)
    code = huffman.Code(used, huffman.code_lengths(counts, 17))
    bits, steps = code.encode(ids)
    assert (code.decode(bits, steps, n) == ids).all()
    one = huffman.Code(np.array([7]), huffman.code_lengths(np.array([9])))
    assert one.decode(*one.encode(np.full(300, 7)), 300).tolist() == [7] * 300


@given(st.integers(1, 400), st.integers(0, 10**6))
@settings(max_examples=120, deadline=None)
def test_linked_sets_share_a_signature(size, seed):
    r = random.Random(seed)
    a = {r.getrandbits(64) for _ in range(size)}
    # As far apart as linked sets can be, by removals and additions.
    gone = r.randint(0, size // 5)
    kept = set(sorted(a)[gone:])
    more = 0
    while 100 * len(kept) >= 80 * (len(a) + more + 1):
        more += 1
    b = kept | {r.getrandbits(64) for _ in range(r.randint(0, more))}
    if 100 * len(a & b) < 80 * len(a | b):
        return
    sets = np.array(sorted(a) + sorted(b), np.uint64)
    some = np.array(sorted(r.sample(sorted(a | b), r.randint(0, len(a | b)))), np.uint64)
    for frequent in (None, some):
        owner, sig = partenum.signatures(sets, np.array([0, len(a), len(a) + len(b)]), frequent=frequent)
        assert set(sig[owner == 0].tolist()) & set(sig[owner == 1].tolist())
    k = (len(a) + len(b)) * 20 // 180
    assert partenum.bits_apart(partenum.bitmap(sets[: len(a)]), partenum.bitmap(sets[len(a) :])) <= len(a ^ b) <= k


def test_automaton_gives_matching_statistics():
    r = random.Random(2)
    texts = [[r.randint(1, 4) for _ in range(r.randint(1, 40))] for _ in range(5)]
    auto = substring.Automaton()
    for t in texts:
        auto.add(t)
    query = [r.randint(1, 5) for _ in range(200)]
    held = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    want = [max((n for n in range(1, i + 2) if tuple(query[i + 1 - n : i + 1]) in held), default=0) for i in range(len(query))]
    assert auto.statistics(query).tolist() == want


def test_equal_windows_have_equal_anchors():
    a, b = prose(80, 1), prose(30, 2) + " " + prose(80, 1)
    w = shingles.words(*shingles.utf8(pa.array([a, b, "few words"])))
    text, anchor, lo, hi = substring.anchors_of(w)
    of = {}
    for t, x, p, q in zip(text.tolist(), anchor.tolist(), lo.tolist(), hi.tolist(), strict=True):
        of.update({(t, i): x for i in range(p, q + 1)})
    assert all(of[0, i] == of[1, i + 30] for i in range(31)) and len(of) == 31 + 61


def test_grouping_genetic_algorithm_keeps_items_and_capacity():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 900, 500)
    best = packing.evolve(lengths, [], 1000, 1, 6, 15)
    fill = np.bincount(best, weights=lengths)
    assert len(best) == 500 and fill.max() <= 1000 and fill.min() > 0
    first = np.full(500, -1, np.int32)
    packing.best_fit(lengths, np.argsort(-lengths), first, 1000)
    assert best.max() <= first.max()
    child = packing.crossover(best, packing._dense(first), lengths, 1000, rng)
    assert np.bincount(child, weights=lengths).max() <= 1000 and (child >= 0).all()
    # Three groups that only together fill their bins: 6+4, 7+3, 8+2.
    tight = np.array([6, 7, 8, 4, 3, 2])
    assert packing.evolve(tight, [], 10, 1, 4, 20).max() == 2


def test_gradients_of_the_tagger():
    rng = np.random.default_rng(0)
    model = pii.Model(rng, hidden=3)
    for k, v in model.p.items():
        model.p[k] = v.astype(np.float64)
    x, y = rng.integers(0, 20, (7, 4)), rng.integers(0, pii.TAGS, (7, 4))
    _, grads = model.gradients(x, y)
    for name, g in grads.items():
        at = tuple(rng.integers(0, s) for s in g.shape)
        if name.startswith("in_"):
            at = (int(x[3, 1]), at[1])
        step = 1e-2
        model.p[name][at] += step
        up = model.gradients(x, y)[0]
        model.p[name][at] -= 2 * step
        down = model.gradients(x, y)[0]
        model.p[name][at] += step
        assert g[at] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=1e-3)


def test_tagger_learns_held_out_spans():
    rng = np.random.default_rng(1)
    texts = [prose(60, s) for s in range(20)]
    x, y = pii.training_windows(texts, rng, 1200)
    model = pii.Model(rng)
    model.fit(x[:1000], y[:1000], rng, passes=6)
    assert (model.decode(x[1000:].T).T == y[1000:]).mean() > 0.97


_PERSONAL = st.text(alphabet="ab1234567890.@+-() _%", max_size=60)


@given(_PERSONAL)
@settings(max_examples=300, deadline=None)
def test_base_spans_agree_with_the_patterns(text):
    assert pii.spelled(pii.base_spans(text)) == ",".join(brute.personal(text))


def test_long_runs_take_linear_time():
    assert pii.base_spans("a" * 300_000 + " 1 " + "7" * 200_000 + " @" + "1." * 100_000) is not None


def test_windows_cover_every_character():
    for n in range(1, 400):
        starts = pii._window_starts(n)
        half = pii.OVERLAP // 2
        seen = np.zeros(n, int)
        for a in starts:
            low = a if a == 0 else a + half
            high = n if a + pii.WINDOW >= n else a + pii.WINDOW - half
            seen[low:high] += 1
        assert (seen[: starts[0] + 1] >= 1).all() and (seen >= 1).all()


def test_boosted_trees_separate():
    rng = np.random.default_rng(0)
    x = rng.random((600, 5))
    y = ((x[:, 1] > 0.6) ^ (x[:, 3] > 0.5)).astype(float)
    model = quality_gbt.fit(x[:400], y[:400])
    assert ((model.scores(x[400:]) >= 0.5) == y[400:]).mean() > 0.9
    assert quality_gbt.fit(x[:0], y[:0]).scores(x)[0] == 0.5
    assert quality_gbt.fit(x, np.ones(600)).scores(x).min() > 0.99


def test_sketches_estimate_likeness_and_containment_and_merge():
    a, b = prose(4000, 1), prose(4000, 1) + " " + prose(40_000, 2)
    x, y = sketch.sketches([a, b])
    assert sketch.containment(x, y) > 0.97 and 0.05 < sketch.likeness(x, y) < 0.15
    assert sketch.from_text(sketch.to_text(x))[1].tolist() == x[1].tolist()
    parts = sketch.sketches([prose(4000, 1), prose(40_000, 2)])
    both = sketch.merged(*parts)
    assert sketch.likeness(both, y) > 0.99
    empty, word = sketch.sketches(["", "word"])
    assert sketch.likeness(empty, empty) == 1.0 and sketch.likeness(empty, word) == 0.0 and sketch.likeness(word, word) == 1.0


def test_first_by_hash_takes_the_least_hashes_of_distinct_rows(spark):
    from pyspark.sql import functions as F

    from starlane.llm.common import first_by_hash

    # A third of the rows are one row.
    rows = spark.range(3000).select(F.greatest(F.lit(1000), "id").alias("id")).withColumn("h", F.xxhash64("id"))
    order = sorted({(r["h"] % 2**64, r["id"]) for r in rows.collect()})
    for number in (0, 1, 7, 600, 5000):
        assert sorted((r["h"] % 2**64, r["id"]) for r in first_by_hash(rows, number, "h").collect()) == order[:number]
    assert first_by_hash(rows.limit(0), 5, "h").collect() == []


def test_frequent_shingles_are_counted_over_all_documents(spark, monkeypatch):
    """120 documents in four tasks; one passage is in 24 of them, one in 6. At 1 in
    10 only the first is frequent, and each document's own words are not."""
    passages = {5: "the same passage in every fifth text", 20: "now and then a rarer passage"}
    rows = [(i, f"own{i} words{i} of{i} text{i} number{i} {passages[20] if i % 20 == 1 else passages[5] if i % 5 == 0 else ''}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(partenum, "PER_DOCS", 50)
    info = partenum.described(docs)
    found = set(partenum.frequent_shingles(info).tolist())
    words = partenum.S.words(*partenum.S.utf8(pa.array([passages[5]])), lower=True)
    wanted = set(partenum.S.shingle_sets(words, partenum.SHINGLE_WORDS)[0].tolist())
    assert found == wanted and len(wanted) == 3
    assert info.where("seen is null").count() == 120
