"""The registered queries against brute force: on the smallest tables, on a
table of awkward rows, and on an empty one."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starlane.llm import huffman, line_dedup, line_quality, mixing, partenum, quality_gbt, substring
from starlane.llm.oracle import ORACLE
from starlane.llm.queries import QUERIES, tokenizer_path
from starlane.llm.tokens import tokenized
from tests.llm import brute
from tests.llm.cases import SMALL, awkward, pairs, small_documents, write_tables

NAME = {int(re.match(r"op(\d+)", k)[1]): k for k in QUERIES}


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return write_tables(spark, str(tmp_path_factory.mktemp("odd")), awkward())


@pytest.fixture(scope="module")
def nameless(spark, tmp_path_factory):
    """The awkward rows, and some without a doc_id."""
    rows = [*awkward(), (None, awkward()[0][1], "en", "a", 5), (None, None, None, None, None)]
    return write_tables(spark, str(tmp_path_factory.mktemp("nameless")), rows), rows


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write_tables(spark, str(tmp_path_factory.mktemp("empty")), [], [])


def run(spark, number, folder, *columns):
    found = QUERIES[NAME[number]](spark, folder)
    return sorted((tuple(r) for r in found.select(*columns).collect()), key=repr)


def both(odd):
    return [(SMALL, small_documents()), (odd, pairs(awkward()))]


OF_DOCUMENTS = [NAME[n] for n in range(1, 12)]


@pytest.mark.parametrize("name", OF_DOCUMENTS)
def test_no_rows_from_an_empty_table(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


@pytest.mark.parametrize("name", OF_DOCUMENTS)
def test_rows_without_an_id_are_returned(spark, nameless, name):
    folder, rows = nameless
    got = Counter(r[0] for r in QUERIES[name](spark, folder).select("doc_id").distinct().collect())
    assert set(got) == {r[0] for r in rows}


def test_classifier_scores_held_out_documents(spark):
    rows = QUERIES[NAME[1]](spark, SMALL).collect()
    known = dict(duckdb.sql(f"select doc_id, quality from '{SMALL}/labels.parquet'").fetchall())
    assert len(rows) == len(small_documents())
    held = [r for r in rows if r.held_out and r.doc_id in known]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.5) for r in rows)
    assert np.mean([r.predicted == known[r.doc_id] for r in held]) > 0.9


def test_classifier_learns_only_from_its_rows(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    labels = spark.createDataFrame([(i, 0, 0) for i in range(20) if zlib.crc32(str(i).encode()) % 3 == 1], "doc_id long, quality int, toxic int")
    assert len(quality_gbt.train(spark, docs, labels).feature) == 0
    assert len(run(spark, 1, odd, "doc_id", "score")) == len(awkward())


def expected_ids(folder_rows, tokenizer):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(tokenizer))
    return [(d, t.encode(x or "", add_special_tokens=False).ids + [0]) for d, x in folder_rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_huffman_files_give_back_all_ids(spark, odd):
    for folder, rows in both(odd):
        start, want = 0, []
        for d, ids in sorted(expected_ids(rows, "byte_bpe_50k.json"), key=lambda x: (x[0], np.array(x[1], "<u2").tobytes())):
            want.append((d, start, len(ids), crc(ids)))
            start += len(ids)
        assert run(spark, 2, folder, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_are_encoded_as_the_library_does(spark, name):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(name))
    texts = ["a <|endoftext|> b", "x\n <|endoftext|>", "<|startoftext|>Word<|endoftext|>.", "a. <|endoftext|>", "<|ENDOFTEXT|> plain"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: np.frombuffer(r.ids, f"<u{r.width}").tolist() for r in tokenized(docs, tokenizer_path(name)).collect()}
    assert found == {i: library.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_are_encoded_as_the_library_does(name):
    """Texts of odd spaces, combining marks, ligatures, controls and plain words, in any mixture."""
    import random

    import pyarrow as pa

    from starlane.llm.tokens import PieceEncoder

    r = random.Random(3)
    parts = [*" " * 9, "a", "B", "the", "The", "'s", "'", "\u2019", "\n", "\t", "\u00e9", "e\u0301", "\ufb01", "1", "23", ".", ",", "!!", "$", "#", "日本"]
    parts += ["😀", "\u00a0", "\u2003", "<|endoftext|>", "\u0130", "\u017f", "ÿ", "Ă", "-", "_", "\r", "\x0b", "\u200b", "x", "\x00", "\x01", "\u0307"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(8000)]
    encoder = PieceEncoder(tokenizer_path(name))
    for i in range(0, len(texts), 1000):  # later batches meet remembered pieces
        found = encoder.ids(pa.array(texts[i : i + 1000]), 0).to_pylist()
        want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids + [0] for t in texts[i : i + 1000]]
        assert [np.frombuffer(x, encoder.dtype).tolist() for x in found] == want


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_runs_are_learned_once_whatever_stands_beside_them(name):
    """Words are remembered by themselves, not with each mark or line that follows; odd pieces stay whole."""
    import pyarrow as pa

    from starlane.llm import tokens

    marks = [".", ",", ";", "!!", "?", "|", "\n"]
    words = [a + b for a in "abcdefghij" for b in ("one", "TWO", "ñandú", "étÉ", "ŀo", "ɏ")]
    texts = [" ".join(f"{w}{m}{words[i - 1]}" for i, w in enumerate(words)) for m in marks]
    encoder = tokens.PieceEncoder(tokenizer_path(name))
    odd = ["\nab", "ab\n cd", "ab\n\ncd", "ab.\n,cd", "a×b c÷d İe ɐf", "x1 y-z", "\n", "", "Ab\n"]
    for some in (texts, odd):
        found = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.ids(pa.array(some), 0).to_pylist()]
        assert found == [encoder.tokenizer.encode(t, add_special_tokens=False).ids + [0] for t in some]
    held = sum(len(p.at) for p in vars(encoder).values() if isinstance(p, tokens._Pool))
    assert held <= 2 * len(words) + len(marks) + 20


def test_huffman_corpus_in_small_blocks(spark, odd, tmp_path):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    path = str(tmp_path / "coded")
    huffman.write_corpus(spark, docs, tokenizer_path("byte_bpe_50k.json"), path, block_ids=100)
    assert spark.read.parquet(f"{path}/blocks").count() > 5
    got = {(r.doc_id, tuple(r.ids)) for r in huffman.read_corpus(spark, path, with_ids=True).collect()}
    assert got == {(d, tuple(ids)) for d, ids in expected_ids(pairs(awkward()), "byte_bpe_50k.json")}


def test_ngram_join_finds_all_links(spark, odd):
    for folder, rows in both(odd):
        assert run(spark, 3, folder, "doc_id", "n_shingles", "component_id") == sorted(brute.ngram_components(rows), key=repr)


def test_ngram_join_compares_large_groups_in_blocks(spark, monkeypatch):
    """Many unlike documents share a passage; some are near copies of others."""
    import random

    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    passage = [word() for _ in range(12)]
    rows = []
    for i in range(120):
        own = [word() for _ in range(r.randint(5, 12))]
        rows.append((i, " ".join(own + passage)))
        if i % 3 == 0:
            rows.append((1000 + i, " ".join(own + passage + [word()])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(partenum, "SMALL_GROUP", 2)
    got = partenum.join(spark, docs, block_nodes=3)
    assert sorted(map(tuple, got.collect())) == sorted(brute.ngram_components(rows))


def test_ngram_join_keeps_texts_that_share_an_id_apart(spark):
    from tests.llm.cases import prose

    x, y = prose(200, 21), prose(200, 22)
    rows = [(5, x), (5, y), (9, x + " more"), (20, y + " more"), (3, prose(200, 23)), (3, y + " less")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, partenum.join(spark, docs).collect())) == sorted(brute.ngram_components(rows))


def test_one_document_of_each_group_stays(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    stay = partenum.one_of_each(spark, docs)
    assert stay.columns == docs.columns
    want = sorted({c for _, _, c in brute.ngram_components(pairs(awkward()))})
    assert sorted(r.doc_id for r in stay.collect()) == want


def test_packing_is_whole_gapless_and_tight(spark, odd):
    for folder, rows in both(odd):
        want, total = [], 0
        for d, ids in expected_ids(rows, "word_bpe_49k.json"):
            total += len(ids)
            want += [(d, k, a, len(ids[a : a + 2048]), crc(ids[a : a + 2048])) for k, a in enumerate(range(0, len(ids), 2048))]
        found = QUERIES[NAME[4]](spark, folder).collect()
        assert sorted(tuple(r)[:5] for r in found) == sorted(want)
        places = defaultdict(list)
        for r in found:
            places[r.sequence_id].append((r.offset, r.length))
        for held in places.values():
            at = 0
            for offset, length in sorted(held):
                assert offset == at
                at += length
            assert at <= 2048
        assert len(places) <= -(-total // 2048) * 1.01 + 1


def test_personal_data(spark, odd):
    for folder, rows in both(odd):
        by = defaultdict(list)
        for r in QUERIES[NAME[5]](spark, folder).collect():
            by[r.doc_id].append(r)
        for d, t in rows:
            base = brute.personal(t)
            r = by[d].pop()
            assert r.base_sha256 == brute.sha(",".join(base))
            counts = Counter(s.split(":")[0] for s in base)
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in ("email", "ip", "card", "phone"))
            spans = [s for s in r.spans.split(",") if s]
            assert set(base) <= set(spans)
            assert all(re.search("[0-9@]", (t or "")[int(s.split(":")[1]) : int(s.split(":")[2])]) for s in spans)


def test_substring_dedup(spark, odd, nameless):
    for folder, rows in [*both(odd), (nameless[0], pairs(nameless[1]))]:
        want = sorted(brute.substring_dedup(rows), key=repr)
        assert run(spark, 6, folder, "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_substring_dedup_in_many_slices(spark):
    """One hot passage in different surroundings, split over copies of its automaton."""
    from tests.llm.cases import prose

    shared = prose(120, 1).split(" ")
    rows = [(i, prose(30, 100 + i) + " " + " ".join(shared[i % 40 : 60 + i]) + " " + prose(20, 200 + i)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = substring.digest(substring.deduplicated(spark, docs, slice_words=150))
    assert sorted(map(tuple, found.collect())) == sorted(brute.substring_dedup(rows))


def test_fingerprints(spark, odd):
    for folder, rows in both(odd):
        order = sorted(rows, key=lambda x: (x[0], x[1] or ""))
        want = []
        for k, (d, t) in enumerate(order):
            t, after = t or "", order[(k + 1) % len(order)][1] or ""
            n = len(t) // 4
            want.append((d, len(t), brute.sha(t[: len(t) - n] + after[:n])))
        found = QUERIES[NAME[7]](spark, folder).collect()
        assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == sorted(want)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
        prints = defaultdict(set)
        text_of = dict(rows)
        for r in found:
            prints[text_of[r.doc_id] or ""].add(r.fingerprint)
        assert all(len(p) == 1 for p in prints.values())
        long = [r for r in found if r.n_chars > 2000 and r.near_next < 0.2]
        assert not long or np.mean([r.near_edited for r in long]) > 0.4


@pytest.mark.parametrize("number", [8, 10])
@pytest.mark.parametrize("where", ["small", "odd"])
def test_oracle(spark, odd, number, where):
    folder = SMALL if where == "small" else odd
    con = duckdb.connect()
    files = f"{folder}/documents.parquet" + ("" if where == "small" else "/*.parquet")
    con.execute(f"create view documents as select distinct on (doc_id, text) * from read_parquet('{files}')")
    want = con.execute(ORACLE[NAME[number]])
    columns = sorted(c[0] for c in want.description)
    rows = want.fetchall()
    at = [[c[0] for c in want.description].index(c) for c in columns]
    if where == "odd":  # without repeated rows: SQL joins them by doc_id
        docs = spark.read.parquet(f"{folder}/documents.parquet").dropDuplicates(["doc_id", "text"])
        if number == 8:
            found = mixing.mix(spark, docs)
        else:
            found = line_quality.quality_rules(docs)
    else:
        found = QUERIES[NAME[number]](spark, folder)
    assert sorted(repr(tuple(r)) for r in found.select(*columns).collect()) == sorted(repr(tuple(r[i] for i in at)) for r in rows)


def test_mixing_meets_targets(spark, odd):
    rows = QUERIES[NAME[8]](spark, SMALL).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    for held in by.values():
        assert abs(sum(r.taken for r in held) - held[0].target) <= 1
        assert all(0 <= r.taken <= 3 * r.size for r in held)
        assert held[0].target <= 3 * held[0].source_size + 1e-6
    assert sum(h[0].target for h in by.values()) == pytest.approx(sum(r.size for r in rows), rel=1e-6)
    again = QUERIES[NAME[8]](spark, SMALL).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_mixing_in_many_ranges(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    one = {r.doc_id: r.taken for r in mixing.mix(spark, docs).collect()}
    many = {r.doc_id: r.taken for r in mixing.mix(spark, docs, rows_per_range=3).collect()}
    assert one == many


def test_mixed_documents_repeat_whole_rows(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    plan = mixing.mix(spark, docs).collect()
    want = Counter()
    for r in plan:
        if r.size:
            want[r.doc_id] += r.taken // r.size + (2 * (r.taken % r.size) >= r.size and r.taken % r.size > 0)
    mixed = mixing.mixed_documents(spark, docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({k: v for k, v in want.items() if v})


def test_line_dedup(spark, odd):
    for folder, rows in both(odd):
        distinct = list(dict.fromkeys(rows))  # repeated rows are one document
        want = {w[0]: w for w in brute.line_dedup(distinct)}
        assert run(spark, 9, folder, "doc_id", "n_lines", "n_removed", "kept_sha256") == sorted((want[d] for d, _ in rows), key=repr)


def test_line_dedup_finds_every_edit(spark):
    """Lines up to three edits from others, with edits at every kind of place."""
    import random

    r = random.Random(5)
    base = ["".join(r.choice("abcdefgh ") for _ in range(r.randint(20, 40))).strip() + "x" * 3 for _ in range(25)]
    lines = []
    for x in base:
        lines.append(x)
        for _ in range(8):
            y = list(x)
            for _ in range(r.randint(1, 3)):
                at = r.randrange(len(y))
                kind = r.randrange(3)
                if kind == 0:
                    y[at] = r.choice("éabc")
                elif kind == 1:
                    del y[at]
                else:
                    y.insert(at, r.choice("abcß"))
            lines.append("".join(y))
    r.shuffle(lines)
    rows = [(i, "\n".join(lines[i * 5 : i * 5 + 5])) for i in range(len(lines) // 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.deduplicated(spark, docs).select("doc_id", "__lines", "__removed", "text").collect()
    assert sorted((r[0], r[1], r[2], brute.sha(r[3])) for r in found) == sorted(brute.line_dedup(rows))


def test_line_dedup_allows_more_edits_in_longer_lines(spark):
    """Lines around every change of the allowed edits (one in 20 characters), up to two edits beyond them."""
    import random

    r = random.Random(7)
    lines = []
    for n in (56, 57, 59, 60, 61, 76, 79, 80, 81, 100, 150, 259, 400):
        x = "".join(r.choice("abcdefgh ") for _ in range(n - 1)) + "x"
        lines.append(x)
        for k in range(2, n // 20 + 3):
            y = list(x)
            for _ in range(k):
                at = r.randrange(len(y))
                kind = r.randrange(3)
                y[at : at + (kind != 0)] = "" if kind == 2 else r.choice("éabc")
            lines.append("".join(y))
        lines.append(x[:4] + "changed" + x[11:])
    r.shuffle(lines)
    near = {j for j in range(len(lines)) for i in range(j) if brute.edits_within(lines[i], lines[j], max(2, max(len(lines[i]), len(lines[j])) // 20))}
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = line_dedup.deduplicated(spark, docs).where("__removed > 0").select("doc_id").collect()
    assert {row.doc_id for row in found} == near


def test_line_dedup_ends_on_very_long_lines(spark):
    """A line of 200,000 characters, two near ones of 30,000 in which every 25th character differs, and one beyond."""
    import random
    import time

    r = random.Random(9)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    base = text(30_000)
    changed = lambda x, step: "".join("Z" if i % step == 7 else c for i, c in enumerate(x))
    rows = [(1, text(200_000)), (2, base), (3, changed(base, 25) + "tail"), (4, changed(base[5:], 15)), (5, text(50_000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    start = time.time()
    found = {r.doc_id: r["__removed"] for r in line_dedup.deduplicated(spark, docs).collect()}
    assert found == {1: 0, 2: 0, 3: 1, 4: 0, 5: 0}
    assert time.time() - start < 60


def test_line_dedup_meets_a_share_of_the_keys_at_a_time(spark, monkeypatch):
    """Tiers of line lengths, and slices of a large tier, meet one after another, with the same lines found."""
    import random

    r = random.Random(11)
    text = lambda n: "".join(r.choice("abcdef ghijk") for _ in range(n)).replace("  ", "xy").strip() + "z"
    lines = [text(n) for n in (30, 45, 58, 59, 61, 110, 119, 121, 160, *[305] * 9)]
    near = [x[: len(x) // 3] + "Q" + x[len(x) // 3 + 1 :] + "R" * (len(x) // 60) for x in lines[::2]]
    rows = [(i, x) for i, x in enumerate([*lines, *near, "\n".join(lines[1:4])])]
    monkeypatch.setattr(line_dedup, "PASSES", 4, raising=False)
    monkeypatch.setattr(line_dedup, "PASS_CHARS", 1, raising=False)
    names, real = [], line_dedup.materialize
    monkeypatch.setattr(line_dedup, "materialize", lambda s, df, name: names.append(name) or real(s, df, name))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.deduplicated(spark, docs).select("doc_id", "__lines", "__removed", "text").collect()
    assert sorted((x[0], x[1], x[2], brute.sha(x[3])) for x in found) == sorted(brute.line_dedup(rows))
    assert sum(x[2] for x in found) >= len(near)
    assert names.count("line-met") >= 4


def test_line_dedup_tells_unlike_lines_of_one_passage_by_their_letters(spark, monkeypatch):
    """Lines that share a passage are not all compared; near ones among them still go."""
    import random

    r = random.Random(41)
    passage = "".join(r.choice("etaonisr") for _ in range(60))
    lines = [passage + "".join(r.choice("etaonisr") for _ in range(140)) for _ in range(60)]
    lines += [x[:90] + "Q" + x[91:] for x in lines[::10]]
    held, real = {}, line_dedup.materialize
    monkeypatch.setattr(line_dedup, "materialize", lambda s, df, name: held.setdefault(name, []).append(real(s, df, name)) or held[name][-1])
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = line_dedup.deduplicated(spark, docs).select("doc_id", "__lines", "__removed", "text").collect()
    assert sorted((x[0], x[1], x[2], brute.sha(x[3])) for x in found) == sorted(brute.line_dedup(list(enumerate(lines))))
    assert sum(x[2] for x in found) == 6
    assert sum(x.select("a", "b").count() for x in held["line-candidates"]) < 1_000  # of 2145 pairs


def test_line_dedup_drops_probes_that_meet_no_key(spark):
    keys = spark.range(500).selectExpr("xxhash64(id) as key")
    probe = spark.range(10_000).selectExpr("xxhash64(id) as key", "id as b", "id as place")
    left = line_dedup._that_meet(probe, keys, 500)
    assert left.columns == ["key", "b", "place"]
    assert {x.b for x in left.collect()} >= set(range(500)) and left.count() < 1_500
    assert line_dedup._that_meet(probe, keys.limit(0), 0).count() == 0


def test_line_dedup_deletes_tables_it_is_done_with(spark, monkeypatch):
    """Only small tables stay; pairs are compared once, and a line that repeats itself meets no one."""
    import os
    import random
    from urllib.parse import unquote, urlparse

    r = random.Random(17)
    text = lambda n: "".join(r.choice("abcdefgh ijk") for _ in range(n - 1)) + "z"
    base = text(300)
    edited = lambda x, n: "".join("Q" if i in places else c for places in [r.sample(range(300), n)] for i, c in enumerate(x))
    lines = [edited(base, 9) for _ in range(12)] + [base] + [edited(base, 9) for _ in range(12)] + ["over and over " * 40]
    rows = [*enumerate(lines), (100, base), (101, base)]
    files, counts, pairs, real = {}, Counter(), Counter(), line_dedup.materialize

    def written(s, df, name):
        table = real(s, df, name)
        files.setdefault(name, []).extend(unquote(urlparse(f).path) for f in table.inputFiles())
        counts[name] += table.count()
        if name == "line-candidates":
            pairs.update((x.a, x.b) for x in table.collect())
        return table

    monkeypatch.setattr(line_dedup, "materialize", written)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.deduplicated(spark, docs).select("doc_id", "__lines", "__removed", "text").collect()
    assert sorted((x[0], x[1], x[2], brute.sha(x[3])) for x in found) == sorted(brute.line_dedup(rows))
    assert counts["lines"] == 26 and counts["line-met"]
    left = {name for name, some in files.items() if any(os.path.exists(f) for f in some)}
    assert left <= {"lines-kept", "line-candidates", "line-compared", "line-gone"}
    assert pairs and max(pairs.values()) == 1

    counts.clear()
    assert line_dedup.deduplicated(spark, docs.where("doc_id = 25")).where("__removed > 0").count() == 0
    assert counts["lines"] == 1 and counts["line-crowd"] == 0


def test_line_dedup_passes_columns_of_any_name(spark):
    line = "a line of some twenty and more characters"
    names = ["__new", "__key", "old", "lines", "removed", "row", "a.b", "id", "stay"]
    docs = spark.createDataFrame([(1, line, *names), (2, line + "!\nanother", *names)], ["doc_id", "text", *names])
    rows = line_dedup.without_near_lines(spark, docs)
    assert rows.columns == docs.columns
    assert sorted(map(tuple, rows.collect())) == [(1, line, *names), (2, "another", *names)]


def test_pipeline_stages_pass_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name in ("__text", "__predicted", "_times", "row", "key", "nth", "col"):
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    for out in (quality_gbt.accepted(spark, docs, labels), mixing.mixed_documents(spark, docs)):
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in docs.columns[-7:])


def test_frequent_lines_are_taken_out(spark):
    rows = [(i, f"All rights reserved  here\nown line number {i} of this document", "h") for i in range(40)]
    rows += [(100 + i, "copied line of text", "h") for i in range(40)]  # copies: one text
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r.text for r in line_quality.without_frequent_lines(docs).collect()}
    assert found[3] == "own line number 3 of this document" and found[100] == "copied line of text"


def test_quality_rules_keep_copies_and_reject_depleted(spark):
    from tests.llm.cases import prose

    boiler = prose(60, 1)
    rows = [(i, boiler + "\n" + prose(30, 10 + i), "h") for i in range(30)] + [(50 + i, prose(80, 3), "h") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in line_quality.quality_rules(docs).collect()}
    assert not found[0].kept and found[0].n_words_lost == 60 and not found[0].base_failed
    assert found[50].kept and found[50].n_words_lost == 0


def test_frequent_lines_do_not_hang_on_the_size_of_the_host(spark):
    """A line of 21 documents goes and one of 20 stays, on a host of 50 and on one of 1,500."""
    rows = []
    for host, size in (("small", 50), ("large", 1500)):
        for i in range(size):
            lines = [f"own line {i}"] + ["in twenty-one"] * (i < 21) + ["in twenty"] * (i < 20)
            rows.append((len(rows), "\n".join(lines), host, "x", "y"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _key string, row string")
    found = {(r.host, r.documents) for r in line_quality.frequent_lines(docs).collect()}
    assert found == {("small", 21), ("large", 21)}
    out = line_quality.without_frequent_lines(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.where("doc_id in (0, 50)").collect()}
    assert all(got[i].text == "own line 0\nin twenty" and (got[i]._key, got[i].row) == ("x", "y") for i in (0, 50))


def test_pipeline(spark, odd):
    """Each stage on its own input, against what the operator's tests establish."""
    for folder, rows in both(odd):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        columns, seen = docs.columns, {}
        for name, stage in corpus_pipeline.STAGES:
            before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] if "text" in docs.columns else []
            out = stage(spark, docs, folder)
            out.write.mode("overwrite").parquet(f"{spark.sparkContext.getCheckpointDir()}/stage-{name}-{len(rows)}")
            docs = spark.read.parquet(f"{spark.sparkContext.getCheckpointDir()}/stage-{name}-{len(rows)}")
            if name != "best_fit_packing":
                assert docs.columns == columns
            seen[name] = before
        after = {r.doc_id: r.text for r in spark.read.parquet(f"{spark.sparkContext.getCheckpointDir()}/stage-line_dedup-{len(rows)}").collect()}
        for d, _, removed, sha in brute.line_dedup(list(dict.fromkeys(seen["line_dedup"]))):
            assert brute.sha(after[d] or "") == sha if d in after else removed > 0
        groups = {c for _, _, c in brute.ngram_components(seen["ngram_jaccard_join"])}
        assert sorted(groups) == sorted(d for d, _ in seen["source_mixing"])
        packed = docs.groupBy("sequence_id").sum("length").collect()
        assert max((r[1] for r in packed), default=0) <= 2048
        assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == {d for d, _ in seen["best_fit_packing"]}


def test_pipeline_runs_as_a_query(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"](spark, SMALL).count() > 0 and "pipeline" not in entry.oracle_sql()
