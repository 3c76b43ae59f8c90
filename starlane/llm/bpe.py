"""Byte-pair encoding by a contiguous rank array, and decoding.

A word's parts stand side by side in an array, with the rank of each adjacent
pair beside them. The smallest rank is found by a scan, the boundary inside
that pair goes, and the ranks of the merged part's two neighbours are looked up
anew, until no pair has a rank. Words of one length are rows of one matrix: each
row that is not done loses exactly one boundary a round, so all rows keep one
width. A scan a merge is quadratic in a word's length; words above
``SCAN_BYTES`` (runs of letters without a break) keep their pairs in a heap
with the same order, so that a text of one long word ends as well.

Normalisation and the cut into words are the tokenizer file's. A tokenizer that
drops white space is fed piece by piece (runs without ASCII white space): each
distinct piece of a batch is cut and merged once. Tokenizers that keep white
space see whole segments. A text is first cut at the strings of added tokens,
as the library does. Truncation and padding are not applied.

Defined cases: a null text is the empty text, which has no ids and decodes to
the empty text; repeated rows and null doc_ids give a row each; an empty table
gives no rows; other columns are not read. Ids outside the vocabulary decode to
nothing.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.llm.common import text_or_empty
from starlane.llm.shingles import slices
from starlane.llm.tokens import _byte_letters

SCAN_BYTES = 96
# Distinct pieces a worker remembers; beyond them it starts anew.
MEMORY_PIECES = 400_000
# Bytes of text whose distinct pieces are looked up at once; a longer text is a
# slice of its own.
BATCH_BYTES = 6 << 20
_NONE = np.int32(2**31 - 1)

# The normaliser and word pattern (fixed values of such tokenizer files) whose
# effect on plain Latin pieces is known: lower case, then this pattern.
_PLAIN_NORMALIZER = ["NFC", "Replace", "Lowercase"]
_PLAIN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Printable ASCII but "<" (added tokens begin with it), Latin letters, × and ÷.
_PLAIN = "!-;=-~À-įı-ɏ"
_ODD_PIECES = re.compile(rf"(?m)^[{_PLAIN}]*[^{_PLAIN}\n].*$")
_LETTER = "a-zß-öø-ɏ"
_PLAIN_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^\s{_LETTER}0-9]+|\n")


class RankArrayBpe:
    """Merges of one tokenizer file over words given as UTF-8 bytes."""

    def __init__(self, model: dict) -> None:
        unsupported = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback") if model.get(k)]
        if model["type"] != "BPE" or unsupported:
            raise ValueError(f"not a plain byte-level BPE model: {model['type']} {unsupported}")
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        letters = _byte_letters()
        self.first = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[letters[b] + suffix] for b in range(256)], np.int32)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.width = np.int64(max(vocab.values()) + 1)
        keys = np.array([vocab[a] * int(self.width) + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.pairs: dict[int, int] | None = None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair, or _NONE."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def _merge_rows(self, parts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row numbers, parts) of words of one length, as they are done."""
        rows = np.arange(len(parts))
        ranks = self.rank(parts[:, :-1], parts[:, 1:])
        while len(rows) and parts.shape[1] > 1:
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            done = best == _NONE
            if done.any():
                yield rows[done], parts[done]
                go = ~done
                rows, parts, ranks, at, best = rows[go], parts[go], ranks[go], at[go], best[go]
                if not len(rows):
                    return
            n, width = parts.shape
            each = np.arange(n)
            parts[each, at] = self.merged[best]
            hold = np.ones((n, width), bool)
            hold[each, at + 1] = False
            parts = parts[hold].reshape(n, width - 1)
            hold = np.ones((n, width - 1), bool)
            hold[each, at] = False
            ranks = ranks[hold].reshape(n, width - 2)
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.rank(parts[left, at[left] - 1], parts[left, at[left]])
            right = np.flatnonzero(at < width - 2)
            ranks[right, at[right]] = self.rank(parts[right, at[right]], parts[right, at[right] + 1])
        if len(rows):
            yield rows, parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same merges, smallest rank first and leftmost among equals, by a heap."""
        if self.pairs is None:
            self.pairs = dict(zip(self.keys.tolist(), self.ranks.tolist()))
        n, width = len(parts), int(self.width)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i) for i in range(n - 1) if (r := self.pairs.get(parts[i] * width + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or self.pairs.get(parts[i] * width + parts[j]) != rank:
                continue
            parts[i], alive[j], after[i] = int(self.merged[rank]), False, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n and (r := self.pairs.get(parts[a] * width + parts[after[a]])) is not None:
                    heapq.heappush(heap, (r, a))
        return [p for p, live in zip(parts, alive) if live]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and how many each has."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(sizes) - sizes
        counts = np.zeros(len(words), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for size in np.unique(sizes[(sizes > 0) & (sizes <= SCAN_BYTES)]):
            which = np.flatnonzero(sizes == size)
            raw = data[starts[which][:, None] + np.arange(size)]
            parts = self.first[raw]
            parts[:, -1] = self.last[raw[:, -1]]
            for rows, ids in self._merge_rows(parts):
                found.append((which[rows], ids))
                counts[which[rows]] = ids.shape[1]
        for i in np.flatnonzero(sizes > SCAN_BYTES):
            raw = data[starts[i] : starts[i] + sizes[i]]
            parts = self.first[raw].tolist()
            parts[-1] = int(self.last[raw[-1]])
            ids = np.array([self._merge_long(parts)], np.int32)
            found.append((np.array([i]), ids))
            counts[i] = ids.shape[1]
        offsets = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int32)
        for which, ids in found:
            out[offsets[which][:, None] + np.arange(ids.shape[1])] = ids
        return out, counts


def _gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs flat[start : start + count], one after another."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - counts), counts) + np.arange(total)]


class _Pool:
    """Ids of remembered strings: their runs in one array."""

    def __init__(self) -> None:
        self.at: dict[str, int] = {}
        self.flat, self.starts, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, names: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        known = len(self.at)
        self.at.update(zip(names, range(known, known + len(names))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
        self.flat, self.counts = np.concatenate([self.flat, ids]), np.concatenate([self.counts, counts])


class BpeCodec:
    """Encoder and decoder of one tokenizer file (byte-level BPE, JSON)."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.bpe = RankArrayBpe(spec["model"])
        library = Tokenizer.from_file(path)
        self.normalizer, self.cutter = library.normalizer, library.pre_tokenizer
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with stripping, word or normalising rules are not read")
        strings = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.added_pattern = re.compile(f"({'|'.join(strings)})") if strings else None
        # Such a pattern drops white space: pieces can be cut apart there.
        parts = (spec["normalizer"] or {}).get("normalizers", [])
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.plain = [p["type"] for p in parts] == _PLAIN_NORMALIZER and bool(cuts) and cuts[0].get("pattern", {}).get("Regex") == _PLAIN_SPLIT
        self.letters = {c: b for b, c in _byte_letters().items()}
        self._forget()
        names = {i: t for t, i in [*spec["model"]["vocab"].items(), *self.added.items()]}
        table = [names.get(i, "") for i in range(max(names) + 1)]
        self.in_vocabulary = np.array([i in names for i in range(len(table))])
        kind = (spec["decoder"] or {}).get("type")
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"decoder {kind} is not read")
        self.joins_bytes = kind == "ByteLevel"
        if self.joins_bytes:
            raw = [bytes(map(self.letters.__getitem__, t)) if all(c in self.letters for c in t) else t.encode() for t in table]
            self.table = pa.array(raw, pa.binary())
        else:
            self.table = pa.array(table, pa.string())

    def _cut(self, piece: str) -> list[bytes | str]:
        """The words of a piece by the library; added tokens stay strings."""
        found: list[bytes | str] = []
        for part in self.added_pattern.split(piece) if self.added_pattern else [piece]:
            if part in self.added:
                found.append(part)
            elif part:
                text = self.normalizer.normalize_str(part) if self.normalizer is not None else part
                found += [bytes(map(self.letters.__getitem__, w)) for w, _ in self.cutter.pre_tokenize_str(text)]
        return found

    def _know(self, words: set[bytes | str]) -> None:
        """Merge the words that are new."""
        new = [w for w in words.difference(self.words.at) if w not in self.added]
        self.words.add(new, *self.bpe.merge([w if isinstance(w, bytes) else w.encode() for w in new]))

    def _learn(self, pieces: set[str]) -> None:
        """Ids of new pieces, from their words' ids."""
        odd: list[str] = list(pieces)
        if self.plain:
            odd = _ODD_PIECES.findall("\n".join(pieces))
            plain = list(pieces.difference(odd))
            # All at once: words and, as "\n", the ends of pieces.
            words = _PLAIN_WORDS.findall("\n".join(plain).lower() + "\n") if plain else []
            self._know(set(words))
            at = np.fromiter(map(self.words.at.__getitem__, words), np.int64, len(words))
            ends = np.flatnonzero(at == self.words.at["\n"])
            self._add(plain, at, np.concatenate([[0], ends + 1])[: len(plain)], ends)
        cut = [self._cut(p) for p in odd]
        self._know({w for words in cut for w in words})
        at = np.fromiter((self.words.at[w] for words in cut for w in words), np.int64)
        ends = np.cumsum([len(words) for words in cut], dtype=np.int64)
        self._add(odd, at, np.concatenate([[0], ends])[:-1], ends)

    def _add(self, pieces: list[str], at: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Remember pieces whose words are at[start:end]; "\n" has no ids."""
        counts = self.words.counts[at]
        sums = np.concatenate([[0], np.cumsum(counts)])
        self.pieces.add(pieces, _gather(self.words.flat, self.words.starts[at], counts), sums[ends] - sums[starts])

    def _forget(self) -> None:
        self.words, self.pieces = _Pool(), _Pool()
        names = list(self.added)
        self.words.add(names, np.array([self.added[t] for t in names], np.int32), np.ones(len(names), np.int64))
        self.words.add(["\n"], np.zeros(0, np.int32), np.zeros(1, np.int64))

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text; null is the empty text."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if self.plain:
            lists = pc.ascii_split_whitespace(texts)
            found = lists.flatten().dictionary_encode()
            places, offsets = found.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.asarray(lists.offsets, np.int64)
            offsets = offsets - offsets[0]
            held = found.dictionary
            whole = pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held)
            distinct = pc.binary_join(whole, "\n")[0].as_py().split("\n") if len(held) else []
        else:
            distinct = texts.to_pylist()
            places, offsets = np.arange(len(texts)), np.arange(len(texts) + 1)
        if len(self.pieces.at) > MEMORY_PIECES or len(self.words.at) > MEMORY_PIECES or not self.plain:
            self._forget()
        known = self.pieces.at
        new = set(distinct).difference(known)
        if new:
            self._learn(new)
        at = np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))[places]
        counts = self.pieces.counts[at]
        ids = _gather(self.pieces.flat, self.pieces.starts[at], counts)
        ends = np.concatenate([[0], np.cumsum(counts)])[offsets]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The text of each list of ids; special tokens stay."""
        flat, offsets = np.asarray(ids.flatten(), np.int64), np.asarray(ids.offsets, np.int64)
        offsets = offsets - offsets[0]
        there = (flat >= 0) & (flat < len(self.in_vocabulary))
        there[there] = self.in_vocabulary[flat[there]]
        offsets = np.concatenate([[0], np.cumsum(there)])[offsets]
        tokens = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), self.table.take(pa.array(flat[there])))
        if not self.joins_bytes:
            return pc.binary_join(tokens, " ")
        return pa.array([b.decode("utf-8", "replace") for b in pc.binary_join(tokens, b"").to_pylist()], pa.string())


_CODECS: dict[str, BpeCodec] = {}


def codec(path: str) -> BpeCodec:
    """One codec a worker process and tokenizer file."""
    if path not in _CODECS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _CODECS[path] = BpeCodec(path)
    return _CODECS[path]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids: every whole text's ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            for part in slices(batch, size=BATCH_BYTES):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), bpe.encode(part.column("text"))], ["doc_id", "ids"])

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """doc_id, text: the text of every list of ids; no list (null) is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), bpe.decode(batch.column("ids"))], ["doc_id", "text"])

    ids = F.coalesce(F.col("ids").cast("array<int>"), F.array().cast("array<int>"))
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), ids.alias("ids")).mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, decoded: every whole text's ids, and the text decoded from them, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            for part in slices(batch, size=BATCH_BYTES):
                ids = bpe.encode(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids, bpe.decode(ids)], ["doc_id", "ids", "decoded"])

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digest(rows: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of ``round_trip``'s rows."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
