"""Token ids of whole texts by a public tokenizer file, in Arrow batches.

The tokenizers library encodes. Texts are cut where the tokenizer cuts anyway,
in front of a space that a visible character follows and, where probes show
that runs of letters and of marks are tokenizer words, between such runs. The
cuts are found in a batch's bytes at once, its distinct runs by Arrow; the new
ones go to the library in one call, runs of letters straight to the
tokenizer's model, and the ids of all are gathered by index. A text with
white space after a space, or with the string of an added token
(<|endoftext|>), is encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.llm.common import text_or_empty
from starlane.llm.shingles import slices, utf8

END_ID = 0
# Distinct runs a worker remembers; beyond them it starts anew.
CACHE_RUNS = 500_000
# Bytes of text whose distinct runs are looked up at once; a longer text is a
# slice of its own.
BATCH_BYTES = 4 << 20

# Runs of Latin letters that no normalisation but the lower case touches (all
# up to U+024F but the dotted capital I, which turns into two characters), and
# of marks: such runs are tokenizer words. A piece (up to the next space) of
# other characters, or with a line feed that does not stand between runs, is
# encoded whole.
_MARKS = ".,;:!?$%&*#|"
_LATIN = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_SPLIT = "\x01"
_RUNS = re.compile(rf" ?[{_LATIN}]+| ?[{_MARKS}]+|\n")
_LETTER, _MARK, _LINE, _SPACE, _OTHER = range(5)


def _kinds() -> np.ndarray:
    """What a byte of UTF-8 belongs to; the bytes C3 to C9 begin the letters from U+00C0 on."""
    kinds = np.full(256, _OTHER, np.uint8)
    kinds[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = _LETTER
    kinds[list(_MARKS.encode())], kinds[ord("\n")], kinds[ord(" ")] = _MARK, _LINE, _SPACE
    return kinds


_KINDS = _kinds()
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
# Characters of two bytes that begin as letters do and are none of the above.
_NO_LETTERS = np.zeros(1 << 16, bool)
_NO_LETTERS[[0xC397, 0xC3B7, 0xC4B0, *range(0xC990, 0xC9C0)]] = True
_MAY_BE_NONE = np.zeros(256, bool)
_MAY_BE_NONE[[0xC3, 0xC4, 0xC9]] = True
_PROBES = ("a", "the", "Zebra", "ouath", "thinginon", "ing", "qzx", "WORD", "êtreÉ", "straße", "ñandú", "ÿœĂ")


def _byte_letters() -> dict[int, str]:
    """Byte-level tokenizers write each byte as a letter: printable ones as
    they are, the others from 256 up."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_LETTERS = _byte_letters()


class _Pool:
    """Ids of remembered strings: their runs in one array that grows by doubling."""

    def __init__(self, dtype: np.dtype) -> None:
        self.at: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, dtype), 0
        self.starts, self.counts = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def add(self, names: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        known = len(self.at)
        self.at.update(zip(names, range(known, known + len(names))))
        while len(self.flat) < self.used + len(ids):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.starts) < known + len(names):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[known : known + len(names)] = self.used + np.cumsum(counts) - counts
        self.counts[known : known + len(names)] = counts
        self.used += len(ids)

    def runs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of strings one after another, and how many each has."""
        counts = self.counts[at]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[at] - (ends - counts), counts) + np.arange(total)], counts


def _cut(data: np.ndarray, off: np.ndarray, apart: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the runs of texts begin, which of them are runs of letters, and
    which bytes are in pieces that are encoded whole."""
    kinds = _KINDS[data]
    edge = kinds == _SPACE
    edge[off[:-1][off[:-1] < off[1:]]] = True
    pieces = np.flatnonzero(edge)
    # A line feed needs a letter or a mark of its piece on both sides.
    lines = np.flatnonzero(kinds == _LINE)
    ends = np.append(edge[1:], True)
    near = np.append(kinds, _OTHER)
    lines = lines[edge[lines] | ends[lines] | (near[lines - 1] > _MARK) | (near[lines + 1] > _MARK)]
    lead = np.flatnonzero(_MAY_BE_NONE[data])
    lead = lead[_NO_LETTERS[data[lead].astype(np.int64) << 8 | data[lead + 1]]]
    odd = np.concatenate([np.flatnonzero(kinds == _OTHER), lines, lead])
    whole = np.full(len(pieces), not apart)
    whole[np.searchsorted(pieces, odd, "right") - 1] = True
    inside = np.repeat(whole, np.diff(pieces, append=len(data)))
    cut = (kinds[1:] != kinds[:-1]) & (kinds[:-1] != _SPACE) & ~inside[1:]
    starts = np.flatnonzero(edge | np.concatenate([[False], cut]))
    last = np.append(starts[1:], len(data)) - 1
    return starts, (kinds[last] == _LETTER) & ~inside[starts], inside


class PieceEncoder:
    """Ids of texts as little-endian bytes, one width for all."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The library reads an added token's string in a text as that token.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        strange = [r" (?:\s|$)", _SPLIT, *map(re.escape, self.added)]
        self.strange = re.compile("|".join(strange))
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        whole = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        # What the tokenizer does to spaces and case, whether its model alone
        # gives the ids of a run of letters, and whether runs stand alone.
        self.drops_space = all(whole(" " + p) == whole(p) for p in _PROBES)
        self.drops_case = all(whole(p.upper()) == whole(p.upper().lower()) for p in _PROBES)
        self.plain = all(self._model([" " * k + p])[0] == whole(" " * k + p) for p in _PROBES for k in (0, 1))
        mixed = [x for p in _PROBES for t in (*_MARKS, "...", "$$$", "!!", ".%%%") for x in (f"{p}{t}{p}\n{p}", f" {t}{p}\n{t}", f" {p}{t}")]
        self.apart = all(whole(x) == list(chain.from_iterable(map(whole, _RUNS.findall(x)))) for x in mixed)
        self._forget()

    def _forget(self) -> None:
        self.pool = _Pool(self.dtype)

    def _model(self, words: list[str]) -> list[list[int]]:
        """Ids of runs of letters by the tokenizer's model alone, which reads
        their bytes as letters; all are turned into these at once."""
        text = "\n".join(words)
        if self.drops_space:
            text = text.replace(" ", "")
        if self.drops_case:
            text = text.lower()
        spelled = text.encode().decode("latin-1").translate(_LETTERS).split(_LETTERS[ord("\n")])
        tokenize = self.tokenizer.model.tokenize
        return [[t.id for t in tokenize(w)] for w in spelled] if words else []

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self._flat([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def _flat(self, found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), self.dtype, int(counts.sum())), counts

    def _places(self, runs: list[str], letters: np.ndarray) -> np.ndarray:
        """Where the pool holds distinct runs; the ids of new ones are learned."""
        known = self.pool.at
        at = np.fromiter(map(known.get, runs, repeat(-1)), np.int64, len(runs))
        for some, learn in ((letters, lambda new: self._flat(self._model(new))), (~letters, self._library)):
            places = np.flatnonzero((at < 0) & some)
            if len(places):
                at[places] = len(known) + np.arange(len(places))
                new = [runs[i] for i in places.tolist()]
                self.pool.add(new, *learn(new))
        return at

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has."""
        if len(self.pool.at) > CACHE_RUNS:
            self._forget()
        whole = texts.to_pylist()
        odd = [i for i, t in enumerate(whole) if self.strange.search(t)]
        if odd:
            keep = np.ones(len(texts), bool)
            keep[odd] = False
            plain = texts.filter(pa.array(keep))
            ids, counts = self._library(texts.take(pa.array(odd)).to_pylist())
            more, sizes = self.encode(plain) if len(plain) else (np.zeros(0, self.dtype), np.zeros(0, np.int64))
            return _interleaved(keep, (more, sizes), (ids, counts))
        data, off = utf8(texts)
        if not len(data):
            return np.zeros(0, self.dtype), np.zeros(len(texts), np.int64)
        starts, letters, inside = _cut(data, off, self.apart)
        if self.drops_case:
            data = np.where(inside, data, _LOWERED[data])
        offsets = pa.py_buffer(np.append(starts, len(data)).astype(np.int32))
        found = pa.Array.from_buffers(pa.string(), len(starts), [None, offsets, pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        places = found.indices.to_numpy(zero_copy_only=False)
        of_letters = np.zeros(len(found.dictionary), bool)
        of_letters[places] = letters & self.plain
        runs = pa.ListArray.from_arrays(pa.array([0, len(found.dictionary)], pa.int32()), found.dictionary)
        at = self._places(pc.binary_join(runs, _SPLIT)[0].as_py().split(_SPLIT), of_letters)
        ids, counts = self.pool.runs(at[places])
        ends = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, off)]
        return ids, np.diff(ends)

    def ids(self, texts: pa.Array, end: int) -> pa.Array:
        """The ids of each text and ``end``, as bytes."""
        flat, counts = self.encode(texts)
        stops = np.cumsum(counts)
        flat = np.insert(flat, stops, end).astype(self.dtype, copy=False)
        offsets = np.concatenate([[0], stops + np.arange(1, len(texts) + 1)]) * self.dtype.itemsize
        buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(flat.tobytes())]
        return pa.Array.from_buffers(pa.binary(), len(texts), buffers)


def _interleaved(first: np.ndarray, one: tuple, two: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Runs (ids, counts) of two lists of texts in the order that ``first`` gives."""
    counts = np.zeros(len(first), np.int64)
    counts[first], counts[~first] = one[1], two[1]
    from_one = np.repeat(first, counts)
    ids = np.empty(len(from_one), one[0].dtype)
    ids[from_one], ids[~from_one] = one[0], two[0]
    return ids, counts


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder a worker process and tokenizer file."""
    if path not in _ENCODERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def id_dtype(width: int) -> np.dtype:
    return np.dtype(f"<u{width}")


def tokenized(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, width, ids: every document's ids and ``end_id``, as bytes.

    A null text is the empty text: the end id alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for part in slices(batch, size=BATCH_BYTES):
                ids = enc.ids(part.column("text"), end_id)
                width = pa.array([enc.dtype.itemsize] * len(ids), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), width, ids], ["doc_id", "width", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, width int, ids binary")
