"""Personal data: a character-level bidirectional LSTM with CRF transitions,
trained in numpy from labelled spans.

The base rules find emails, IP addresses, cards and phone numbers by pattern.
They also label the training spans: windows around matches in a bounded sample
of documents, some with the match rewritten in another form that the patterns
miss (a phone number without "+", an address with spaces or a bracketed
at-sign), and windows with other digits as counter-examples. The model then
adds spans to the base ones.

A text is read in overlapping windows. Each window is decoded by Viterbi, a
character takes its tag from the window it lies deepest in, and spans are cut
from the tags of the whole text. A span needs a digit or an "@" whatever its
kind, so windows without either hold no span and are not run.

Defined cases: null and empty texts have no spans; repeated rows and null
doc_ids are documents like any other; without a sample to learn from, the
model learns from generated spans alone; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.common import first_by_hash, text_or_empty
from starlane.llm.shingles import slices

KINDS = ("email", "ip", "card", "phone")
# The bound of the training sample: so many documents with a digit or an "@",
# of at most so many characters.
SAMPLE_DOCS = 600
SAMPLE_CHARS = 20_000
TRAIN_WINDOWS = 1600
WINDOW = 64
OVERLAP = 24
HIDDEN = 16
PASSES = 7
SEED = 5
# Windows run through the model at once.
BATCH = 4096

Span = tuple[int, int, str]

_LOCAL_RUN = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive: a long run of digits is read once.
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")


def _emails(text: str) -> Iterator[Span]:
    # By runs of local characters: a long run without "@" is read once.
    end = 0
    for run in _LOCAL_RUN.finditer(text):
        start = max(run.start(), end)
        found = _DOMAIN.match(text, run.end()) if start < run.end() else None
        if found:
            end = found.end()
            yield start, end, "email"


def _ips(text: str) -> Iterator[Span]:
    for run in _DOTTED.finditer(text):
        at = run.start()
        parts = run.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, at + size, "ip"
            at += size + 1


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base rules, by start, then kind as listed."""
    if not _TRIGGER.search(text):
        return []
    found = list(_emails(text)) if "@" in text else []
    found += _ips(text)
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 14 <= len(digits) <= 19 and passes_luhn(digits):
            found.append((*m.span(), "card"))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m.group())) <= 15:
            found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# Character classes: letters by case, digits, each other ASCII character, and the rest.
_CLASS = np.zeros(129, np.int64)
_CLASS[32:127] = np.arange(5, 100)
_CLASS[10] = 4
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123], _CLASS[128] = 1, 2, 3, 100
CLASSES = 101
TAGS = 1 + 2 * len(KINDS)  # 0: outside; 1 + 2k: first of kind k; 2 + 2k: further


def classes(text: str) -> np.ndarray:
    return _CLASS[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 128)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Model:
    """Two LSTMs over character classes, a linear layer to tags, CRF transitions."""

    def __init__(self, rng: np.random.Generator, hidden: int = HIDDEN) -> None:
        h = hidden
        draw = lambda *s: (rng.standard_normal(s) * 0.15).astype(np.float32)
        self.hidden = h
        self.p = {}
        for way in "fb":
            self.p[f"in_{way}"], self.p[f"rec_{way}"] = draw(CLASSES, 4 * h), draw(h, 4 * h)
            self.p[f"in_{way}"][:, h : 2 * h] += 1  # remember at first
        self.p["out"], self.p["bias"] = draw(2 * h, TAGS), np.zeros(TAGS, np.float32)
        self.p["move"], self.p["first"] = np.zeros((TAGS, TAGS), np.float32), np.zeros(TAGS, np.float32)

    def _lstm(self, x: np.ndarray, way: str, trace: list | None = None) -> np.ndarray:
        """Hidden states, (steps, windows, hidden); x is (steps, windows)."""
        h = self.hidden
        table, rec = self.p[f"in_{way}"], self.p[f"rec_{way}"]
        steps = range(len(x)) if way == "f" else range(len(x) - 1, -1, -1)
        state = cell = np.zeros((x.shape[1], h), np.float32)
        out = np.empty((*x.shape, h), np.float32)
        for t in steps:
            z = table[x[t]] + state @ rec
            gates = _sigmoid(z[:, : 3 * h])
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            g = np.tanh(z[:, 3 * h :])
            before, previous = cell, state
            cell = f * cell + i * g
            squashed = np.tanh(cell)
            state = o * squashed
            out[t] = state
            if trace is not None:
                trace.append((t, i, f, o, g, before, previous, squashed))
        return out

    def emissions(self, x: np.ndarray, traces: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        both = [self._lstm(x, way, None if traces is None else traces.setdefault(way, [])) for way in "fb"]
        states = np.concatenate(both, axis=2)
        return states @ self.p["out"] + self.p["bias"], states

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best tags (Viterbi), (steps, windows)."""
        e, _ = self.emissions(x)
        best = e[0] + self.p["first"]
        came = np.empty(e.shape, np.int8)
        for t in range(1, len(e)):
            options = best[:, :, None] + self.p["move"]
            came[t] = options.argmax(axis=1)
            best = options.max(axis=1) + e[t]
        tags = np.empty(x.shape, np.int64)
        tags[-1] = best.argmax(axis=1)
        row = np.arange(x.shape[1])
        for t in range(len(e) - 1, 0, -1):
            tags[t - 1] = came[t, row, tags[t]]
        return tags

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tag sequences y, and its gradients."""
        traces: dict[str, list] = {}
        e, states = self.emissions(x, traces)
        steps, n, _ = e.shape
        move = self.p["move"]

        def logsum(a: np.ndarray, axis: int) -> np.ndarray:
            top = a.max(axis=axis, keepdims=True)
            return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)

        ahead, behind = np.empty_like(e), np.zeros_like(e)
        ahead[0] = e[0] + self.p["first"]
        for t in range(1, steps):
            ahead[t] = logsum(ahead[t - 1][:, :, None] + move, 1) + e[t]
        for t in range(steps - 2, -1, -1):
            behind[t] = logsum(move + (e[t + 1] + behind[t + 1])[:, None, :], 2)
        total = logsum(ahead[-1], 1)
        row = np.arange(n)
        gold = e[np.arange(steps)[:, None], row, y].sum(axis=0) + self.p["first"][y[0]] + move[y[:-1], y[1:]].sum(axis=0)
        d_e = np.exp(ahead + behind - total[:, None])
        d_first = d_e[0].sum(axis=0)
        d_e[np.arange(steps)[:, None], row, y] -= 1
        d_move = np.zeros_like(move)
        for t in range(1, steps):
            d_move += np.exp(ahead[t - 1][:, :, None] + move + (e[t] + behind[t])[:, None, :] - total[:, None, None]).sum(axis=0)
        np.add.at(d_move, (y[:-1], y[1:]), -1)
        d_first -= np.bincount(y[0], minlength=TAGS)
        grads = {"move": d_move, "first": d_first, "out": np.tensordot(states, d_e, ((0, 1), (0, 1))), "bias": d_e.sum(axis=(0, 1))}
        d_states = d_e @ self.p["out"].T
        h = self.hidden
        for k, way in enumerate("fb"):
            d_in, d_rec = np.zeros_like(self.p[f"in_{way}"]), np.zeros_like(self.p[f"rec_{way}"])
            d_h = d_c = np.zeros((n, h), np.float32)
            for t, i, f, o, g, before, previous, squashed in reversed(traces[way]):
                d_state = d_states[t][:, k * h : (k + 1) * h] + d_h
                d_c = d_c + d_state * o * (1 - squashed * squashed)
                parts = (d_c * g * i * (1 - i), d_c * before * f * (1 - f), d_state * squashed * o * (1 - o), d_c * i * (1 - g * g))
                d_z = np.concatenate(parts, axis=1)
                np.add.at(d_in, x[t], d_z)
                d_rec += previous.T @ d_z
                d_h = d_z @ self.p[f"rec_{way}"].T
                d_c = d_c * f
            grads[f"in_{way}"], grads[f"rec_{way}"] = d_in, d_rec
        return float((total - gold).mean()), {k: g / n for k, g in grads.items()}

    def fit(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, passes: int = PASSES, size: int = 64, rate: float = 0.02) -> None:
        """Adam on random batches; x and y are (windows, steps)."""
        one = {k: np.zeros_like(v) for k, v in self.p.items()}
        two = {k: np.zeros_like(v) for k, v in self.p.items()}
        turn = 0
        for _ in range(passes):
            order = rng.permutation(len(x))
            for a in range(0, len(x), size):
                some = order[a : a + size]
                _, grads = self.gradients(x[some].T, y[some].T)
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                turn += 1
                for k, g in grads.items():
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    one[k] += 0.1 * (g - one[k])
                    two[k] += 0.01 * (g * g - two[k])
                    step = (one[k] / (1 - 0.9**turn)) / (np.sqrt(two[k] / (1 - 0.99**turn)) + 1e-7)
                    self.p[k] -= (rate * step).astype(np.float32)


def _generated(kind: str, rng: np.random.Generator) -> str:
    """A value of a kind, in one of the forms a text may hold it in."""
    letters = lambda n: "".join(rng.choice(list("abcdefghijklmnoprstuvw"), n))
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    if kind == "email":
        at = ["@", "@", " @ ", "[@]"][rng.integers(4)]
        tail = ["com", "org", "example.com", "net"][rng.integers(4)]
        return f"{letters(rng.integers(2, 9))}{['', '.', '_'][rng.integers(3)]}{digits(rng.integers(0, 3))}{at}{letters(rng.integers(3, 9))}.{tail}"
    if kind == "ip":
        return [".", ".", " . "][rng.integers(3)].join(str(n) for n in rng.integers(0, 256, 4))
    if kind == "card":
        body = digits(int(rng.integers(13, 18)))
        check = next(c for c in "0123456789" if passes_luhn(body + c))
        gap = ["", " ", "-", "."][rng.integers(4)]
        return gap.join(re.findall(".{1,4}", body + check)) if gap else body + check
    form = ["+{} ({}) {}-{}", "+{} {} {} {}", "({1}) {2}-{3}", "{1}-{2}-{3}", "{1}.{2}.{3}"][rng.integers(5)]
    return form.format(rng.integers(1, 99), digits(3), digits(3), digits(4))


def _other(rng: np.random.Generator) -> str:
    """Digits and signs that are no personal data: years, amounts, versions, hex keys."""
    n = rng.integers
    forms = (f"{n(1900, 2100)}", f"{n(1, 999)}.{n(0, 99):02d}", f"v{n(0, 9)}.{n(0, 20)}", f"{n(1, 99)}%", f"({n(1900, 2030)})", f"{n(1, 10**6)}")
    if rng.random() < 0.3:
        return "".join(rng.choice(list("0123456789abcdef"), int(n(8, 40))))
    return forms[n(len(forms))]


_FILLER = "the of and with other words in lines. "


def training_windows(texts: list[str], rng: np.random.Generator, number: int = TRAIN_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """(classes, tags) of windows around labelled spans and counter-examples."""
    known = [(t, s) for t in texts for s in base_spans(t)[:20]]
    texts = texts or [_FILLER]
    xs, ys = [], []
    for k in range(number):
        if known and k % 2:
            text, (start, end, kind) = known[rng.integers(len(known))]
            value = text[start:end] if rng.random() < 0.6 else _generated(kind, rng)
        else:
            text = texts[rng.integers(len(texts))] or _FILLER
            start = end = int(rng.integers(0, len(text) + 1))
            kind = KINDS[rng.integers(len(KINDS))] if rng.random() < 0.6 else ""
            value = " " + (_generated(kind, rng) if kind else _other(rng)) + " "
        shift = int(rng.integers(0, max(1, WINDOW - len(value))))
        left, right = text[max(0, start - shift) : start], text[end : end + WINDOW]
        body = left + value + right
        tags = np.zeros(max(WINDOW, len(body)), np.int64)
        if kind:
            a = len(left) + len(value) - len(value.lstrip())
            b = a + len(value.strip())
            tags[a:b] = 2 + 2 * KINDS.index(kind)
            tags[a] -= 1
        for s, e, other in base_spans(left) + [(len(left) + len(value) + s, len(left) + len(value) + e, o) for s, e, o in base_spans(right)]:
            tags[s:e] = 2 + 2 * KINDS.index(other)
            tags[s] -= 1
        x = np.zeros(WINDOW, np.int64)
        x[: min(WINDOW, len(body))] = classes(body[:WINDOW])
        xs.append(x)
        ys.append(tags[:WINDOW])
    return np.stack(xs), np.stack(ys)


def _window_starts(n: int) -> np.ndarray:
    step = WINDOW - OVERLAP
    return np.arange(0, max(1, n - OVERLAP), step)


def model_tags(model: Model, texts: list[str]) -> list[np.ndarray]:
    """Tags of each text's characters, put together from overlapping windows."""
    codes = [classes(t) for t in texts]
    where: list[tuple[int, int]] = []
    windows: list[np.ndarray] = []
    at_sign = _CLASS[ord("@")]
    for i, c in enumerate(codes):
        marks = np.concatenate([[0], np.cumsum((c == 1) | (c == at_sign))])
        for a in _window_starts(len(c)).tolist():
            b = min(a + WINDOW, len(c))
            if marks[b] > marks[a]:
                x = np.zeros(WINDOW, np.int64)
                x[: b - a] = c[a:b]
                where.append((i, a))
                windows.append(x)
    tags = [np.zeros(len(c), np.int64) for c in codes]
    half = OVERLAP // 2
    for k in range(0, len(windows), BATCH):
        found = model.decode(np.stack(windows[k : k + BATCH]).T).T
        for (i, a), y in zip(where[k : k + BATCH], found, strict=True):
            # The window's own part: up to half an overlap from its ends.
            low = a if a == 0 else a + half
            high = len(tags[i]) if a + WINDOW >= len(tags[i]) else a + WINDOW - half
            tags[i][low:high] = y[low - a : high - a]
    return tags


def _plausible(value: str, kind: str) -> bool:
    digits = len(_digits(value))
    if kind == "email":
        name, at, host = value.partition("@")
        return bool(at) and any(c.isalnum() for c in name) and "." in host.strip(". ]") and any(c.isalnum() for c in host)
    if any(c.isalpha() for c in value):
        return False
    if kind == "ip":
        parts = [p.strip() for p in value.split(".")]
        return len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= digits <= 19 and passes_luhn(_digits(value))
    return 10 <= digits <= 15 and digits < len(value)


def added_spans(text: str, tags: np.ndarray, base: list[Span]) -> list[Span]:
    """Spans of the tags that no base span touches and that can be of their kind."""
    taken = np.zeros(len(text) + 1, bool)
    for s, e, _ in base:
        taken[s:e] = True
    kind_of = (tags + 1) // 2
    new = np.flatnonzero(np.concatenate([[True], (kind_of[1:] != kind_of[:-1]) | (tags[1:] % 2 == 1)])) if len(tags) else []
    out = []
    for a, b in zip(new, [*new[1:], len(tags)], strict=True):
        if kind_of[a] == 0:
            continue
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        kind = KINDS[int(kind_of[min(a, len(tags) - 1)]) - 1]
        cut = (a > 0 and text[a - 1].isalnum()) or (b < len(text) and text[b].isalnum())
        if a < b and not cut and not taken[a:b].any() and _plausible(text[a:b], kind):
            out.append((int(a), int(b), kind))
    return out


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def train(spark: SparkSession, docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on at most ``sample_docs`` distinct documents, the first by a hash of id and text."""
    some = docs.select("doc_id", text_or_empty().alias("text")).where(F.col("text").rlike("[0-9@]") & (F.length("text") <= SAMPLE_CHARS))
    some = first_by_hash(some.select(F.xxhash64("doc_id", "text").alias("h"), "text"), sample_docs, "h")
    rng = np.random.default_rng(SEED)
    x, y = training_windows([r["text"] for r in some.collect()], rng)
    model = Model(rng)
    model.fit(x, y, rng)
    return model


def found(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, counts of base spans per kind, base_sha256, spans of each document."""
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]
    types = [pa.int64(), *[pa.int64()] * 4, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                base = [base_spans(t) for t in texts]
                marked = [i for i, t in enumerate(texts) if _TRIGGER.search(t)]
                every = list(base)
                for i, tags in zip(marked, model_tags(model, [texts[i] for i in marked]), strict=True):
                    more = added_spans(texts[i], tags, base[i])
                    every[i] = sorted(base[i] + more, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
                columns = [part.column("doc_id")]
                columns += [[sum(s[2] == k for s in b) for b in base] for k in KINDS]
                columns.append([hashlib.sha256(spelled(b).encode()).hexdigest() for b in base])
                columns.append([spelled(s) for s in every])
                yield pa.RecordBatch.from_arrays(
                    [columns[0], *[pa.array(c, t) for c, t in zip(columns[1:], types[1:], strict=True)]], names
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return rows.mapInArrow(run, schema)
