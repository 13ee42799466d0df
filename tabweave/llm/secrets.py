"""Secret scanning: fixed rules, and a character convolutional network over every candidate and its context.

The rules find assignments, access keys and long hexadecimal runs. Candidates are their findings and all other
runs of 16 or more printable ASCII characters without quotes, brackets, commas and semicolons. A small convolutional
network in numpy scores each: embedded characters, filters of several widths over the token and its surroundings,
the maximum of each filter, and a logistic layer. Tokens longer than `TOKEN` are scored window by window, whole.

It is trained on labelled findings: generated ones of common kinds of secrets and of harmless tokens in ordinary
contexts; from `DOCUMENTS` documents, chosen by a hash of their ids, what the rules find (1), what their patterns
match but their lengths reject, and tokens of plain shapes such as words, addresses and paths (0), `SAMPLE` of
them at most. A temperature is fitted on held-out findings, against smoothed labels. Tokens with and without a
digit have a threshold each: of those that keep `recall` of the held-out secrets the ones of the best precision,
and among these the middle. Rule findings stay whatever their score; those below the threshold are counted as doubtful.

Edge cases: null and empty texts have no spans; rows that repeat get the same result each; an empty table gives
no rows; training needs no documents; scores equal to a threshold count; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.llm.common import table

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")
ACCESS_LEAST, HEX_LEAST, ASSIGN_LEAST = 18, 16, 12
LONG_HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so this is HEX with the least length
CANDIDATE = re.compile(r"[!#$%&*+./0-9:=?@A-Z\\^_a-z|~-]{16,}")
LEAST, MARKS = 16, frozenset("!#$%&*=.:?~-/")
#: Words with marks around them, addresses, paths and dates: labelled harmless.
PLAIN = re.compile(r"[!#$%&*=.:?~-]*(?:[A-Z]?[a-z]+|[A-Z]+)(?:[-_/.:+][A-Za-z]?[a-z]*)*[0-9]{0,4}[!#$%&*=.:?~-]*|[\w.+-]+@[a-z0-9-]+(?:\.[a-z]+)+\W*|https?://[a-z0-9.-]+(?:/[a-z0-9._-]{0,12})*|[0-9.:/T+-]+\W*", re.A)
HINT = re.compile(r"passw|secret|token|api_?key", re.I | re.A)
KINDS = ("assign", "access", "hex", "model")
CONTEXT, TOKEN, RECALL, SAMPLE, DOCUMENTS, ASKED = 24, 64, 0.95, 2000, 20_000, 4096
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_.=-:\"' \n,;<>()[]{}@$%&#!?*|\\"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) by the rules, each kind leftmost and non-overlapping."""
    out = []
    if HINT.search(text):
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    out += [(m.start(), m.end(), 2) for m in LONG_HEX.finditer(text)]
    return sorted(out)


def failed_spans(text: str) -> list[tuple[int, int]]:
    """What the rules' patterns match but their lengths reject."""
    out = [m.span() for m in ASSIGN.finditer(text) if len(m[2]) < ASSIGN_LEAST] if HINT.search(text) else []
    out += [m.span() for m in ACCESS.finditer(text) if len(m[0]) < ACCESS_LEAST] if "AKIA" in text else []
    return out


def candidates(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Long tokens; of those that rules' spans overlap, what is left before, between and after the spans, without the marks at its ends, if it is long enough."""
    out, k = [], 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while k < len(known) and known[k][1] <= start:
            k += 1
        at, touched = start, False
        for s, e, _ in known[max(0, k - 3):]:
            if s >= end:
                break
            if e > at:
                out += _remainder(text, at, s)
                at, touched = e, True
        out += _remainder(text, at, end) if touched else [(start, end)]
    return out


def _remainder(text: str, start: int, end: int) -> list[tuple[int, int]]:
    while start < end and text[start] in MARKS:
        start += 1
    while start < end and text[end - 1] in MARKS:
        end -= 1
    return [(start, end)] if end - start >= LEAST else []


def pieces(start: int, end: int) -> list[tuple[int, int]]:
    """Stretches of a token that are scored: itself, or, of a long one, overlapping ones of TOKEN characters."""
    if end - start <= TOKEN:
        return [(start, end)]
    return [(s, s + TOKEN) for s in range(start, end - TOKEN, TOKEN // 2)] + [(end - TOKEN, end)]


def window(text: str, start: int, end: int) -> str:
    """Context before, a piece of a token and context after, at fixed places."""
    return text[max(0, start - CONTEXT):start].rjust(CONTEXT, "\0") + text[start:end].ljust(TOKEN, "\0") + text[end:end + CONTEXT].ljust(CONTEXT, "\0")


_CODES = np.full(65536, 1, dtype=np.int64)
_CODES[0] = 0
for _i, _c in enumerate(ALPHABET):
    _CODES[ord(_c)] = _i + 2


def encode(windows: list[str]) -> np.ndarray:
    flat = np.frombuffer("".join(windows).encode("utf-32-le"), dtype=np.uint32)
    return _CODES[np.minimum(flat, 65535)].reshape(len(windows), -1)


class CharCnn:
    """Embedding, convolutions of several widths, max over positions, logistic layer; Adam on the logistic loss."""

    def __init__(self, widths: tuple[int, ...] = (3, 5, 7), filters: int = 16, size: int = 12, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        self.widths, self.temperature, self.thresholds = widths, 1.0, np.array([0.5, 0.5])
        self.p = {"emb": rng.normal(0, 0.3, (len(ALPHABET) + 2, size)), "out": rng.normal(0, 0.1, len(widths) * filters), "bias": np.zeros(1)}
        for w in widths:
            self.p[f"w{w}"], self.p[f"b{w}"] = rng.normal(0, (w * size) ** -0.5, (w * size, filters)), np.zeros(filters)

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, list]:
        e = self.p["emb"][x]
        pooled, kept = [], []
        for w in self.widths:
            view = np.lib.stride_tricks.sliding_window_view(e, w, axis=1).swapaxes(2, 3).reshape(len(x), x.shape[1] - w + 1, -1)
            z = view @ self.p[f"w{w}"] + self.p[f"b{w}"]
            at = z.argmax(axis=1)
            top = np.take_along_axis(z, at[:, None], axis=1)[:, 0]
            pooled.append(np.maximum(top, 0))
            kept.append((view, at, top > 0))
        hidden = np.concatenate(pooled, axis=1)
        return hidden @ self.p["out"] + self.p["bias"][0], [e, hidden, kept]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i:i + 512])[0] for i in range(0, len(x), 512)]) if len(x) else np.zeros(0)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 10, batch: int = 64, rate: float = 3e-3, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        m, v, t = {k: np.zeros_like(a) for k, a in self.p.items()}, {k: np.zeros_like(a) for k, a in self.p.items()}, 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                xb, yb = x[order[i:i + batch]], y[order[i:i + batch]]
                logit, (e, hidden, kept) = self._forward(xb)
                d = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - yb) / len(xb)
                g = {"out": hidden.T @ d, "bias": np.array([d.sum()]), "emb": np.zeros_like(self.p["emb"])}
                dh, filters, rows = d[:, None] * self.p["out"][None], len(self.p["b3"]), np.arange(len(xb))
                for k, w in enumerate(self.widths):
                    view, at, on = kept[k]
                    dz = dh[:, k * filters:(k + 1) * filters] * on
                    picked = view[rows[:, None], at]  # batch, filter, width * size
                    g[f"w{w}"], g[f"b{w}"] = np.einsum("bfk,bf->kf", picked, dz), dz.sum(axis=0)
                    de = (dz[:, :, None] * self.p[f"w{w}"].T[None]).reshape(len(xb), filters, w, -1)
                    np.add.at(g["emb"], xb[rows[:, None, None], at[:, :, None] + np.arange(w)[None, None]], de)
                t += 1
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)

    def found(self, x: np.ndarray) -> np.ndarray:
        return self.scores(x) >= self.thresholds[with_digit(x)]

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float = RECALL) -> None:
        """Temperature of least loss against smoothed labels, then a threshold for tokens with and without a digit."""
        logit = self.logits(x)
        ones = max(y.sum(), 1)
        smooth = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))
        loss = lambda t: np.mean(np.logaddexp(0, logit / t) - smooth * logit / t)
        self.temperature = float(min(np.geomspace(0.05, 20, 121), key=loss))
        for kind in (0, 1):
            own = with_digit(x) == kind
            self.thresholds[kind] = threshold(logit[own] / self.temperature, y[own], recall)


def with_digit(x: np.ndarray) -> np.ndarray:
    """1 for encoded windows whose token has a digit."""
    own = x[:, CONTEXT:CONTEXT + TOKEN]
    return ((own >= _CODES[ord("0")]) & (own <= _CODES[ord("9")])).any(axis=1).astype(int)


def threshold(logit: np.ndarray, y: np.ndarray, recall: float) -> float:
    """Of the cuts that keep the recall those of the best precision, and the middle of these."""
    if not len(logit) or not y.any():
        return 0.5
    positive, negative = np.sort(logit[y == 1]), np.sort(logit[y == 0])
    highest = positive[int((1 - recall) * len(positive))]
    cuts = np.append(positive[positive <= highest], highest)
    wrong = len(negative) - np.searchsorted(negative, cuts)
    right = len(positive) - np.searchsorted(positive, cuts)
    precision = right / (right + wrong)
    best = cuts[precision >= precision.max() - 1e-12]
    below = negative[negative < best.min()]
    low = below[-1] if len(below) else best.min()
    return float(1 / (1 + np.exp(-np.clip((low + best.max()) / 2, -40, 40))))


def generated_findings(n: int = 6000, seed: int = 9) -> tuple[list[str], np.ndarray]:
    """Windows and labels: random keys of common shapes in telling contexts, and words, numbers, addresses, paths and names in ordinary ones."""
    rng = np.random.default_rng(seed)
    span = lambda a, b: int(rng.integers(a, b))
    pick = lambda chars, size: "".join(rng.choice(list(chars), size))
    syllables = ["an", "the", "ing", "ion", "er", "st", "ment", "ver", "lich", "keit", "eau", "que", "elle", "tion", "in", "de", "ra", "mo", "li", "sch", "ung", "o", "ka", "ble", "schiff", "fahrt", "haupt", "stadt", "dampf", "ght", "ough", "pre", "zw", "ux", "itz", "wor", "cha", "phy", "du", "gu", "by", "fj", "ob"]
    word = lambda a=1, b=4: "".join(rng.choice(syllables, span(a, b)))
    prose = lambda: " ".join(word() for _ in range(6))
    alnum, b64, letters = ALPHABET[:62], ALPHABET[:64], ALPHABET[:52]
    secrets = [
        lambda: pick(b64, span(24, 64)) + "=" * span(0, 3), lambda: "ghp_" + pick(alnum, 36), lambda: "sk_live_" + pick(alnum, 24), lambda: "xoxb-" + pick("0123456789", 12) + "-" + pick(alnum, 24),
        lambda: pick("0123456789ABCDEF", span(24, 64)), lambda: "eyJ" + pick(alnum + "-_", span(16, 30)) + "." + pick(alnum + "-_", span(16, 30)), lambda: pick(alnum, span(16, 48)), lambda: pick(letters, span(20, 48)),
        lambda: pick(alnum + "!$@%#&*", span(16, 32)), lambda: word() + "://" + word() + ":" + pick(alnum, span(14, 24)) + "@" + word() + ".example", lambda: "AKIA" + pick(alnum[26:62], 16), lambda: word() + "=" + pick(alnum, span(20, 40)),
    ]
    marks = lambda: rng.choice(["", "", "", ".", "!!", "***", "&&&", "$$$", "###", "%%%", ":", "..."])
    harmless = [
        lambda: "-".join(word(1, 3) for _ in range(5)) + str(span(1, 99)), lambda: "/".join(word(1, 4) for _ in range(5)) + str(span(1, 9)), lambda: pick("0123456789", span(16, 22)), lambda: word(5, 9) + marks(), lambda: word(5, 9).capitalize() + marks(),
        lambda: word(6, 10).upper() + marks(), lambda: word(2, 4) + word(2, 4) + word(2, 4) + "_" + str(span(1900, 2100)), lambda: rng.choice(["-", "=", "*", "#", ".", "_"]) * span(16, 70), lambda: "2024-" + "-".join(pick("0123456789", 2) for _ in range(5)),
        lambda: f"{word()}.{span(1, 99)}@mail{span(0, 9)}.example.com" + marks(), lambda: "https://" + word(2, 5) + ".example/" + "/".join(word() for _ in range(3)), lambda: "+".join(word() for _ in range(5)) + "7", lambda: ".".join(str(span(100, 255)) for _ in range(4)) + marks() + "..",
        lambda: word(2, 4) + word(2, 4).capitalize() + word(2, 4).capitalize() + "()", lambda: "_".join(word(1, 4) for _ in range(5)), lambda: ".".join(word(1, 4) for _ in range(5)), lambda: "token" + rng.choice([" = ", ": ", "="]) + word(1, 3), lambda: "password:" + word(3, 5),
    ]
    leads = ["key = ", "auth: ", "bearer ", "credential ", "export KEY=", '"private": "', "", "aws "]
    out, labels = [], []
    for i in range(n):
        secret = i % 2
        token = ""
        while len(token) < 16:
            token = (secrets[rng.integers(len(secrets))] if secret else harmless[rng.integers(len(harmless))])()
            token += "" if len(token) >= 16 or secret else word()
        before = prose() + (" " + leads[rng.integers(len(leads))] if rng.random() < (0.6 if secret else 0.15) else " ")
        text = before + token + rng.choice([" ", "\n", ". ", '" ']) + prose()
        at = pieces(len(before), len(before) + len(token))
        out.append(window(text, *at[rng.integers(len(at))]))
        labels.append(secret)
    return out, np.array(labels)


@lru_cache(maxsize=4)
def generated_model(recall: float = RECALL) -> CharCnn:
    return trained([], np.zeros(0), recall)


def trained(windows: list[str], labels: np.ndarray, recall: float = RECALL) -> CharCnn:
    """A model of the generated findings and these; every fifth finding is held out for calibration."""
    more, known = generated_findings()
    x, y = encode(more + list(windows)), np.concatenate([known, labels])
    held = np.arange(len(x)) // 2 % 5 == 0
    model = CharCnn()
    model.fit(x[~held], y[~held])
    model.calibrate(x[held], y[held], recall)
    return model


def labelled_findings(docs: DataFrame, limit: int = SAMPLE, documents: int = DOCUMENTS) -> tuple[list[str], np.ndarray]:
    """At most `limit` windows of each label from `documents` documents: rule spans 1, failing matches and tokens of plain shapes 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, label = [], []
            for text in batch.column(0).to_pylist():
                known = base_spans(text) if text else []
                harmless = failed_spans(text) + [(s, e) for s, e in candidates(text, known) if PLAIN.fullmatch(text, s, e)] if text else []
                for spans, y in (([x[:2] for x in known], 1), (harmless, 0)):
                    found = [window(text, *p) for span in spans for p in pieces(*span)]
                    out += found
                    label += [y] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(label, pa.int32())], ["w", "y"])

    chosen = docs.select(F.col("doc_id").alias("__id")).where("__id IS NOT NULL").distinct().orderBy(F.xxhash64("__id"), "__id").limit(documents)
    rows = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"), "left_semi").select("text").mapInArrow(run, "w string, y int").distinct()  # at most `documents` ids
    each = [rows.where(F.col("y") == y).orderBy(F.xxhash64("w"), "w").limit(limit) for y in (0, 1)]
    got = each[0].unionByName(each[1]).toArrow()
    return got.column(0).to_pylist(), got.column(1).to_numpy().astype(float)


def _scored(model: CharCnn, asked: list[tuple[int, int, int, int]], windows: list[str], more: list[list], doubtful: list[int]) -> None:
    """asked: row, start, end of a piece, and the rule's finding that it is of, or -1. Adds spans to more, and findings not recognised to doubtful."""
    sure: dict[tuple[int, int], bool] = {}
    for (i, start, end, rule), found in zip(asked, model.found(encode(windows)), strict=True):
        if rule >= 0:
            sure[i, rule] = sure.get((i, rule), False) or bool(found)
        elif found and more[i] and more[i][-1][1] >= start:  # pieces of one token
            more[i][-1] = (more[i][-1][0], end, 3)
        elif found:
            more[i].append((start, end, 3))
    for (i, _), found in sure.items():
        doubtful[i] += not found
    asked.clear()
    windows.clear()


def scan(docs: DataFrame, model: CharCnn) -> DataFrame:
    """docs: doc_id, text. Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_model (spans added), n_doubtful (rule spans that the network does not take for secrets)."""
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_model", "n_doubtful"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        show = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)
        for batch in batches:
            n = batch.num_rows
            base, more, doubtful, asked, windows = [], [[] for _ in range(n)], [0] * n, [], []
            for i, text in enumerate(x.as_py() for x in batch.column(1)):
                known = base_spans(text) if text else []
                base.append(known)
                spans = [(s, e, k) for k, (s, e, _) in enumerate(known)] + [(s, e, -1) for s, e in candidates(text, known)] if text else []
                for start, end, rule in spans:
                    for s, e in pieces(start, end):
                        asked.append((i, s, e, rule))
                        windows.append(window(text, s, e))
                    if len(asked) >= ASKED:
                        _scored(model, asked, windows, more, doubtful)
            if asked:
                _scored(model, asked, windows, more, doubtful)
            counts = [pa.array([sum(k == kind for *_, k in b) for b in base], pa.int64()) for kind in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array([hashlib.sha256(show(b).encode()).hexdigest() for b in base], pa.string()), pa.array([show(sorted(b + m)) for b, m in zip(base, more, strict=True)], pa.string()),
                                              pa.array([len(m) for m in more], pa.int64()), pa.array(doubtful, pa.int64())], names)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_model long, n_doubtful long")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, trained(*labelled_findings(docs)))
