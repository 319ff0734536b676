"""Personal data by rules, and by a character-level bidirectional LSTM with CRF transitions that adds what rules miss.

The network is trained in numpy from labelled spans: windows of the corpus itself, labelled by the rules, and made ones in
forms that the rules do not know. A text's overlapping windows give one lattice: where two windows overlap their emissions
are averaged, each weighing more towards its middle, and one Viterbi path runs through them all. What overlaps is settled
over the whole text: spans by rule stay, then longer ones go first. Every kind holds a digit or an ``@``, so that a window
without either has no span by definition and is not run.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import text_of

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
WINDOW, HIDDEN = 96, 20
STRIDE = WINDOW // 2
#: Windows of the corpus that the network is trained on at most, and made ones.
SAMPLE, MADE = 1500, 2000
SIGN = re.compile("[0-9@]")
# The same matches as the plain patterns, without trying a run of digits again from its middle.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def by_rule(text: str) -> list[Span]:
    """Leftmost matches of each kind that pass its test, by start and kind. Offsets count code points."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, 0, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    if not re.search("[0-9]", text):
        return out
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (g.lstrip("0") or "0" for g in m.groups())):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


_CHARS = "abcdefghijklmnopqrstuvwxyz0 \n" + "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_ID = np.zeros(128, np.int64)  # 0: any other character
for _i, _c in enumerate(_CHARS, 1):
    _ID[ord(_c)] = _i
_ID[65:91], _ID[48:58], _ID[[9, 11, 12, 13]] = _ID[97:123], _ID[48], _ID[10]
VOCABULARY = len(_CHARS) + 1


def character_ids(text: str) -> np.ndarray:
    """Letters without case, one class for digits, signs as they are, 0 for the rest."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _ID[np.minimum(points, 127)], 0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Both directions' input tables (VOCABULARY x 4 HIDDEN, bias within), recurrent weights, the output and transitions."""

    p: dict[str, np.ndarray]

    @staticmethod
    def new(seed: int = 0, hidden: int = HIDDEN) -> Network:
        r = np.random.default_rng(seed)
        p = {}
        for d in "fb":
            p["x" + d] = r.normal(0, 0.3, (VOCABULARY, 4 * hidden)).astype(np.float32)
            p["x" + d][:, hidden : 2 * hidden] += 1
            p["h" + d] = r.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden)).astype(np.float32)
        p["out"] = r.normal(0, 0.3, (2 * hidden, TAGS)).astype(np.float32)
        p["bias"] = np.zeros(TAGS, np.float32)
        p["move"] = np.zeros((TAGS, TAGS), np.float32)
        return Network(p)

    def _direction(self, ids: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """Hidden states (time, rows, hidden) of one direction over ids (time, rows), in the order of ``ids``."""
        x, u = self.p["x" + d], self.p["h" + d]
        k = u.shape[0]
        h = c = np.zeros((ids.shape[1], k), np.float32)
        out = np.empty((*ids.shape, k), np.float32)
        for t in range(len(ids)):
            z = x[ids[t]] + h @ u
            gates, g = _sigmoid(z[:, : 3 * k]), np.tanh(z[:, 3 * k :])
            i, f, o = gates[:, :k], gates[:, k : 2 * k], gates[:, 2 * k :]
            was, before = c, h
            c = f * c + i * g
            s = np.tanh(c)
            h = o * s
            out[t] = h
            if keep is not None:
                keep.append((i, f, o, g, was, s, before))
        return out

    def emissions(self, ids: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Tag scores (time, rows, TAGS)."""
        kept = {d: [] if keep is not None else None for d in "fb"}
        h = np.concatenate([self._direction(ids, "f", kept["f"]), self._direction(ids[::-1], "b", kept["b"])[::-1]], axis=2)
        if keep is not None:
            keep |= kept | {"h": h}
        return h @ self.p["out"] + self.p["bias"]

    def best(self, e: np.ndarray) -> np.ndarray:
        """The best tags (time, rows) of tag scores (time, rows, TAGS), by Viterbi."""
        move = self.p["move"]
        back = np.empty(e.shape, np.int8)
        score = e[0]
        for t in range(1, len(e)):
            both = score[:, :, None] + move
            back[t] = both.argmax(axis=1)
            score = both.max(axis=1) + e[t]
        out = np.empty(e.shape[:2], np.int64)
        out[-1] = score.argmax(axis=1)
        rows = np.arange(e.shape[1])
        for t in range(len(e) - 1, 0, -1):
            out[t - 1] = back[t][rows, out[t]]
        return out

    def loss(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """The CRF's negative log-likelihood a character, and its gradient by every parameter."""
        keep: dict = {}
        e, move = self.emissions(ids, keep).astype(np.float64), self.p["move"].astype(np.float64)
        n, rows = e.shape[:2]
        # forward and backward in probabilities, each time's scaled to a sum of 1
        high, top = e.max(axis=2), move.max()
        em, m = np.exp(e - high[:, :, None]), np.exp(move - top)
        a, b, c = np.empty(e.shape), np.ones(e.shape), np.empty((n, rows))
        for t in range(n):
            x = (a[t - 1] @ m) * em[t] if t else em[t]
            c[t] = x.sum(axis=1)
            a[t] = x / c[t][:, None]
        for t in range(n - 2, -1, -1):
            b[t] = ((em[t + 1] * b[t + 1]) @ m.T) / c[t + 1][:, None]
        z = np.log(c).sum(axis=0) + high.sum(axis=0) + (n - 1) * top
        at = np.arange(rows)
        gold = e[np.arange(n)[:, None], at, tags].sum(axis=0) + move[tags[:-1], tags[1:]].sum(axis=0)
        de = a * b
        after = (em * b / c[:, :, None])[1:].reshape(-1, TAGS)
        dmove = m * (a[:-1].reshape(-1, TAGS).T @ after)
        dmove -= np.bincount((tags[:-1] * TAGS + tags[1:]).ravel(), minlength=TAGS * TAGS).reshape(TAGS, TAGS)
        de[np.arange(n)[:, None], at, tags] -= 1
        scale = 1 / (n * rows)
        de = (de * scale).astype(np.float32)
        k = self.p["hf"].shape[0]
        dh = de @ self.p["out"].T
        g = {"move": (dmove * scale).astype(np.float32), "bias": de.sum(axis=(0, 1)), "out": np.tensordot(keep["h"], de, axes=([0, 1], [0, 1]))}
        for d, own, order in (("f", dh[..., :k], ids), ("b", dh[..., k:][::-1], ids[::-1])):
            g["x" + d], g["h" + d] = self._back(order, own, keep[d], d)
        return float((z - gold).sum() * scale), g

    def _back(self, ids: np.ndarray, dh: np.ndarray, kept: list, d: str) -> tuple[np.ndarray, np.ndarray]:
        u = self.p["h" + d]
        h = c = np.zeros((ids.shape[1], u.shape[0]), u.dtype)
        dz = np.empty((*ids.shape, u.shape[1]), u.dtype)
        for t in range(len(ids) - 1, -1, -1):
            i, f, o, g, was, s, _ = kept[t]
            h = h + dh[t]
            c = c + h * o * (1 - s * s)
            dz[t] = np.concatenate([c * g * i * (1 - i), c * was * f * (1 - f), h * s * o * (1 - o), c * i * (1 - g * g)], axis=1)
            h, c = dz[t] @ u.T, c * f
        flat = dz.reshape(-1, u.shape[1])
        one = np.zeros((len(flat), VOCABULARY), u.dtype)
        one[np.arange(len(flat)), ids.ravel()] = 1
        before = np.stack([k[-1] for k in kept]).reshape(len(flat), -1)
        return one.T @ flat, before.T @ flat


def tag_row(size: int, spans: Iterable[Span]) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for start, kind, end in spans:
        out[start:end] = 2 + 2 * kind
        out[start] = 1 + 2 * kind
    return out


def train(examples: list[tuple[str, list[Span]]], passes: int = 10, batch: int = 64, rate: float = 0.02, seed: int = 0, start: Network | None = None) -> Network:
    """Fit to texts of at most WINDOW characters with their labelled spans, by Adam; from ``start`` if it is given."""
    net, r = Network.new(seed) if start is None else Network({k: v.copy() for k, v in start.p.items()}), np.random.default_rng(seed)
    ids, tags = np.zeros((WINDOW, len(examples)), np.int64), np.zeros((WINDOW, len(examples)), np.int64)
    for j, (text, spans) in enumerate(examples):
        ids[: len(text), j], tags[: len(text), j] = character_ids(text), tag_row(len(text), spans)
    m, v, step = ({k: np.zeros_like(x) for k, x in net.p.items()} for _ in range(2)), None, 0
    m, v = m
    for turn in range(passes):
        order = r.permutation(len(examples))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            _, g = net.loss(ids[:, own], tags[:, own])
            step += 1
            for k, x in g.items():
                m[k] += 0.1 * (x - m[k])
                v[k] += 0.01 * (x * x - v[k])
                net.p[k] -= rate * (1 - turn / passes) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return net


def examples(count: int = MADE, seed: int = 0) -> list[tuple[str, list[Span]]]:
    """Labelled windows made by rule: words, numbers that are nobody's, and data of each kind, also in forms that the
    rules do not know (numbers without a country's sign, spaced addresses, other separators)."""
    r = np.random.default_rng(seed)
    pick = lambda *x: x[r.integers(len(x))]
    digits = lambda n: "".join(map(str, r.integers(0, 10, n)))
    word = lambda: "".join(pick("th", "er", "on", "an", "re", "en", "ti", "es", "or", "ou", "in", "st", "ed", "é", "ü", "la", "de") for _ in range(r.integers(1, 5)))

    def card() -> str:
        d = pick("4", "5", "37") + digits(12)
        d += next(c for c in "0123456789" if luhn(d + c))
        sep = pick("", "", " ", "-", ".")
        return sep.join(d[i : i + 4] for i in range(0, len(d), 4))

    def kind(k: int) -> str:
        if k == 0:
            return pick(word(), word() + "." + word()) + pick("", digits(2), "." + digits(2)) + pick("@", "@", "@", " @ ") + word() + pick("", digits(1)) + pick(".com", ".example.com", ".org", ".co.uk")
        if k == 1:
            return ".".join(str(x) for x in r.integers(0, 256, 4))
        if k == 2:
            return card()
        a, b, c = digits(3), digits(3), digits(4)
        return pick("+1 ", "+1 ", "+44 ", "", "", "1-", "00") + pick(f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"({a}){b}-{c}")

    def nobodys() -> str:
        return pick(digits(r.integers(1, 9)), f"{digits(4)}-{digits(2)}-{digits(2)}", f"{digits(2)}:{digits(2)}", f"{digits(1)}.{digits(1)}.{digits(1)}", f"${digits(3)}.{digits(2)}", f"{digits(2)}%", f"#{digits(6)}", f"@{word()}", f"v{digits(1)}.{digits(2)}", word() + digits(2), digits(24))

    out = []
    for _ in range(count):
        text, spans = "", []
        for _ in range(r.integers(2, 6)):
            for _ in range(r.integers(1, 5)):
                text += word() + pick(" ", " ", " ", ", ", ". ", "\n")
            if (x := r.random()) < 0.45:
                k = int(r.integers(len(KINDS)))
                for _ in range(pick(1, 1, 1, 2)):  # numbers side by side are one to a rule
                    found = kind(k)
                    spans.append((len(text), k, len(text) + len(found)))
                    text += found + pick(" ", " ", ", ", ". ", "### ", "!! ")
            elif x < 0.75:
                text += nobodys() + pick(" ", " ", ", ", ". ")
        first = int(r.integers(0, max(1, len(text) - WINDOW + 1)))
        out.append((text[first : first + WINDOW], [(max(0, s - first), k, min(WINDOW, e - first)) for s, k, e in spans if e > first and s < first + WINDOW]))
    return out


def shaped(text: str, at: int) -> tuple[str, list[Span]] | None:
    """The window of a text around ``at`` with its spans by rule, those of cards by their shape alone: the network is to
    see numbers of that form, and the checksum decides. None where a run of digits is longer than any kind."""
    first = max(0, at - (7 * at + len(text)) % (WINDOW - 32))
    part = text[first : first + WINDOW]
    cards = [(m.start(), 2, m.end()) for m in CARD.finditer(part) if m.end() - m.start() >= 14]
    if any(len(re.sub("[^0-9]", "", part[s:e])) > 19 for s, _, e in cards):
        return None
    return part, sorted({x for x in by_rule(part) if x[1] != 2} | set(cards))


def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = {}
        for text in b.column("text"):
            end = 0
            for m in SIGN.finditer(text := text.as_py()):
                if m.start() >= end and (own := shaped(text, m.start())):
                    found[own[0]] = own[1]
                    end = m.start() + STRIDE
        spans = [[x for s in v for x in s] for v in found.values()]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(spans, pa.list_(pa.int32()))], ["text", "spans"])


def labelled(texts: DataFrame, sample: int = SAMPLE) -> list[tuple[str, list[Span]]]:
    """At most ``sample`` different windows of the column ``text`` that hold a digit or an ``@``, drawn by a hash, with
    their spans. Copies count once."""
    rows = texts.select("text").where(F.col("text").rlike("[0-9@]")).mapInArrow(_windows, "text string, spans array<int>")
    rows = rows.groupBy("text").agg(F.min("spans").alias("spans")).orderBy(F.xxhash64("text"), "text").limit(sample).collect()
    return [(r.text, [(x[i], x[i + 1], x[i + 2]) for i in range(0, len(x), 3)]) for r in rows for x in [r.spans]]


@lru_cache(1)
def standard() -> Network:
    """The network of the made examples; trained once a process."""
    return train(examples())


def trained(own: list[tuple[str, list[Span]]]) -> Network:
    """The standard network, trained further on ``own`` windows and as many made ones or more."""
    return train(own + examples(max(500, len(own)), seed=1), passes=4, rate=0.01, start=standard()) if own else standard()


#: Digits that a kind has at least; an address has an @.
LEAST = (0, 4, 13, 10)
#: The weight of a window's first half; that of the second is the rest, in reverse.
RISING = ((np.arange(STRIDE) + 0.5) / STRIDE).astype(np.float32)[:, None]


def lattices(net: Network, texts: list[str], batch: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(texts' numbers, starts, tag scores (time, rows, TAGS)): each run of windows that overlap as one sequence, runs of
    one length together. Windows are WINDOW characters every STRIDE, where a digit or an ``@`` is in reach."""
    whose, starts, rows = [], [], []
    for j, text in enumerate(texts):
        if not SIGN.search(text):
            continue
        ids = character_ids(text)
        signs = np.flatnonzero((ids == _ID[48]) | (ids == _ID[64])) // STRIDE
        own = np.unique(np.concatenate([signs, np.maximum(signs - 1, 0)])) * STRIDE
        rows.append(np.lib.stride_tricks.sliding_window_view(np.pad(ids, (0, WINDOW)), WINDOW)[own])
        whose.append(np.full(len(own), j))
        starts.append(own)
    if not rows:
        return
    rows, whose, starts = np.concatenate(rows), np.concatenate(whose), np.concatenate(starts)
    e = np.concatenate([net.emissions(np.ascontiguousarray(rows[at : at + batch].T)).transpose(1, 0, 2) for at in range(0, len(rows), batch)])
    new = np.concatenate([[True], (np.diff(whose) != 0) | (np.diff(starts) != STRIDE)])
    # a run of n windows is n + 1 halves; the first and the last are of one window alone
    run = np.cumsum(new) - 1
    at = np.arange(len(rows)) + run
    last = np.append(new[1:], True)
    halves = np.zeros((len(rows) + int(new.sum()), STRIDE, TAGS), np.float32)
    halves[at] += e[:, :STRIDE] * np.where(new[:, None, None], 1, RISING)
    halves[at + 1] += e[:, STRIDE:] * np.where(last[:, None, None], 1, 1 - RISING)
    firsts, sizes = at[new], np.bincount(run) + 1
    for n in np.unique(sizes):
        of = np.flatnonzero(sizes == n)
        for low in range(0, len(of), max(1, batch // int(n))):
            own = of[low : low + max(1, batch // int(n))]
            part = halves[firsts[own][:, None] + np.arange(n)].reshape(len(own), -1, TAGS)
            yield whose[new][own], starts[new][own], part.transpose(1, 0, 2)


def by_network(net: Network, texts: list[str]) -> list[list[Span]]:
    """Spans of whole texts, from one path through each lattice."""
    out: list[list[Span]] = [[] for _ in texts]
    for whose, starts, e in lattices(net, texts):
        tags = net.best(e).T
        for row in np.flatnonzero(tags.any(axis=1)):
            j, base, own = int(whose[row]), int(starts[row]), tags[row]
            # a span begins with its kind's first tag, or where another kind or none was before
            kind = np.where(own > 0, (own + 1) // 2, 0)
            edges = np.flatnonzero((kind[1:] != kind[:-1]) | (own[1:] % 2 == 1)) + 1
            edges = np.concatenate([[0], edges, [len(own)]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if kind[a] and _fits(text := texts[j][base + a : base + b], k := int(kind[a]) - 1):
                    lead = len(text) - len(text.lstrip())
                    out[j].append((base + a + lead, k, base + a + len(text.rstrip())))
    return out


def _fits(text: str, kind: int) -> bool:
    digits = sum("0" <= c <= "9" for c in text)
    if digits < LEAST[kind]:
        return False
    if kind == 0:
        return "@" in text[1:-1]
    if kind == 1:
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return digits <= 15 if kind == 3 else digits <= 19 and luhn(re.sub("[^0-9]", "", text))


def settle(base: list[Span], added: list[Span]) -> list[Span]:
    """All of ``base``, and of ``added``, longer first, what overlaps nothing taken before."""
    if not added:
        return base
    out, taken = list(base), np.zeros(max(e for _, _, e in base + added), bool)
    for s, _, e in base:
        taken[s:e] = True
    for s, k, e in sorted(set(added), key=lambda x: (x[0] - x[2], x)):
        if not taken[s:e].any():
            out.append((s, k, e))
            taken[s:e] = True
    return sorted(out)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_personal_data(docs: DataFrame, net: Network | None = None, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The counts and base_sha256 are of the spans by rule, ``spans`` has all, n_added the network's. Without ``net`` one is
    trained on at most ``sample`` windows of these texts, and made ones. Offsets count code
    points of the whole text. Null and empty texts have no spans. Equal texts have equal values; rows that repeat an id
    or have none are rows of their own; an empty table gives an empty result; other columns, whatever their names, are
    not read."""
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    net = net or trained(labelled(plain, sample))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                texts = part.column("text").to_pylist()
                base = [by_rule(t) if SIGN.search(t) else [] for t in texts]
                both = [settle(x, y) for x, y in zip(base, by_network(net, texts))]
                counts = [pa.array([sum(k == kind for _, k, _ in x) for x in base], pa.int64()) for kind in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *counts, pa.array([hashlib.sha256(written(x).encode()).hexdigest() for x in base]), pa.array([written(x) for x in both]), pa.array([len(y) - len(x) for x, y in zip(base, both)], pa.int64())],
                    ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"],
                )

    return plain.mapInArrow(run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint")
