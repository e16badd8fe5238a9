"""Personal data: base patterns, and spans of a character-level bidirectional LSTM with CRF transitions."""

from __future__ import annotations

import functools
import hashlib
import random
import re
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm.common import ddl, map_texts

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]

#: The patterns of the base spans; fixed values.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: The same languages, found in linear time. A name is sought leftwards from each at sign, as no name holds one; an address's
#: first run of digits starts where no digit stands before; runs are never given back, as what follows them is no part of them.
_NAME = "".join(map(chr, range(48, 58))) + "".join(chr(c + d) for c in (65, 97) for d in range(26)) + "._%+-"
_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
#: Characters of the longest card: 19 digits with a mark between each two.
_CARD_MOST = 37


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub("[^0-9]+", "", s)


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _emails(text: str) -> list[tuple[int, int]]:
    out, upto, at = [], 0, text.find("@")
    while at >= 0:
        if m := _HOST.match(text, at):
            start = upto + len(text[upto:at].rstrip(_NAME))
            if start < at:
                out.append((start, m.end()))
                upto = m.end()
        upto, at = max(upto, at), text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) by start, then kind as listed; leftmost non-overlapping of each kind, failing ones dropped. Linear in the text."""
    out = [(a, 0, b) for a, b in _emails(text)]
    if re.search("[0-9]", text):
        for m in _IP.finditer(text):
            if all(map(_octet, m.group().split("."))):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() <= _CARD_MOST and 12 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(_digits(m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return [(a, b, KINDS[k]) for a, k, b in sorted(out)]


def joined(spans: Sequence[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


# --- labelled spans -------------------------------------------------------------------------------------------------

#: Windows of labelled text that the model is trained on: the bound on its sample.
TRAINING_WINDOWS = 6_000


def _word(rng: random.Random) -> str:
    syllables = ("th", "er", "an", "in", "ou", "re", "st", "en", "at", "on", "es", "ed", "or", "ti", "le", "de", "ch", "ei", "ó", "ñ", "é", "ä", "ü", "ion", "que", "ment")
    return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))


def _hex(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789abcdef") for _ in range(n))


def _ascii(rng: random.Random) -> str:
    return "".join(c for c in _word(rng) if c.isascii()) or "ann"


def _card(rng: random.Random, good: bool) -> str:
    d = [str(rng.randint(0, 9)) for _ in range(15)]
    d[0] = rng.choice("3456")
    last = next(x for x in "0123456789" if luhn("".join(d) + x) == good)
    return "".join(d) + last


def _personal(rng: random.Random) -> tuple[str, str]:
    """A labelled finding: its kind, and its text in one of the ways it is written."""
    kind = rng.choice(KINDS)
    if kind == "email":
        user = rng.choice((_ascii(rng), f"{_ascii(rng)}.{_ascii(rng)}", f"{_ascii(rng)}.{rng.randint(1, 99)}", f"{_ascii(rng)}_{rng.randint(1, 99)}"))
        host = f"{_ascii(rng)}{rng.choice(('', str(rng.randint(1, 9))))}"
        top = rng.choice(("com", "org", "net", "example.com", "example.org", "co.uk", "de"))
        return kind, rng.choice((f"{user}@{host}.{top}",) * 3 + (f"{user} @ {host}.{top}", f"{user}(at){host}.{top}", f"{user} [at] {host}.{top}"))
    if kind == "ip":
        parts = [str(rng.randint(0, 255)) for _ in range(4)]
        return kind, rng.choice((".".join(parts),) * 3 + (" . ".join(parts), "[.]".join(parts)))
    if kind == "card":
        d = _card(rng, True)
        return kind, rng.choice((d, " ".join(d[i : i + 4] for i in range(0, 16, 4)), "-".join(d[i : i + 4] for i in range(0, 16, 4)), ".".join(d[i : i + 4] for i in range(0, 16, 4))))
    area, first, last, country = rng.randint(200, 999), rng.randint(200, 999), rng.randint(1000, 9999), rng.randint(1, 49)
    return kind, rng.choice((f"+{country} ({area}) {first}-{last}", f"+{country} {area} {first} {last}", f"({area}) {first}-{last}", f"{area}-{first}-{last}", f"0{area}/{first}{last}"))


def _plain(rng: random.Random) -> str:
    """Text with digits or signs that is no personal data."""
    n = rng.randint
    return rng.choice((
        lambda: str(n(0, 99_999)), lambda: str(n(1900, 2100)), lambda: f"{n(0, 99)}.{n(0, 99)}", lambda: f"{n(0, 9)}.{n(0, 9)}.", lambda: f"{n(0, 9)}.{n(0, 9)}.{n(0, 9)}",
        lambda: f"{n(1, 28):02d}.{n(1, 12):02d}.{n(1900, 2100)}", lambda: f"{n(1900, 2100)}-{n(1, 12):02d}-{n(1, 28):02d}", lambda: f"{n(0, 23):02d}:{n(0, 59):02d}",
        lambda: f'token = "{_hex(rng, 40)}"', lambda: f"password={_hex(rng, 20)}", lambda: "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16)),
        lambda: f"@{_ascii(rng)}", lambda: f"{_word(rng)}@", lambda: f"{n(1, 999)}%", lambda: f"${n(1, 9999)}.{n(0, 99):02d}", lambda: f"[{n(1, 99)}]", lambda: f"({n(1, 99)})",
        lambda: f"{n(1, 20)}, {n(1, 20)}, {n(1, 20)}", lambda: f"v{n(0, 9)}.{n(0, 20)}.{n(0, 20)}", lambda: _hex(rng, 32), lambda: str(n(10**9, 10**11)), lambda: f"{n(1, 99)}-{n(1, 99)}",
    ))()


def labelled_windows(n: int = TRAINING_WINDOWS, length: int = 80, seed: int = 17) -> list[tuple[str, list[Span]]]:
    """Texts of `length` characters with their spans, by public formats of the four kinds and of what resembles them."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        text, spans = "", []
        while len(text) < length:
            pick = rng.random()
            if pick < 0.16:
                kind, shown = _personal(rng)
                if len(text) + len(shown) < length:
                    spans.append((len(text), len(text) + len(shown), kind))
                    text += shown
            elif pick < 0.32:
                text += _plain(rng)
            else:
                word = _word(rng)
                text += rng.choice((word, word, word, word.capitalize(), word.upper()))
            text += rng.choice((" ", " ", " ", " ", ", ", ". ", "\n", " | "))
        text = text[:length]
        out.append((text, [s for s in spans if s[1] <= length]))
    return out


# --- the model ------------------------------------------------------------------------------------------------------

HIDDEN, LABELS = 20, 1 + 2 * len(KINDS)
#: Character classes: printable ASCII one each, any other letter, any other character.
CLASSES = 98
_TABLE = np.full(0x110000, 97, np.uint8)
_TABLE[32:127] = np.arange(95)
_TABLE[10] = 0
#: Windows start every STRIDE characters, so each span of up to WINDOW - STRIDE - 1 characters (the trained ones have at most
#: about 68) lies within one, clear of its edges.
WINDOW, STRIDE = 80, 10
#: Posterior of each of a span's characters, on average, from which it is taken.
MIN_POSTERIOR = 0.9
#: Every span has one of these characters; windows without one are not decoded, as their spans would not be kept.
TRIGGER = re.compile(r"[0-9@]|[\[(]at[\])]")


#: Labels that may not follow: an inside label after anything but its own kind's labels. A window may start inside a span.
_NEVER = -1e4
_FOLLOWS = np.array([[_NEVER if b and b % 2 == 0 and a not in (b, b - 1) else 0.0 for b in range(LABELS)] for a in range(LABELS)])


def encode(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    out = _TABLE[np.minimum(codes, 0x10FFFF)].astype(np.int64)
    high = np.flatnonzero(codes >= 128)
    out[high] = [95 if text[i].isalpha() else 96 for i in high]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Tagger:
    """BIO labels by two LSTMs over character classes and a linear-chain CRF; parameters are plain arrays."""

    def __init__(self, seed: int = 3, kind: type = np.float32):
        self.kind, r = kind, np.random.default_rng(seed)
        g = lambda *s: r.normal(0, 1 / np.sqrt(s[0]), s)
        self.p = {}
        for d in "fb":
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN : 2 * HIDDEN] = 1.0
            self.p |= {f"x{d}": r.normal(0, 0.3, (CLASSES, 4 * HIDDEN)), f"h{d}": g(HIDDEN, 4 * HIDDEN), f"c{d}": bias}
        self.p |= {"o": g(2 * HIDDEN, LABELS), "ob": np.zeros(LABELS), "t": np.zeros((LABELS, LABELS)), "s": np.zeros(LABELS)}
        self.p = {k: v.astype(np.float64 if k in "ts" else kind) for k, v in self.p.items()}

    def _lstm(self, x: np.ndarray, d: str):
        """States (T, B, H) of one direction, with what the way back needs; x (T, B)."""
        n, b = x.shape
        gates = (self.p[f"x{d}"] + self.p[f"c{d}"])[x]
        into, cells, tanh, out = self.p[f"h{d}"], *np.zeros((3, n + 1, b, HIDDEN), self.kind)
        h = c = np.zeros((b, HIDDEN), self.kind)
        for t in range(n) if d == "f" else range(n - 1, -1, -1):
            a = gates[t]
            a += h @ into
            a[:, : 3 * HIDDEN] = _sigmoid(a[:, : 3 * HIDDEN])
            np.tanh(a[:, 3 * HIDDEN :], out=a[:, 3 * HIDDEN :])
            c = a[:, HIDDEN : 2 * HIDDEN] * c + a[:, :HIDDEN] * a[:, 3 * HIDDEN :]
            cells[t], tanh[t] = c, np.tanh(c)
            h = out[t] = a[:, 2 * HIDDEN : 3 * HIDDEN] * tanh[t]
        return out[:n], (gates, cells, tanh, out)

    def emissions(self, x: np.ndarray):
        hf, kf = self._lstm(x, "f")
        hb, kb = self._lstm(x, "b")
        h = np.concatenate([hf, hb], axis=2)
        return h @ self.p["o"] + self.p["ob"], h, kf, kb

    @property
    def steps(self) -> np.ndarray:
        return self.p["t"] + _FOLLOWS

    def _both_ways(self, e: np.ndarray):
        """Forward and backward sums of the chain as shares of each step's total, the factors between, and log Z of each column."""
        top = e.max(axis=2, keepdims=True)
        own, moves = np.exp(e - top).astype(np.float64), np.exp(self.steps)
        a, b, log_z = np.empty_like(own), np.ones_like(own), top.sum(axis=(0, 2), dtype=np.float64)
        for t in range(len(e)):
            a[t] = own[t] * (a[t - 1] @ moves if t else np.exp(self.p["s"]))
            total = a[t].sum(axis=1, keepdims=True)
            a[t] /= total
            log_z += np.log(total[:, 0])
        for t in range(len(e) - 2, -1, -1):
            b[t] = (own[t + 1] * b[t + 1]) @ moves.T
            b[t] /= b[t].sum(axis=1, keepdims=True)
        return a, b, own, log_z

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of labels y (T, B) and its gradients."""
        e, h, kf, kb = self.emissions(x)
        a, b, own, log_z = self._both_ways(e)
        n, size = x.shape
        marginal = a * b
        marginal /= marginal.sum(axis=2, keepdims=True)
        at = np.arange(n)[:, None], np.arange(size)[None, :], y
        gold = e[at].sum(0) + self.p["s"][y[0]] + self.steps[y[:-1], y[1:]].sum(0)
        loss = float((log_z - gold).mean())
        de = marginal
        de[at] -= 1
        de /= size
        moves, after = np.exp(self.steps), own[1:] * b[1:]
        total = ((a[:-1] @ moves) * after).sum(axis=2, keepdims=True)
        pair = moves * ((a[:-1] / total).reshape(-1, LABELS).T @ after.reshape(-1, LABELS))
        np.subtract.at(pair, (y[:-1].ravel(), y[1:].ravel()), 1)
        low = de.astype(self.kind)
        out = {"t": pair / size, "s": de[0].sum(0), "o": h.reshape(-1, 2 * HIDDEN).T @ low.reshape(-1, LABELS), "ob": de.sum(axis=(0, 1))}
        dh = low @ self.p["o"].T
        flat = x.ravel()
        order = np.argsort(flat, kind="stable")
        classes, first = np.unique(flat[order], return_index=True)
        for d, kept, part in (("f", kf, dh[:, :, :HIDDEN]), ("b", kb, dh[:, :, HIDDEN:])):
            gates, cells, tanh, states = kept
            step = 1 if d == "f" else -1
            da, back = np.empty_like(gates), self.p[f"h{d}"].T
            nh, nc = np.zeros((2, size, HIDDEN), self.kind)
            for t in range(n - 1, -1, -1) if d == "f" else range(n):
                i, f, o, g = (gates[t][:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
                up = part[t] + nh
                dc = nc + up * o * (1 - tanh[t] ** 2)
                before = cells[t - step]  # the extra last row is zero, for either way's first step
                da[t] = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), up * tanh[t] * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                nh, nc = da[t] @ back, dc * f
            prior = np.roll(states, 1, axis=0)[:n] if d == "f" else states[1:]
            gx, each = np.zeros_like(self.p[f"x{d}"]), da.reshape(-1, 4 * HIDDEN)
            gx[classes] = np.add.reduceat(each[order], first, axis=0)
            out |= {f"x{d}": gx, f"h{d}": prior.reshape(-1, HIDDEN).T @ each, f"c{d}": each.sum(0)}
        return loss, out

    def train(self, windows: list[tuple[str, list[Span]]], epochs: int = 5, batch: int = 50, rate: float = 0.02, seed: int = 4) -> list[float]:
        """Adam over whole windows of equal length; returns the mean loss of each epoch."""
        x = np.stack([encode(t) for t, _ in windows], axis=1)
        y = np.zeros_like(x)
        for k, (_, spans) in enumerate(windows):
            for a, b, kind in spans:
                y[a:b, k] = 2 + 2 * KINDS.index(kind)
                y[a, k] -= 1
        r, m, v, step, losses = np.random.default_rng(seed), {}, {}, 0, []
        steps = epochs * (x.shape[1] // batch)
        for _ in range(epochs):
            order, total = r.permutation(x.shape[1]), []
            for at in range(0, x.shape[1] - batch + 1, batch):
                own = order[at : at + batch]
                loss, grads = self.gradients(x[:, own], y[:, own])
                total.append(loss)
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                step += 1
                now = rate * (1 - step / (steps + 1))
                for name, g in grads.items():
                    g = g * min(1.0, 5.0 / (norm + 1e-12))
                    m[name] = 0.9 * m.get(name, 0) + 0.1 * g
                    v[name] = 0.99 * v.get(name, 0) + 0.01 * g * g
                    change = now * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.99**step)) + 1e-8)
                    self.p[name] = (self.p[name] - change).astype(self.p[name].dtype)
            losses.append(float(np.mean(total)))
        return losses

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best labels by Viterbi and each character's posterior of its label; x (T, B)."""
        e = self.emissions(x)[0]
        a, b, _, _ = self._both_ways(e)
        best, back, steps = e[0] + self.p["s"], np.zeros(e.shape, np.int64), self.steps.T.copy()
        for t in range(1, len(e)):
            m = best[:, None, :] + steps
            back[t] = m.argmax(axis=2)
            best = e[t] + m.max(axis=2)
        rows, y = np.arange(e.shape[1]), np.zeros(e.shape[:2], np.int64)
        y[-1] = best.argmax(axis=1)
        for t in range(len(e) - 1, 0, -1):
            y[t - 1] = back[t][rows, y[t]]
        sure = a * b
        return y, (sure / sure.sum(axis=2, keepdims=True))[np.arange(len(e))[:, None], rows[None, :], y]


@functools.lru_cache(maxsize=2)
def trained(n: int = TRAINING_WINDOWS, epochs: int = 5) -> Tagger:
    """The tagger, trained on labelled_windows; the same parameters on every call and machine-independent in its inputs."""
    tagger = Tagger()
    tagger.train(labelled_windows(n), epochs=epochs)
    return tagger


# --- windows over whole texts ---------------------------------------------------------------------------------------


def windows(text: str) -> list[int]:
    """Starts of those windows that hold a trigger, of all that start every STRIDE characters from the text's start on."""
    out: list[int] = []
    upto = -1  # the last start
    for m in TRIGGER.finditer(text):
        first = max(0, (m.end() - WINDOW + STRIDE - 1) // STRIDE * STRIDE)
        for at in range(max(first, upto + STRIDE if out else 0), m.start() + 1, STRIDE):
            out.append(at)
            upto = at
    return out


def reconcile(found: list[tuple[int, int, str, float]]) -> list[Span]:
    """Of overlapping spans from all windows of a text, the non-overlapping ones of greatest total weight."""
    order = sorted(set(found), key=lambda s: (s[1], s[0], s[2]))
    ends = [s[1] for s in order]
    best: list[tuple[float, tuple]] = [(0.0, ())]
    for k, (a, b, kind, w) in enumerate(order):
        j = int(np.searchsorted(ends[:k], a, "right"))
        with_it = best[j][0] + w * (b - a)
        best.append((with_it, (best[j][1], (a, b, kind))) if with_it > best[k][0] else best[k])
    out, node = [], best[-1][1]
    while node:
        node, span = node
        out.append(span)
    return out[::-1]


def plausible(shown: str, kind: str) -> bool:
    """What a span of its kind must have at least, whatever the model says."""
    n = len(_digits(shown))
    if kind == "email":
        return len(shown) >= 6 and "." in shown and bool(re.search(r"@|[\[(]at[\])]", shown))
    if kind == "ip":
        return len(re.findall("[0-9]+", shown)) == 4 and all(map(_octet, re.findall("[0-9]+", shown)))
    if kind == "card":
        return 13 <= n <= 19 and luhn(_digits(shown))
    return 9 <= n <= 15 and bool(re.fullmatch(r"[+0-9 ()./-]+", shown))


def model_spans(texts: Sequence[str], tagger: Tagger, batch: int = 256) -> list[list[Span]]:
    """Spans of each text by the model alone, reconciled over the text's windows."""
    jobs = [(k, at) for k, text in enumerate(texts) for at in windows(text)]
    found: list[list[tuple[int, int, str, float]]] = [[] for _ in texts]
    for lo in range(0, len(jobs), batch):
        part = jobs[lo : lo + batch]
        x = np.stack([encode(texts[k][at : at + WINDOW].ljust(WINDOW)) for k, at in part], axis=1)
        y, sure = tagger.decode(x)
        for c, (k, at) in enumerate(part):
            labels, t = y[:, c], 0
            while t < WINDOW:
                if labels[t] and labels[t] % 2:
                    end = t + 1
                    while end < WINDOW and labels[end] == labels[t] + 1:
                        end += 1
                    a, b, weight, kind = at + t, at + end, float(sure[t:end, c].mean()), KINDS[(labels[t] - 1) // 2]
                    cut = (t == 0 and at > 0) or (end == WINDOW and b < len(texts[k]))
                    if b <= len(texts[k]) and weight >= MIN_POSTERIOR and not cut and TRIGGER.search(texts[k], a, b) and plausible(texts[k][a:b], kind):
                        found[k].append((a, b, kind, round(weight, 6)))
                    t = end
                else:
                    t += 1
    return [reconcile(f) if f else [] for f in found]


def find(texts: Sequence[str | None], tagger: Tagger) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text; a model span is added where it touches no base span."""
    whole = [t or "" for t in texts]
    out = []
    for text, base, more in zip(whole, map(base_spans, whole), model_spans(whole, tagger)):
        added = [s for s in more if all(s[1] <= b[0] or b[1] <= s[0] for b in base)]
        out.append((base, sorted([*base, *added], key=lambda s: (s[0], KINDS.index(s[2])))))
    return out


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of each row.

    The counts and the digest are of the base spans; spans has those and the model's. Null and empty texts have none.
    Repeated rows stay; other columns are not looked at; texts are searched whole, in overlapping windows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(trained().p)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        tagger = Tagger()
        tagger.p = sent.value

        def step(ids, texts):
            rows = find(texts, tagger)
            counts = [[sum(s[2] == k for s in base) for base, _ in rows] for k in KINDS]
            digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in rows]
            return [ids, *counts, digests, [joined(whole) for _, whole in rows], [len(whole) - len(base) for base, whole in rows]]

        return step

    return map_texts(docs, ["doc_id", "text"], f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long", make)


def masked(text: str, spans: Sequence[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the kind of its first."""
    out, at = [], 0
    for a, b, kind in sorted(spans):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame) -> DataFrame:
    """The same rows and columns with personal data masked in text; n_chars, where there is one, is counted anew.

    Null texts stay null and empty ones empty; repeated rows stay; other columns are handed on whatever their names; an
    empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(trained().p)
    columns = docs.columns
    at = columns.index("text")
    counted = columns.index("n_chars") if "n_chars" in columns else None

    def make():
        tagger = Tagger()
        tagger.p = sent.value

        def step(*values):
            values = list(values)
            values[at] = [None if t is None else masked(t, whole) for t, (_, whole) in zip(values[at], find(values[at], tagger))]
            if counted is not None:
                values[counted] = [n if t is None else len(t) for n, t in zip(values[counted], values[at])]
            return values

        return step

    return map_texts(docs, columns, ddl(docs), make)
