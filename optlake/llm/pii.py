"""Personal data: rule spans plus a character BiLSTM-CRF.

*Base spans* of a whole text come from fixed patterns and tests (Luhn, digit
counts, address parts); they always stay.

*Added spans* come from a character-level bidirectional LSTM with CRF
transitions, trained in numpy on labelled spans: a bounded sample of documents,
labelled by the base rules, with half of the labelled pieces disguised (other
separators, no plus sign, " at " and " dot ") so that the model learns what the
rules cannot see.  A text is covered by overlapping windows of ``SPAN``
characters that start every ``STRIDE``; each is decoded by Viterbi.  The
windows' candidate spans are reconciled over the whole text: pieces of one kind
that overlap are united, then a weighted-interval schedule picks the
best-scoring set that overlaps neither itself nor a base span.

A span counts only if it holds an anchor, a digit, ``@`` or a spelled address
("at host dot org"); each kind needs one.  A window's result depends on its own characters only, so windows
without an anchor are not decoded: their result is known to be empty.

Scanning is a map over the corpus; the model is a few kilobytes.  Defined
results: null and empty texts have no spans; long texts are windowed whole, and
the rules take time in proportion to their length; repeated rows give repeated
results; an empty table gives no rows and no model; other columns are ignored.
The training sample is ordered by a hash of id and text, so it does not depend on
partitioning even where ids repeat or are null.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from optlake.llm.common import Scratch, map_columns

KINDS = ("email", "ip", "card", "phone")
# The base patterns of the contract, in parts that are read once from left to right.  An address is
# found from its "@", whose name is the run of name characters before it; four parts of an ip are taken at a time
# from a chain of numbers and dots; cards and phones read on to the end of their run in any case.
_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]")
_SPELLED = re.compile(r"(?<=[A-Za-z0-9._%+-]) at [A-Za-z0-9-]+(\.[A-Za-z0-9-]+)* dot [A-Za-z0-9-]", re.I)
#: Every text with a base span fits one of these (Spark's and Python's reading of it is the same).
_MAY_HOLD = r"@[A-Za-z0-9-]+\.|[0-9]\.[0-9]+\.[0-9]+\.[0-9]|([0-9][ -]?){15}[0-9]|\+[0-9]"

#: Labelled windows a sample has, or else all documents are searched for them.
LEAST_LABELLED = 300
#: Characters of a window, and between window starts.
SPAN, STRIDE = 96, 48
#: Documents of the training sample, windows of the training set, and of a training step.
SAMPLE_DOCS, TRAIN_WINDOWS, BATCH = 4000, 1200, 64
#: Embedding and state sizes, training steps, learning rate.
EMBED, HIDDEN, STEPS, RATE = 12, 16, 160, 0.02
#: Mean margin per character a span must reach.
MIN_MARGIN = 1.0
#: Windows decoded at once.
DECODE_BATCH = 1024


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def email_spans(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses that do not overlap.  A name holds no "@", so each is looked at from its "@" to both sides."""
    out, free = [], 0  # free: where the last address ended
    at = text.find("@")
    while at >= 0:
        a = at
        while a > free and text[a - 1] in _NAME:
            a -= 1
        domain = DOMAIN.match(text, at + 1) if a < at else None
        if domain:
            out.append((a, domain.end()))
            free = domain.end()
        at = text.find("@", at + 1)
    return out


def ip_spans(text: str) -> list[tuple[int, int]]:
    """Leftmost groups of four numbers joined by dots, parts at most 255: every four parts of a chain, what is left is none."""
    out = []
    for m in CHAIN.finditer(text):
        if m[0].count(".") < 3:
            continue
        parts, a = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            b = a + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in four):
                out.append((a, b))
            a = b + 1
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed rules, by kind then start; the time is linear in the text."""
    out = [(0, a, b) for a, b in email_spans(text)]
    if not re.search("[0-9]", text):
        return out
    out += [(1, a, b) for a, b in ip_spans(text)]
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 37:  # 19 digits and as many separators
            d = re.sub("[^0-9]", "", m[0])
            if 16 <= len(d) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return out


# ---------------------------------------------------------------- characters

_SYMBOLS = " \n@.+-()%_:/=\"',;#*"
_CLASSES = 2 + len(_SYMBOLS) + 10 + 26  # padding, any other, symbols, digits, letters


def _class_table() -> np.ndarray:
    t = np.ones(128, dtype=np.int16)
    for i, c in enumerate(_SYMBOLS):
        t[ord(c)] = 2 + i
    for i in range(10):
        t[48 + i] = 2 + len(_SYMBOLS) + i
    for i in range(26):
        t[97 + i] = t[65 + i] = 12 + len(_SYMBOLS) + i
    return t


_TABLE = _class_table()


def classes(text: str) -> np.ndarray:
    """Character classes of a text, one per code point."""
    code = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return _TABLE[np.where(code < 128, code, 127)]


def _spelled(text: str) -> list[int]:
    """Places of the spelled addresses' " at "."""
    return [m.start() for m in _SPELLED.finditer(text)] if " dot " in text.lower() else []


def window_starts(text: str, n: int) -> np.ndarray:
    """Starts of the windows that hold an anchor; every window of a text has one of the starts 0, STRIDE, ..."""
    at = np.array([m.start() for m in _ANCHOR.finditer(text)] + _spelled(text), dtype=np.int64)
    if not len(at):
        return at
    k = at // STRIDE
    last = max(0, -(-(n - SPAN) // STRIDE))  # the window that reaches the end
    near = np.concatenate([k - j for j in range(-(-SPAN // STRIDE))])
    return np.unique(np.clip(near, 0, last)) * STRIDE


# --------------------------------------------------------------------- model

TAGS = 1 + len(KINDS)  # outside, and one per kind


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Tagger:
    """Character BiLSTM with CRF transitions over [windows, SPAN] class arrays."""

    def __init__(self, seed: int = 7, params: dict | None = None):
        r = np.random.default_rng(seed)
        def init(*shape):
            return (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = params or {
            "emb": init(_CLASSES, EMBED) * 2, "wf": init(EMBED, 4 * HIDDEN), "uf": init(HIDDEN, 4 * HIDDEN),
            "bf": np.repeat(np.array([0, 1, 0, 0], np.float32), HIDDEN),
            "wb": init(EMBED, 4 * HIDDEN), "ub": init(HIDDEN, 4 * HIDDEN),
            "bb": np.repeat(np.array([0, 1, 0, 0], np.float32), HIDDEN),
            "wo": init(2 * HIDDEN, TAGS), "bo": np.zeros(TAGS, np.float32), "tr": np.zeros((TAGS, TAGS), np.float32)}

    def _lstm(self, x, w, u, b, keep=None):
        """x: [steps, rows] classes, in reading order; gates i, f, o, g."""
        steps, rows = x.shape
        drive = (self.p["emb"] @ w + b)[x]  # [steps, rows, 4 H]: one product per class, not per character
        h = np.zeros((rows, HIDDEN), np.float32)
        c = np.zeros_like(h)
        out = np.empty((steps, rows, HIDDEN), np.float32)
        for t in range(steps):
            z = drive[t] + h @ u
            s = _sigmoid(z[:, :3 * HIDDEN])
            g = np.tanh(z[:, 3 * HIDDEN:])
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:]
            before = c
            c = f * c + i * g
            tc = np.tanh(c)
            if keep is not None:
                keep.append((i, f, o, g, before, tc, h))
            h = o * tc
            out[t] = h
        return out

    def emissions(self, x, tape=None):
        """x: [rows, SPAN] -> [SPAN, rows, TAGS]."""
        p, xt = self.p, np.ascontiguousarray(x.T)
        kf, kb = ([], []) if tape is not None else (None, None)
        hf = self._lstm(xt, p["wf"], p["uf"], p["bf"], kf)
        hb = self._lstm(xt[::-1], p["wb"], p["ub"], p["bb"], kb)[::-1]
        h = np.concatenate([hf, hb], axis=2)
        if tape is not None:
            tape.update(xt=xt, kf=kf, kb=kb, h=h)
        return h @ p["wo"] + p["bo"]

    def decode(self, x):
        """Viterbi tags [rows, SPAN] and, per character, the margin of the emission of its tag over outside."""
        e = self.emissions(x)
        steps, rows, _ = e.shape
        score, back = e[0].copy(), np.empty((steps, rows, TAGS), np.int8)
        for t in range(1, steps):
            all_ = score[:, :, None] + self.p["tr"][None]
            back[t] = all_.argmax(1)
            score = all_.max(1) + e[t]
        tags = np.empty((steps, rows), np.int8)
        tags[-1] = score.argmax(1)
        row = np.arange(rows)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = back[t][row, tags[t]]
        margin = np.take_along_axis(e, tags[:, :, None].astype(np.int64), 2)[:, :, 0] - e[:, :, 0]
        return tags.T, margin.T

    def gradients(self, x, y):
        """Mean negative log-likelihood of tags y [rows, SPAN] and its gradients."""
        p, tape = self.p, {}
        e = self.emissions(x, tape).astype(np.float64)
        steps, rows, _ = e.shape
        tr = p["tr"].astype(np.float64)

        def lse(a, axis):
            m = a.max(axis, keepdims=True)
            return (m + np.log(np.exp(a - m).sum(axis, keepdims=True))).squeeze(axis)

        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0]
        for t in range(1, steps):
            alpha[t] = lse(alpha[t - 1][:, :, None] + tr[None], 1) + e[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = lse(tr[None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        z = lse(alpha[-1], 1)
        yt, row = y.T, np.arange(rows)
        gold = sum(e[t, row, yt[t]] for t in range(steps)) + sum(tr[yt[t - 1], yt[t]] for t in range(1, steps))
        de = np.exp(alpha + beta - z[None, :, None])
        dtr = np.zeros_like(tr)
        for t in range(1, steps):
            pair = alpha[t - 1][:, :, None] + tr[None] + (e[t] + beta[t])[:, None, :] - z[:, None, None]
            dtr += np.exp(pair).sum(0)
            np.subtract.at(dtr, (yt[t - 1], yt[t]), 1)
        np.subtract.at(de, (np.arange(steps)[:, None], row[None], yt), 1)
        de = (de / rows).astype(np.float32)
        g = {"tr": (dtr / rows).astype(np.float32), "wo": np.einsum("trh,tro->ho", tape["h"], de), "bo": de.sum((0, 1))}
        dh = de @ p["wo"].T
        demb = np.zeros_like(p["emb"])
        for side, keep, xt, d in (("f", tape["kf"], tape["xt"], dh[:, :, :HIDDEN]),
                                  ("b", tape["kb"], tape["xt"][::-1], dh[::-1, :, HIDDEN:])):
            w, u = p["w" + side], p["u" + side]
            dw, du, db = np.zeros_like(w), np.zeros_like(u), np.zeros_like(p["b" + side])
            dnext, dc = np.zeros((rows, HIDDEN), np.float32), np.zeros((rows, HIDDEN), np.float32)
            for t in range(steps - 1, -1, -1):
                i, f, o, gg, before, tc, h0 = keep[t]
                dht = d[t] + dnext
                dc = dc + dht * o * (1 - tc * tc)
                dz = np.concatenate([dc * gg * i * (1 - i), dc * before * f * (1 - f), dht * tc * o * (1 - o),
                                     dc * i * (1 - gg * gg)], axis=1)
                xe = p["emb"][xt[t]]
                dw += xe.T @ dz
                du += h0.T @ dz
                db += dz.sum(0)
                np.add.at(demb, xt[t], dz @ w.T)
                dnext, dc = dz @ u.T, dc * f
            g |= {"w" + side: dw, "u" + side: du, "b" + side: db}
        g["emb"] = demb
        return float((z - gold).mean()), g

    def train(self, x, y, steps: int = STEPS, seed: int = 11) -> "Tagger":
        """Adam steps over random batches; deterministic."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(a) for k, a in self.p.items()}
        for t in range(1, steps + 1):
            pick = r.integers(0, len(x), min(BATCH, len(x)))
            _, g = self.gradients(x[pick], y[pick])
            norm = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
            for k, a in g.items():
                a = a * min(1.0, 5.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * a
                v[k] = 0.99 * v[k] + 0.01 * a * a
                rate = RATE * (1 - 0.9 * t / steps)
                self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-6)).astype(np.float32)
        return self


# ------------------------------------------------------------ training windows

def disguise(kind: int, piece: str, r: np.random.Generator) -> str:
    """A labelled piece as the rules would miss it."""
    if kind == 0:
        return [piece.replace("@", " at ").replace(".", " dot "), piece.replace("@", "@ "), piece.split("@")[0] + "@" + "mail"][r.integers(3)] \
            if r.random() < 0.8 else piece.replace("@", " @ ")
    if kind == 1:
        return piece.replace(".", [" . ", "-", ","][r.integers(3)])
    if kind == 2:
        d = re.sub("[^0-9]", "", piece)
        return [".", "/", "  "][r.integers(3)].join(d[i:i + 4] for i in range(0, len(d), 4))
    d = re.sub("[^0-9]", "", piece)
    return [f"({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}", f"{d[-10:-7]}-{d[-7:-4]}-{d[-4:]}", f"{d[-10:-7]}.{d[-7:-4]}.{d[-4:]}"][r.integers(3)]


def training_windows(text: str, seed: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """(window text, spans) around the labelled spans and other anchors of a text: a few per text."""
    r = np.random.default_rng(seed)
    spans = base_spans(text)
    out = []
    for kind, a, b in spans[:4]:
        left = int(r.integers(5, SPAN // 2))
        piece = text[a:b] if r.random() < 0.5 else disguise(kind, text[a:b], r)
        before = text[max(0, a - left):a]
        if any(x < a and y > a - left for _, x, y in spans):
            before = re.sub("[0-9@]", "n", before)
        after = re.sub("[0-9@]", "n", text[b:b + SPAN])
        out.append(((before + piece + after)[:SPAN], [(kind, len(before), min(SPAN, len(before) + len(piece)))]))
    free = [m.start() for m in _ANCHOR.finditer(text) if not any(a - 1 <= m.start() <= b for _, a, b in spans)]
    for at in ([free[int(r.integers(len(free)))]] if free else []) + ([int(r.integers(len(text)))] if text else []):
        a = max(0, at - int(r.integers(5, SPAN - 5)))
        cut = [(k, max(0, x - a), min(SPAN, y - a)) for k, x, y in spans if x < a + SPAN and y > a]
        out.append((text[a:a + SPAN], cut))
    return out


def _arrays(windows) -> tuple[np.ndarray, np.ndarray]:
    x, y = np.zeros((len(windows), SPAN), np.int16), np.zeros((len(windows), SPAN), np.int64)
    for i, (text, spans) in enumerate(windows):
        c = classes(text)
        x[i, :len(c)] = c
        for kind, a, b in spans:
            y[i, a:b] = 1 + kind
    return x, y


def train_tagger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Tagger | None:
    """Tagger trained on a bounded sample of documents; None if no document has a base span.

    The sample is every document whose hash is under SAMPLE_DOCS / count, so
    about SAMPLE_DOCS of them; the windows with the smallest hashes are kept.
    If few of those hold a base span, labelled windows of all documents (the
    smallest hashes again) join them, so the tagger does not fade as the corpus
    grows or its personal data gets rarer.
    """
    total = docs.count()
    if not total:
        return None
    share = min(1.0, SAMPLE_DOCS / total)
    sample = docs.where(F.col(text_col).rlike("[0-9@]")).where(
        F.pmod(F.xxhash64(F.lit("pii"), F.col(id_col)), F.lit(1 << 40)) < int(share * (1 << 40)) + 1)

    def start():
        def step(ids, texts):
            got = [training_windows(t or "", (i or 0) & 0xFFFFFFFF) for i, t in zip(ids, texts)]
            return [ids, [xxhash.xxh3_64_intdigest((t or "").encode()) >> 1 for t in texts], [[w for w, _ in g] for g in got],
                    [[[v for s in spans for v in s] for _, spans in g] for g in got]]

        return step

    def pick(frame: DataFrame, keep, most: int) -> list:
        return (map_columns(frame, [id_col, text_col], "id long, text_hash long, windows array<string>, spans array<array<int>>", start)
                .select("id", "text_hash", F.posexplode(F.arrays_zip("windows", "spans")).alias("k", "w")).where(keep)
                .orderBy(F.xxhash64("id", "k"), "id", "k", "text_hash").limit(most).collect())

    rows = pick(sample, F.lit(True), TRAIN_WINDOWS)
    if sum(bool(r.w.spans) for r in rows) < LEAST_LABELLED:
        labelled = pick(docs.where(F.col(text_col).rlike(_MAY_HOLD)), F.size("w.spans") > 0, LEAST_LABELLED)
        rows = [r for r in rows if not r.w.spans] + labelled
    if not any(r.w.spans for r in rows):
        return None
    windows = [(r.w.windows, [tuple(r.w.spans[i:i + 3]) for i in range(0, len(r.w.spans), 3)]) for r in rows]
    return Tagger().train(*_arrays(windows))


# ------------------------------------------------------------------- decoding

def _plausible(kind: int, piece: str) -> bool:
    """Least content of an added span of a kind."""
    digits = sum("0" <= c <= "9" for c in piece)
    if kind == 0:
        return ("@" in piece[1:-1] or bool(_spelled(piece))) and sum(c.isalpha() for c in piece) >= 4
    if kind == 1:
        return 4 <= digits <= 12 and len(re.findall("[0-9]+", piece)) == 4 and all(int(p) <= 255 for p in re.findall("[0-9]+", piece))
    if kind == 2:
        return 16 <= digits <= 19 and luhn(re.sub("[^0-9]", "", piece))
    return 8 <= digits <= 15 and len(re.findall("[0-9]+", piece)) >= 3


_HOST = re.compile(r" at [A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?: dot [A-Za-z0-9-]+)+", re.I)


def _name_start(text: str, end: int) -> int:
    """Where a spelled name that ends at ``end`` starts: runs of name characters joined by " dot ", of any length."""
    a = end
    while True:
        while a and text[a - 1] in _NAME and text[a - 1] != ".":
            a -= 1
        if a < end and a > 5 and text[a - 5:a].lower() == " dot " and text[a - 6] in _NAME:
            a = end = a - 5
            continue
        while a and text[a - 1] in _NAME:  # the first run may hold dots
            a -= 1
        return a


def spelled_spans(text: str) -> list[tuple[int, int, int, float]]:
    """Candidates of spelled addresses, "name at host dot org".

    The tagger has seen few without a digit, so they do not depend on it; what it tags around them is united with them.
    """
    out = []
    for at in _spelled(text):
        a, b = _name_start(text, at), _HOST.match(text, at).end()
        out.append((0, a, b, 2 * MIN_MARGIN * (b - a)))
    return out


def reconcile(found: list[tuple[int, int, int, float]], text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Global choice among the windows' candidates (kind, start, end, margin sum)."""
    united: list[list] = []
    for kind, a, b, s in sorted(found):
        if united and united[-1][0] == kind and a < united[-1][2]:
            last = united[-1]
            last[2], last[3] = max(last[2], b), max(last[3], s)
        else:
            united.append([kind, a, b, s])
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    reach = list(itertools.accumulate((b for _, b in taken), max))  # furthest end so far

    def free(a, b):
        k = bisect.bisect_left(starts, b)
        return not k or reach[k - 1] <= a

    options = []
    for kind, a, b, s in united:
        while a < b and not (text[a].isalnum() or text[a] in "(+"):
            a += 1
        while b > a and not (text[b - 1].isalnum()):
            b -= 1
        if b > a and s >= MIN_MARGIN * (b - a) and _plausible(kind, text[a:b]) and free(a, b):
            options.append((b, a, kind, s))
    options.sort()  # weighted-interval schedule by end
    ends = [o[0] for o in options]
    best: list[float] = [0.0]
    choice = []
    for i, (b, a, _, s) in enumerate(options):
        j = bisect.bisect_right(ends, a, 0, i)
        take = best[j] + s
        choice.append((take > best[i], j))
        best.append(max(take, best[i]))
    out, i = [], len(options)
    while i:
        use, j = choice[i - 1]
        if use:
            b, a, kind, _ = options[i - 1]
            out.append((kind, a, b))
            i = j
        else:
            i -= 1
    return out


def find_spans(texts: list, tagger: Tagger | None) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text, by kind then start."""
    base = [base_spans(t or "") for t in texts]
    found: list[list] = [[] for _ in texts]
    queue: list[tuple[int, int, np.ndarray]] = []

    def flush():
        x = np.zeros((len(queue), SPAN), np.int16)
        for r, (_, _, c) in enumerate(queue):
            x[r, :len(c)] = c
        tags, margin = tagger.decode(x)
        for r in np.flatnonzero(tags.any(1)):
            i, at, c = queue[r]
            t, m = tags[r, :len(c)], margin[r]
            edges = np.flatnonzero(np.diff(np.concatenate(([0], t, [0]))))
            for a, b in zip(edges[:-1], edges[1:]):
                if t[a]:
                    found[i].append((int(t[a]) - 1, at + int(a), at + int(b), float(m[a:b].sum())))
        queue.clear()

    for i, t in enumerate(texts):
        found[i] += spelled_spans(t or "")
        if tagger is None or not t:
            continue
        starts = window_starts(t, len(t))
        if len(starts):
            c = classes(t)
            for at in starts.tolist():
                queue.append((i, at, c[at:at + SPAN]))
                if len(queue) >= DECODE_BATCH:
                    flush()
    if queue:
        flush()
    return [(b, sorted(b + reconcile(f, t or "", b))) for t, b, f in zip(texts, base, found)]


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame, tagger: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of every text: base and all, as arrays of (kind, start, end) and joined."""
    params = tagger.p if tagger else None

    def start():
        now = Tagger(params=params) if params else None

        def step(ids, texts):
            got = find_spans(texts, now)
            return [ids, *([sum(s[0] == k for s in b) for b, _ in got] for k in range(len(KINDS))),
                    [hashlib.sha256(_joined(b).encode()).hexdigest() for b, _ in got], [_joined(a) for _, a in got]]

        return step

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return map_columns(docs, [id_col, text_col], f"`{id_col}` long, {counts}, base_sha256 string, spans string", start)


def redact(docs: DataFrame, tagger: Tagger | None, text_col: str = "text") -> DataFrame:
    """The same rows and columns with every span replaced by its kind, as ``[EMAIL]``."""
    params = tagger.p if tagger else None
    others = [c for c in docs.columns if c != text_col]

    def start():
        now = Tagger(params=params) if params else None

        def step(*cols):
            texts = cols[-1]
            out = []
            for t, (_, spans) in zip(texts, find_spans(texts, now)):
                if spans:
                    parts, at = [], 0
                    for a, b, k in sorted((a, b, k) for k, a, b in spans):
                        if a >= at:
                            parts += [t[at:a], f"[{KINDS[k].upper()}]"]
                        elif b <= at:
                            continue
                        at = max(at, b)
                    t = "".join(parts) + t[at:]
                out.append(t)
            return [*cols[:-1], out]

        return step

    types = dict(docs.dtypes)
    fields = ", ".join(f"`{c}` {types[c]}" for c in [*others, text_col])
    return map_columns(docs, [*others, text_col], fields, start).select(*docs.columns)
