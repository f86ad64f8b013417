"""Personal data: fixed patterns, and a character-level BiLSTM with CRF transitions that adds to them.

The tagger is trained in numpy on a bounded number of windows labelled with the spans that
the patterns find, some of them rewritten into forms that the patterns miss (numbers without
the plus sign, cards next to each other, spelled-out at signs). Texts are cut into
overlapping windows on a fixed grid. A span must hold a digit or an at sign, which may be
spelled out as [at] or (at); windows without any are skipped: they cannot give one. Spans that touch the rim of their window
are left to a window that holds them whole: the next one, or else a wide one around the run,
so that none shorter than ``LONGEST`` is lost by where it stands. Those of all windows of a text
are then reconciled: the best first, none that overlaps one taken or one of the patterns', and each only if it has its kind's form.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskengine.llm.frames import as_fraction, id_text, keyed, map_batches

KINDS = ("email", "ip", "card", "phone")
# Fixed values of the base patterns. The first part of an email is found run by run, and an ip
# only at the first of its digits: tried at every character, a run of n would cost n * n steps.
MAILBOX = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

WIDTH, STRIDE = 80, 40
LONGEST = 330  # characters of the longest address: 64, a spelled-out at sign with its spaces, 255, and some
HIDDEN = 16
SAMPLE_DOCS = 6000  # texts looked at for training windows, about; chosen by a hash of the id and text
SAMPLE_WINDOWS = 1200  # most training windows
EPOCHS = 6
SEED = 11
TAGS = 1 + 2 * len(KINDS)  # outside, then beginning and inside of each kind

ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789@._%+-() \n,;:/[]#*\"'"
CODES = len(ALPHABET) + 3  # a letter beyond ASCII, any other character, padding
PAD = CODES - 1
_code = np.full(128, CODES - 2, dtype=np.int64)
for _i, _c in enumerate(ALPHABET):
    _code[ord(_c)] = _i
    _code[ord(_c.upper())] = _i


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)


def _is_card(text: str) -> bool:
    d = _digits(text)
    return 13 <= len(d) <= 19 and luhn(d)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping emails: what is left of a run after the email before, then a domain."""
    done = 0
    for run in MAILBOX.finditer(text):
        start = max(done, run.start())
        if start < run.end() and (domain := DOMAIN.match(text, run.end())):
            done = domain.end()
            yield start, done


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind, then start; failing matches are dropped."""
    out: list[tuple[int, int, int]] = []
    if "@" in text:
        out += [(0, start, end) for start, end in _emails(text)]
    if "." in text:
        out += [(1, m.start(), m.end()) for m in IP.finditer(text) if _is_ip(m[0])]
    out += [(2, m.start(), m.end()) for m in CARD.finditer(text) if _is_card(m[0])]
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


MARK = r"[0-9@]|[\[(]at"  # what any span holds
# Forms of added spans: what the tagger proposes must look like its kind.
ADDED = (
    re.compile(r"[A-Za-z0-9._%+-]+(@|\s?\[at\]\s?|\s?\(at\)\s?)[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]{1,3}(\.[0-9]{1,3}){3}"),
    re.compile(r"[0-9]{4}([\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{1,7}|[0-9]{13,19}"),
    re.compile(r"(\+?[0-9]{1,3}[\x20.-])?(\([0-9]{3}\)[\x20.-]?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}"),
)


def has_form(kind: int, text: str, start: int, end: int) -> bool:
    body = text[start:end]
    if not ADDED[kind].fullmatch(body):
        return False
    # Not a piece of something longer.
    if start and (text[start - 1].isalnum() or text[start - 1] in "+._%-@"):
        return False
    if end < len(text) and (text[end].isalnum() or text[end] in "@_%"):
        return False
    if kind == 1:
        return _is_ip(body)
    if kind == 2:
        return _is_card(body)
    return kind != 3 or 9 <= len(_digits(body)) <= 15


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    return np.where(points < 128, _code[np.minimum(points, 127)], CODES - 3)


def window_starts(n: int) -> range:
    return range(0, max(1, n - WIDTH + STRIDE), STRIDE)


def _tags(spans: list[tuple[int, int, int]], start: int, width: int) -> np.ndarray:
    tags = np.zeros(width, dtype=np.int64)
    for kind, a, b in spans:
        low, high = max(0, a - start), min(width, b - start)
        if low < high:
            tags[low:high] = 2 + 2 * kind
            tags[low] = 1 + 2 * kind
    return tags


def rewritten(text: str, spans: list[tuple[int, int, int]], rng: np.random.Generator) -> tuple[str, list]:
    """A text whose spans take other forms, and the spans in it."""
    out, kept, at = [], [], 0
    size = 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < at:
            continue
        body, d = text[a:b], _digits(text[a:b])
        form = int(rng.integers(0, 4))
        if kind == 0 and form:
            body = body.replace("@", ("[at]", " [at] ", "(at)")[form - 1])
        elif kind == 2 and len(d) == 16 and form:
            body = ("-" if form == 1 else " ").join(d[i : i + 4] for i in range(0, 16, 4)) if form < 3 else d
        elif kind == 3 and len(d) >= 10 and form:
            e = d[-10:]
            body = (f"({e[:3]}) {e[3:6]}-{e[6:]}", f"{e[:3]}-{e[3:6]}-{e[6:]}", f"{e[:3]}.{e[3:6]}.{e[6:]}")[form - 1]
        out.append(text[at:a])
        size += a - at
        kept.append((kind, size, size + len(body)))
        out.append(body)
        size += len(body)
        if kind == 2 and rng.integers(0, 3) == 0:  # the same number once more, a space between
            out.append(" " + body)
            kept.append((kind, size + 1, size + 1 + len(body)))
            size += 1 + len(body)
        at = b
    out.append(text[at:])
    return "".join(out), kept


class Tagger:
    """Two LSTMs over character codes, one in each direction; their states give tag scores for the CRF."""

    def __init__(self, seed: int = SEED):
        r = np.random.default_rng(seed)

        def m(*shape: int) -> np.ndarray:
            return (r.standard_normal(shape) * 0.2).astype(np.float32)

        h = HIDDEN
        self.p = {"out": m(2 * h, TAGS), "bias": np.zeros(TAGS, np.float32), "trans": m(TAGS, TAGS)}
        for side in "fb":
            self.p["x" + side], self.p["u" + side] = m(CODES, 4 * h), m(h, 4 * h)
            self.p["x" + side][:, h : 2 * h] += 1.0  # remember at first

    def lstm(self, codes: np.ndarray, side: str, keep: bool = False):
        x, u = self.p["x" + side], self.p["u" + side]
        n, steps, h = len(codes), codes.shape[1], HIDDEN
        state, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        out, saved = np.empty((steps, n, h), np.float32), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = x[codes[:, t]] + state @ u
            gate = 1.0 / (1.0 + np.exp(-z[:, : 3 * h]))
            new = np.tanh(z[:, 3 * h :])
            before, old = cell, state
            cell = gate[:, h : 2 * h] * cell + gate[:, :h] * new
            squashed = np.tanh(cell)
            state = gate[:, 2 * h :] * squashed
            out[t] = state
            if keep:
                saved.append((t, gate, new, before, squashed, old))
        return out, saved

    def emissions(self, codes: np.ndarray, keep: bool = False):
        f, saved_f = self.lstm(codes, "f", keep)
        b, saved_b = self.lstm(codes, "b", keep)
        both = np.concatenate((f, b), axis=2)
        return both @ self.p["out"] + self.p["bias"], both, saved_f, saved_b

    def gradient(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tag paths and its gradient."""
        e, both, saved_f, saved_b = self.emissions(codes, True)
        steps, n, k = e.shape
        trans = self.p["trans"]
        lse = lambda a, axis: (m := a.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(
            np.exp(a - m).sum(axis=axis)
        )
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0]
        for t in range(1, steps):
            alpha[t] = lse(alpha[t - 1][:, :, None] + trans, 1) + e[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = lse(trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        log_z = lse(alpha[-1], 1)
        rows = np.arange(n)
        gold = e[0][rows, tags[:, 0]].copy()
        g = {name: np.zeros_like(a) for name, a in self.p.items()}
        for t in range(1, steps):
            a, b = tags[:, t - 1], tags[:, t]
            gold += trans[a, b] + e[t][rows, b]
            pair = np.exp(alpha[t - 1][:, :, None] + trans + (e[t] + beta[t])[:, None, :] - log_z[:, None, None])
            g["trans"] += pair.sum(axis=0)
            np.add.at(g["trans"], (a, b), -1.0)
        d = np.exp(alpha + beta - log_z[None, :, None])
        for t in range(steps):
            d[t][rows, tags[:, t]] -= 1.0
        g["bias"] = d.sum(axis=(0, 1))
        g["out"] = np.einsum("tnh,tnk->hk", both, d)
        back = d @ self.p["out"].T
        h = HIDDEN
        for side, saved, part in (("f", saved_f, back[:, :, :h]), ("b", saved_b, back[:, :, h:])):
            u = self.p["u" + side]
            d_state, d_cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
            for t, gate, new, before, squashed, old in reversed(saved):
                d_h = part[t] + d_state
                i, f, o = gate[:, :h], gate[:, h : 2 * h], gate[:, 2 * h :]
                d_c = d_cell + d_h * o * (1 - squashed**2)
                d_z = np.concatenate(
                    (d_c * new * i * (1 - i), d_c * before * f * (1 - f), d_h * squashed * o * (1 - o), d_c * i * (1 - new**2)),
                    axis=1,
                )
                np.add.at(g["x" + side], codes[:, t], d_z)
                g["u" + side] += old.T @ d_z
                d_state, d_cell = d_z @ u.T, d_c * f
        return float((log_z - gold).mean()), {name: a / n for name, a in g.items()}

    def fit(self, codes: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS, batch: int = 64, rate: float = 0.02) -> float:
        """Adam over shuffled batches; the last epoch's mean loss."""
        rng = np.random.default_rng(SEED)
        first = {n: np.zeros_like(a) for n, a in self.p.items()}
        second = {n: np.zeros_like(a) for n, a in self.p.items()}
        step, loss = 0, 0.0
        for _ in range(epochs):
            order, losses = rng.permutation(len(codes)), []
            for at in range(0, len(order), batch):
                pick = order[at : at + batch]
                one, g = self.gradient(codes[pick], tags[pick])
                losses.append(one)
                step += 1
                for name, a in g.items():
                    a = np.clip(a, -1.0, 1.0)
                    first[name] = 0.9 * first[name] + 0.1 * a
                    second[name] = 0.99 * second[name] + 0.01 * a * a
                    m, v = first[name] / (1 - 0.9**step), second[name] / (1 - 0.99**step)
                    self.p[name] -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
            loss = float(np.mean(losses))
        return loss

    def decode(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tag path of each window, and by how much each place's tag leads the next best."""
        e = self.emissions(codes)[0]
        steps, n, k = e.shape
        score, came = e[0], np.empty((steps, n, k), dtype=np.int8)
        for t in range(1, steps):
            both = score[:, :, None] + self.p["trans"]
            came[t] = both.argmax(axis=1)
            score = both.max(axis=1) + e[t]
        path = np.empty((n, steps), dtype=np.int64)
        path[:, -1] = score.argmax(axis=1)
        rows = np.arange(n)
        for t in range(steps - 1, 0, -1):
            path[:, t - 1] = came[t][rows, path[:, t]]
        top = np.sort(e, axis=2)
        own = e[np.arange(steps)[:, None], rows, path.T]
        lead = np.where(own >= top[:, :, -1], own - top[:, :, -2], own - top[:, :, -1])
        return path, lead.T


Span = tuple[float, int, int, int]  # score, kind, start, end


def tag_runs(path: np.ndarray, lead: np.ndarray, start: int, n: int) -> tuple[list[Span], list[Span]]:
    """The tag runs of a window that do not touch its rim inside the text, and those that do."""
    whole, cut, at = [], [], 0
    while at < len(path):
        if not path[at]:
            at += 1
            continue
        kind, end = (path[at] - 1) // 2, at + 1
        while end < len(path) and path[end] == 2 + 2 * kind:
            end += 1
        inside = (at > 0 or start == 0) and (end < len(path) or start + end >= n)
        if start + at < n and (not inside or start + end <= n):
            (whole if inside else cut).append((float(lead[at:end].mean()), int(kind), start + at, min(n, start + end)))
        at = end
    return whole, cut


def spans_of(path: np.ndarray, lead: np.ndarray, start: int, n: int) -> list[Span]:
    """(score, kind, start, end) of the tag runs of a window that do not touch its rim inside the text."""
    return tag_runs(path, lead, start, n)[0]


def wide_starts(whole: list[Span], cut: list[Span], base: list[tuple[int, int, int]], n: int) -> list[int]:
    """Where windows of twice ``LONGEST`` start, so that each shorter span with a cut run in it lies inside one.

    A run inside a whole one of its kind has been seen whole; one that meets a base span can give
    nothing. Only some neighbours are looked at for that: one overlooked costs windows, no span.
    """
    seen, taken = sorted((k, a, b) for _, k, a, b in whole), sorted((a, b) for _, a, b in base)
    starts: set[int] = set()
    for kind, a, b in sorted({s[1:] for s in cut}):
        i = bisect_right(seen, (kind, a, n))
        if any(k == kind and x <= a and b <= y for k, x, y in seen[max(0, i - 4) : i]):
            continue
        i = bisect_right(taken, (a, n))
        if any(x < b and a < y for x, y in taken[max(0, i - 4) : i + 1]):
            continue
        starts.update(x * LONGEST for x in range(max(0, a - LONGEST) // LONGEST, (b - 1) // LONGEST + 1))
    return sorted(starts)


def reconciled(
    text: str, base: list[tuple[int, int, int]], found: list[tuple[float, int, int, int]]
) -> list[tuple[int, int, int]]:
    """Added spans of a text: best score first, in form, apart from each other and from the base spans."""
    taken = [(a, b) for _, a, b in base]
    added = []
    for _, kind, a, b in sorted(set(found), key=lambda s: (-s[0], s[1:])):
        if has_form(kind, text, a, b) and all(b <= x or a >= y for x, y in taken):
            taken.append((a, b))
            added.append((kind, a, b))
    return added


def _marks(c: np.ndarray) -> np.ndarray:
    """Where a digit, an at sign or the bracket before a spelled-out one stands."""
    mark = (c >= 26) & (c <= 36)  # the digits and the at sign
    if len(c) > 3:
        bracket, a, t = c[:-3], c[1:-2], c[2:-1]
        opened = (bracket == ALPHABET.index("[")) | (bracket == ALPHABET.index("("))
        mark[:-3] |= opened & (a == ALPHABET.index("a")) & (t == ALPHABET.index("t"))
    return mark


def _window(c: np.ndarray, start: int, width: int) -> np.ndarray:
    w = np.full(width, PAD, dtype=np.int64)
    part = c[start : start + width]
    w[: len(part)] = part
    return w


def _grid(text: str) -> list[tuple[int, np.ndarray]]:
    """Windows of a text that hold a digit or an at sign, spelled out or not, padded to the full width."""
    c = codes(text)
    mark = np.concatenate(([0], np.cumsum(_marks(c))))
    out = []
    for s in window_starts(len(c)):
        e = min(len(c), s + WIDTH)
        if mark[e] > mark[s]:
            out.append((s, _window(c, s, WIDTH)))
    return out


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled windows: as they are, and with their spans rewritten."""
    for batch in batches:
        rows = []
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
            body = text.as_py().decode("utf-8", "replace")
            spans = base_spans(body)
            rng = np.random.default_rng(key & 0xFFFFFFFF)
            versions = [(body, spans)] + ([rewritten(body, spans, rng) for _ in range(3)] if spans else [])
            for i, (form, own) in enumerate(versions):
                for start, w in _grid(form):
                    tags = _tags(own, start, WIDTH)
                    if tags.any() or not i:
                        order = int.from_bytes(hashlib.blake2b(f"{key}:{i}:{start}".encode(), digest_size=7).digest(), "big")
                        rows.append((order, bool(tags.any()), w.astype(np.int8).tobytes(), tags.astype(np.int8).tobytes()))
        cols = list(zip(*rows)) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.bool_(), pa.binary(), pa.binary()))],
            ["order", "labelled", "codes", "tags"],
        )


def train(texts: DataFrame) -> Tagger | None:
    """A tagger fitted on at most ``SAMPLE_WINDOWS`` windows, or None where no span was found."""
    n = texts.count()
    chosen = texts.filter(as_fraction(F.xxhash64("key", F.lit(SEED))) <= F.lit(min(1.0, SAMPLE_DOCS / max(1, n))))
    chosen = chosen.filter(F.col("text").cast("string").rlike(MARK))
    rows = map_batches(chosen, _samples, "order bigint, labelled boolean, codes binary, tags binary")
    most = [(True, SAMPLE_WINDOWS * 3 // 4), (False, SAMPLE_WINDOWS // 4)]
    parts = [rows.filter(F.col("labelled") == x).orderBy("order").limit(k).toPandas() for x, k in most]
    if not len(parts[0]):
        return None
    sample = pd.concat(parts)
    stack = lambda c: np.stack([np.frombuffer(x, dtype=np.int8) for x in sample[c]]).astype(np.int64)
    tagger = Tagger()
    inputs, tags = stack("codes"), stack("tags")
    # Small samples are gone through more often.
    tagger.fit(inputs, tags, epochs=EPOCHS if len(sample) > 600 else 3 * EPOCHS)
    return tagger


DECODE = 512  # windows decoded together


def added_spans(texts: list[str], bases: list[list], tagger: Tagger | None) -> list[list[tuple[int, int, int]]]:
    found: list[list] = [[] for _ in texts]
    if tagger is None:
        return found
    cut: list[list] = [[] for _ in texts]

    def decoded(windows: list[tuple[int, int, np.ndarray]], together: int) -> None:
        for at in range(0, len(windows), together):
            part = windows[at : at + together]
            path, lead = tagger.decode(np.stack([w for *_, w in part]))
            for (i, s, w), p, d in zip(part, path, lead):
                if p.any():
                    whole, pieces = tag_runs(p, d, s, len(texts[i]))
                    found[i] += whole
                    cut[i] += pieces

    decoded([(i, s, w) for i, text in enumerate(texts) for s, w in _grid(text)], DECODE)
    wide = []
    for i, text in enumerate(texts):
        if cut[i] and (starts := wide_starts(found[i], cut[i], bases[i], len(text))):
            c = codes(text)
            wide += [(i, s, _window(c, s, 2 * LONGEST)) for s in starts]
    decoded(wide, DECODE * WIDTH // (2 * LONGEST))
    return [reconciled(text, base, spans) for text, base, spans in zip(texts, bases, found)]


def _said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _find(tagger):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py().decode("utf-8", "replace") for t in batch.column("text")]
            bases = [base_spans(t) for t in texts]
            extra = added_spans(texts, bases, tagger.value)
            counts = [[sum(k == kind for k, *_ in b) for b in bases] for kind in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array([hashlib.sha256(_said(b).encode()).hexdigest() for b in bases], pa.string()),
                    pa.array([_said([*b, *x]) for b, x in zip(bases, extra)], pa.string()),
                    pa.array([len(x) for x in extra], pa.int64()),
                ],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"],
            )

    return run


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) per input row.

    The counts and the digest are of the base spans; ``spans`` has those and the added ones
    as kind:start:end in code points, by kind, then start. Null and empty text have none.
    Repeated rows each give a row; other columns are not looked at. Without any base span to
    learn from, nothing is added.
    """
    texts = id_text(docs, id_col, text_col)
    tagger = train(keyed(docs, id_col, text_col).select("key", "text"))
    sent = docs.sparkSession.sparkContext.broadcast(tagger)
    schema = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"n_{k} bigint" for k in KINDS)
    return map_batches(texts, _find(sent), schema + ", base_sha256 string, spans string, n_added bigint")
