"""Personal data in texts: rules for what has a fixed form, and a character-level BiLSTM with CRF transitions for other spellings.

*Rules.* E-mail addresses, IP addresses, payment cards and phone numbers, leftmost and without overlap per kind. Their spans always stay.

*Labels.* The spans that the rules find are the labelled spans. At most ``PER_KIND`` windows of each kind, and as many without any,
are drawn by hash from all documents (a documented bound; it does not grow with the corpus). Each is learnt as it is and in
other spellings of the same data (``respelled``): other separators, no plus, "(at)" for the sign; numbers that are nobody's (dates,
prices, versions, keys) are put where spans were and count as nothing.

*Model.* Embedded characters go through one LSTM from each side; a linear layer scores the tags (outside, begin and inside of each kind),
a conditional random field adds transitions. Trained in numpy by Adam on the exact likelihood.

*Decoding.* The whole text is cut into windows of ``WIDTH`` characters that overlap by half, each is decoded by Viterbi
and scored by its marginals. Spans that an inner edge cuts give way to the neighbour's whole ones, and spans that are impossible for their
kind go (card numbers pass Luhn, parts of an IP address are at most 255, an address has an at sign or the word "at", and a dot); of all that is left in
a text, the compatible set of the highest total is kept (weighted interval scheduling). A span is added if it does not touch a rule's span and
its score reaches ``SURE``. Windows that lack what every possible span holds (``could_hold``) are not decoded: whatever was found there
would be impossible, so the result is that of decoding all windows.

Only the drawn windows and the model (a few thousand numbers) pass the driver; texts stay in their tasks.

Defined results: null text is empty and has no span; a null id is carried along; repeated rows are answered each; without a labelled span there is
no model and the rules stand alone; long texts are read whole, in time proportional to their length; ties between equally good sets go
to the earlier span; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
PER_KIND = 240
WIDTH = 96
STEP = WIDTH // 2
CONTEXT = 24
SURE = 0.8
EMBED, HIDDEN, STEPS, BATCH, RATE = 12, 20, 300, 64, 0.03
SEED = 17
BATCH_WINDOWS = 512

# -- rules

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match begins where a run of digits does, so the rest of a run need not be tried (possessive, with a look behind).
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")
_NUMBER = re.compile(r"[0-9]+")
_EVIDENCE = re.compile(r"[0-9@]")
_MARK = re.compile(r"[0-9@]|at(?!\w)")
_WORD = re.compile(r"\w")


def _emails(text: str):
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from the at signs."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if k % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def _possible_ip(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _possible_card(span: str) -> bool:
    digits = _NOT_DIGITS.sub("", span)
    return 14 <= len(digits) <= 19 and luhn(digits)


def _possible_phone(span: str) -> bool:
    return 10 <= len(_NOT_DIGITS.sub("", span)) <= 15


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all that the rules find, by start, then kind."""
    if not _EVIDENCE.search(text):
        return []
    found = [(s, 0, e) for s, e in _emails(text)]
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_possible_ip, m[0].split(".")))]
    found += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if _possible_card(m[0])]
    found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if _possible_phone(m[0])]
    return sorted(found)


# -- labelled windows

def _alphabet() -> np.ndarray:
    """Symbol of every code point below 0x250; later ones are told apart by what they are."""
    table = np.zeros(0x250, np.int64)
    for point in range(0x250):
        table[point] = point - 31 if 32 <= point < 127 else 97 if chr(point).isalpha() else 98 if chr(point).isspace() else 99
    return table


_SYMBOL = _alphabet()
SYMBOLS = 100  # 0 is beyond the text


def symbols(text: str, width: int) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")[:width]
    out = np.zeros(width, np.int64)
    out[: len(points)] = np.where(points < 0x250, _SYMBOL[np.minimum(points, 0x24F)], 97)
    return out


def tags_of(spans, length: int, width: int) -> np.ndarray:
    tags = np.zeros(width, np.int64)
    for start, kind, end in spans:
        tags[start] = 1 + 2 * kind
        tags[start + 1: end] = 2 + 2 * kind
    return tags


def respelled(span: str, kind: int, rng: random.Random) -> str:
    """Another spelling of the same data."""
    if kind == 0:
        name, _, host = span.partition("@")
        at = rng.choice(["(at)", "[at]", " at ", " (at) ", "@ ", " @ "])
        dot = rng.choice([".", ".", " dot ", "(dot)"]) if at.strip() != "@" else "."
        return name + at + host.replace(".", dot)
    if kind == 1:
        return rng.choice([" . ", "[.]", ". ", "(.)"]).join(span.split("."))
    digits = _NOT_DIGITS.sub("", span)
    if kind == 2:
        return rng.choice([".", "/", "_", "  "]).join(digits[k: k + 4] for k in range(0, len(digits), 4))
    area, first, rest = digits[-10:-7], digits[-7:-4], digits[-4:]
    country = digits[:-10]
    return rng.choice([f"({area}) {first}-{rest}", f"{area}-{first}-{rest}", f"{area}.{first}.{rest}", f"{area} {first} {rest}",
                       f"00{country} {area} {first} {rest}", f"{country}-{area}-{first}-{rest}", f"({area}) {first} {rest}"])


def nobody_s(rng: random.Random) -> str:
    """A number that is nobody's."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    return rng.choice([
        f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", f"{rng.randint(0, 23):02d}:{d(2)}:{d(2)}",
        f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1900, 2030)}", f"{d(1)},{d(3)},{d(3)}", f"${d(2)}.{d(2)}", f"v{d(1)}.{d(2)}.{d(1)}", d(rng.randint(1, 9)),
        "".join(rng.choice("0123456789abcdef") for _ in range(40)), f"AKIA{d(4)}QZXW{d(8)}", f"{d(3)}/{d(4)}", f"{d(4)} {d(4)} {d(2)}", f"#{d(5)}", f"{d(12)}",
        f"@{rng.choice(['home', 'the', 'all', 'user'])}{d(2)}", f"{d(4)}{rng.choice('ABCDEF')}{d(4)}"])


def variants(text: str, spans, rng: random.Random):
    """The window, another spelling of each span, and nobody's numbers in their places."""
    yield text, spans
    if not spans:
        cut = rng.randrange(len(text) + 1)
        yield f"{text[:cut]} {nobody_s(rng)} {text[cut:]}", []
        return
    for change, keeps in ((respelled, True), (lambda *_: nobody_s(rng), False)):
        out, kept, at, pieces = 0, [], 0, []
        for start, kind, end in spans:
            if start < at:
                continue
            pieces.append(text[at:start])
            out += start - at
            new = change(text[start:end], kind, rng)
            if keeps:
                kept.append((out, kind, out + len(new)))
            pieces.append(new)
            out, at = out + len(new), end
        pieces.append(text[at:])
        yield "".join(pieces), kept


def _labelled(batches):
    """One window per document and kind (4: without a span), around a span, or digit, that the document's hash picks."""
    for batch in batches:
        rows = []
        for h, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            if not text or not _EVIDENCE.search(text):
                continue
            spans = rule_spans(text)
            rng = random.Random(h)
            for kind in range(len(KINDS) + 1):
                if kind < len(KINDS):
                    places = [s for s in spans if s[1] == kind and s[2] - s[0] <= WIDTH // 2]
                else:
                    places = [(p, kind, p + 1) for p in (m.start() for m in _EVIDENCE.finditer(text))
                              if not any(s[0] <= p + CONTEXT and p - CONTEXT < s[2] for s in spans)] if len(spans) < 50 else []
                if not places:
                    continue
                start, _, end = rng.choice(places)
                left = max(0, start - rng.randrange(CONTEXT, WIDTH - (end - start) - CONTEXT + 1))
                right = min(len(text), left + WIDTH)
                if any(s < left < e or s < right < e for s, _, e in spans):
                    left, right = max(0, start - CONTEXT), min(len(text), end + CONTEXT)
                inside = [(s - left, k, e - left) for s, k, e in spans if left <= s and e <= right]
                cut = [(s, e) for s, _, e in spans if (s < left < e) or (s < right < e)]
                if cut or any(a[2] > b[0] for a, b in zip(inside, inside[1:])):
                    continue  # half a span teaches nothing
                rows.append((kind, h, text[left:right], [x for s in inside for x in s]))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string()),
                                          pa.array([r[3] for r in rows], pa.list_(pa.int32()))], names=["kind", "h", "window", "spans"])


def labelled_windows(docs: DataFrame, per_kind: int = PER_KIND) -> DataFrame:
    """kind, h, window, spans (start, kind, end in turn): at most ``per_kind`` windows a kind, those of the smallest hashes."""
    slim = docs.filter("text is not null").select(F.xxhash64("doc_id", F.lit(SEED)).alias("h"), F.col("text").cast("string").alias("text"))
    windows = slim.mapInArrow(_labelled, "kind int, h long, window string, spans array<int>")
    # The limit is applied before the exchange as well, so what travels is bounded by tasks x per_kind rows a kind.
    rank = F.row_number().over(Window.partitionBy("kind").orderBy("h", "window"))
    return windows.withColumn("_r", rank).filter(F.col("_r") <= per_kind).drop("_r")


# -- the model

def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def _allowed() -> np.ndarray:
    """0 where a tag may follow another, else a large penalty: inside only after begin or inside of its kind."""
    bar = np.zeros((TAGS, TAGS))
    for kind in range(len(KINDS)):
        inside = 2 + 2 * kind
        bar[:, inside] = -1e4
        bar[[inside - 1, inside], inside] = 0
    return bar


_BAR = _allowed()
_FIRST = np.where((np.arange(TAGS) > 0) & (np.arange(TAGS) % 2 == 0), -1e4, 0.0)


def fresh(seed: int = SEED) -> dict[str, np.ndarray]:
    """``cell`` and ``cell0`` hold both directions; their columns are the input, forget and output gates and the new values."""
    rng = np.random.default_rng(seed)
    size = EMBED + HIDDEN
    return {
        "embed": rng.normal(0, 0.3, (SYMBOLS, EMBED)), "out": rng.normal(0, 0.2, (2 * HIDDEN, TAGS)), "bias": np.zeros(TAGS), "step": np.zeros((TAGS, TAGS)),
        "cell": rng.normal(0, 1 / np.sqrt(size), (2, size, 4 * HIDDEN)),
        "cell0": np.tile(np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)], (2, 1, 1)),
    }


def _both_ways(x: np.ndarray) -> np.ndarray:
    """(time, rows, ..) -> (time, 2, rows, ..): as it is, and with time turned round."""
    return np.stack([x, x[::-1]], axis=1)


def _lstm(model, x: np.ndarray):
    """Both directions over x (time, 2, rows, EMBED): hidden states, cells, and activated gates."""
    n_time, _, rows, _ = x.shape
    gates = np.matmul(x, model["cell"][:, :EMBED]) + model["cell0"]
    h = c = np.zeros((2, rows, HIDDEN), x.dtype)
    hs, cs = np.empty((n_time, 2, rows, HIDDEN), x.dtype), np.empty((n_time, 2, rows, HIDDEN), x.dtype)
    back = np.ascontiguousarray(model["cell"][:, EMBED:])
    for t in range(n_time):
        z = gates[t]
        z += np.matmul(h, back)
        z[..., : 3 * HIDDEN] = _sigmoid(z[..., : 3 * HIDDEN])
        z[..., 3 * HIDDEN:] = np.tanh(z[..., 3 * HIDDEN:])
        c = z[..., HIDDEN: 2 * HIDDEN] * c + z[..., :HIDDEN] * z[..., 3 * HIDDEN:]
        h = z[..., 2 * HIDDEN: 3 * HIDDEN] * np.tanh(c)
        hs[t], cs[t] = h, c
    return hs, cs, gates


def emissions(model, codes: np.ndarray):
    """Tag scores (time, rows, TAGS) of windows given as rows of symbols, and what training needs of the way there."""
    x = _both_ways(model["embed"][codes.T])
    hs, cs, gates = _lstm(model, x)
    both = np.concatenate([hs[:, 0], hs[::-1, 1]], axis=2)
    return (both @ model["out"] + model["bias"]).astype(np.float64), (x, both, hs, cs, gates)


def _passes(model, scores, sizes):
    """Scaled forward and backward sums of the field; rows end after ``sizes`` characters.

    Returns ahead, back (their product is the chance of a tag), the scaled scores, the scales, the exponential of the transitions and log Z.
    """
    n_time, rows, _ = scores.shape
    step = np.exp(model["step"].astype(np.float64) + _BAR)
    top = scores.max(axis=2, keepdims=True)
    weight = np.exp(scores - top)
    ahead, back, scale = np.empty_like(scores), np.ones_like(scores), np.ones((n_time, rows, 1))
    for t in range(n_time):
        a = weight[0] * np.exp(_FIRST) if t == 0 else (ahead[t - 1] @ step) * weight[t]
        scale[t] = a.sum(axis=1, keepdims=True)
        ahead[t] = a / scale[t]
    for t in reversed(range(n_time - 1)):
        b = ((weight[t + 1] * back[t + 1]) @ step.T) / scale[t + 1]
        back[t] = np.where((t + 1 < sizes)[:, None], b, 1)
    inside = np.arange(n_time)[:, None] < sizes
    z = ((np.log(scale) + top)[:, :, 0] * inside).sum(axis=0)
    return ahead, back, weight, scale, step, z


def _backward(model, grad_h, x, hs, cs, gates, grads):
    """Gradients of the cells, and of x, from those of the hidden states (time, 2, rows, HIDDEN)."""
    n_time, _, rows, _ = x.shape
    back = np.ascontiguousarray(model["cell"][:, EMBED:].transpose(0, 2, 1))
    i, f, o, new = (gates[..., k * HIDDEN: (k + 1) * HIDDEN] for k in range(4))
    dz = np.empty_like(gates)
    dh = dc = np.zeros((2, rows, HIDDEN), x.dtype)
    for t in reversed(range(n_time)):
        dh = dh + grad_h[t]
        tc = np.tanh(cs[t])
        dc = dc + dh * o[t] * (1 - tc * tc)
        old = cs[t - 1] if t else 0.0
        z = dz[t]
        z[..., :HIDDEN] = dc * new[t] * i[t] * (1 - i[t])
        z[..., HIDDEN: 2 * HIDDEN] = dc * old * f[t] * (1 - f[t])
        z[..., 2 * HIDDEN: 3 * HIDDEN] = dh * tc * o[t] * (1 - o[t])
        z[..., 3 * HIDDEN:] = dc * i[t] * (1 - new[t] * new[t])
        dh = np.matmul(z, back)
        dc = dc * f[t]
    flat = lambda a: a.transpose(1, 0, 2, 3).reshape(2, -1, a.shape[-1])
    d = flat(dz)
    grads["cell"] = np.concatenate([flat(x).transpose(0, 2, 1) @ d, flat(np.concatenate([np.zeros_like(hs[:1]), hs[:-1]])).transpose(0, 2, 1) @ d], axis=1)
    grads["cell0"] = d.sum(axis=1, keepdims=True)
    return np.matmul(dz, model["cell"][:, :EMBED].transpose(0, 2, 1))


def gradients(model, codes, tags, sizes):
    """Negative log likelihood per row and its gradients."""
    scores, (x, both, hs, cs, gates) = emissions(model, codes)
    n_time, rows, _ = scores.shape
    ahead, back, weight, scale, step, z = _passes(model, scores, sizes)
    inside = (np.arange(n_time)[:, None] < sizes)[:, :, None]
    gold = np.zeros_like(scores)
    np.put_along_axis(gold, tags.T[:, :, None], 1.0, axis=2)
    gold *= inside
    d_scores = (ahead * back * inside - gold) / rows
    pairs = gold[:-1].reshape(-1, TAGS).T @ gold[1:].reshape(-1, TAGS)  # a row's tags end with it, so no pair reaches over its end
    likely = step * (ahead[:-1].reshape(-1, TAGS).T @ (weight * back / scale * inside)[1:].reshape(-1, TAGS))
    truth = (scores * gold).sum() + (model["step"] * pairs).sum()
    grads = {"step": (likely - pairs) / rows, "out": both.reshape(-1, 2 * HIDDEN).T @ d_scores.reshape(-1, TAGS), "bias": d_scores.sum(axis=(0, 1))}
    d_both = (d_scores @ model["out"].T).astype(x.dtype)
    dx = _backward(model, np.stack([d_both[:, :, :HIDDEN], d_both[::-1, :, HIDDEN:]], axis=1), x, hs, cs, gates, grads)
    grads["embed"] = np.zeros(model["embed"].shape)
    np.add.at(grads["embed"], codes.T, dx[:, 0] + dx[::-1, 1])
    return (z.sum() - truth) / rows, grads


def train(examples, seed: int = SEED, steps: int = STEPS, rate: float = RATE):
    """A model from (text, spans) examples, by ``steps`` of Adam on shuffled batches; None without a labelled span."""
    if not any(spans for _, spans in examples):
        return None
    rng = np.random.default_rng(seed)
    width = max(len(t) for t, _ in examples)
    codes = np.stack([symbols(t, width) for t, _ in examples])
    tags = np.stack([tags_of(s, len(t), width) for t, s in examples])
    sizes = np.array([len(t) for t, _ in examples])
    model = {k: v.astype(np.float32) for k, v in fresh(seed).items()}
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    order = np.zeros(0, np.int64)
    for count in range(1, steps + 1):
        if len(order) < BATCH:
            order = np.r_[order, rng.permutation(len(examples))]
        rows, order = order[:BATCH], order[BATCH:]
        longest = sizes[rows].max()
        _, grads = gradients(model, codes[rows, :longest], tags[rows, :longest], sizes[rows])
        norm = np.sqrt(sum((g * g).sum() for g in grads.values()))
        for k, g in grads.items():
            g = g * min(1.0, 5.0 / (norm + 1e-12))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            change = (first[k] / (1 - 0.9 ** count)) / (np.sqrt(second[k] / (1 - 0.99 ** count)) + 1e-8)
            model[k] = (model[k] - rate * (1 - 0.9 * count / steps) * change).astype(np.float32)
    return model


def fit(docs: DataFrame, per_kind: int = PER_KIND, seed: int = SEED):
    """The model learnt from at most five times ``per_kind`` labelled windows of ``docs``; None if no rule finds anything."""
    rows = sorted(labelled_windows(docs, per_kind).collect(), key=lambda r: (r["kind"], r["h"], r["window"]))
    rng = random.Random(seed)
    examples = []
    for r in rows:
        flat = r["spans"]
        examples += variants(r["window"], [tuple(flat[k: k + 3]) for k in range(0, len(flat), 3)], rng)
    return train([e for e in examples if e[0]], seed)


# -- decoding

def decode(model, windows: list[str]) -> list[list[tuple[int, int, int, float]]]:
    """Per window the spans (start, kind, end, score) of its best tagging; the score is the mean marginal of its tags."""
    sizes = np.array([len(w) for w in windows])
    width = int(sizes.max())
    scores, _ = emissions(model, np.stack([symbols(w, width) for w in windows]))
    ahead, back, *_ = _passes(model, scores, sizes)
    step = model["step"] + _BAR
    rows = np.arange(len(windows))
    best, came = scores[0] + _FIRST, np.zeros(scores.shape, np.int8)
    for t in range(1, width):
        options = best[:, :, None] + step
        came[t] = options.argmax(axis=1)
        best = np.where((t < sizes)[:, None], options.max(axis=1) + scores[t], best)
    path = np.zeros((len(windows), width), np.int64)
    tag = best.argmax(axis=1)
    for t in reversed(range(width)):
        live = t < sizes
        path[live, t] = tag[live]
        if t:
            tag = np.where(live, came[t][rows, tag], tag)
    chance = ahead * back
    out = []
    for r in range(len(windows)):
        spans = []
        begins = np.flatnonzero(path[r] % 2 == 1).tolist()
        for start in begins:
            kind, end = (int(path[r, start]) - 1) // 2, start + 1
            while end < sizes[r] and path[r, end] == 2 + 2 * kind:
                end += 1
            spans.append((start, kind, end, float(chance[np.arange(start, end), r, path[r, start:end]].mean())))
        out.append(spans)
    return out


def signs(text: str) -> list[tuple[int, int]]:
    """At signs and words "at"; every possible e-mail address holds one."""
    return [m.span() for m in _MARK.finditer(text) if m[0] == "@" or m[0] == "at" and not (m.start() and _WORD.match(text[m.start() - 1]))]


def windows_of(text: str) -> list[tuple[int, int, bool, bool]]:
    """(start, end, whether its left edge cuts the text, whether its right edge does)."""
    return [_window(text, k) for k in range(_last_window(text) + 1)]


def _last_window(text: str) -> int:
    return max(0, -(-(len(text) - WIDTH) // STEP))


def _window(text: str, k: int) -> tuple[int, int, bool, bool]:
    start, end = k * STEP, min(len(text), k * STEP + WIDTH)
    return start, end, start > 0, end < len(text)


def could_hold(window: str, sign: bool) -> bool:
    """Whether any part of a window can be possible; ``sign``: it holds an at sign or a word "at"."""
    if sign and ("." in window or "dot" in window):
        return True
    numbers = _NUMBER.findall(window)  # an IP address has four, a phone number ten digits, a card more
    return len(numbers) >= 4 or sum(map(len, numbers)) >= 10


def promising_windows(text: str) -> list[tuple[int, int, bool, bool]]:
    """Those of ``windows_of`` that can hold a possible span; the others are only passed over by the search for marks."""
    last, marked = _last_window(text), {}
    for m in _MARK.finditer(text):
        start, end = m.span()
        if m[0] == "at" and start and _WORD.match(text[start - 1]):
            continue
        sign = m[0] == "@" or m[0] == "at"
        for k in range(max(0, -(-(end - WIDTH) // STEP)), min(last, start // STEP) + 1):
            marked[k] = marked.get(k, False) or sign
    places = [(_window(text, k), sign) for k, sign in sorted(marked.items())]
    return [p for p, sign in places if could_hold(text[p[0]:p[1]], sign)]


def reconciled(spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """The compatible set with the largest sum of score x length."""
    best: dict[tuple[int, int, int], float] = {}
    for start, kind, end, score in spans:
        best[start, kind, end] = max(score, best.get((start, kind, end), 0.0))
    order = sorted(best, key=lambda s: (s[2], s[0], s[1]))
    ends = [s[2] for s in order]
    total, taken = [0.0], []
    for k, (start, kind, end) in enumerate(order):
        j = bisect.bisect_right(ends, start, 0, k)
        gain = total[j] + best[start, kind, end] * (end - start)
        taken.append((gain > total[k], j))
        total.append(max(gain, total[k]))
    out, k = [], len(order)
    while k:
        use, j = taken[k - 1]
        if use:
            out.append((*order[k - 1], best[order[k - 1]]))
        k = j if use else k - 1
    return out[::-1]


def possible(span: str, kind: int) -> bool:
    """Whether the characters of a proposed span can be of its kind."""
    if kind == 0:
        return bool(re.search(r"@|\bat\b", span)) and len(span) >= 6 and bool(re.search(r"\.|\bdot\b", span))
    if kind == 1:
        parts = _NUMBER.findall(span)
        return len(parts) == 4 and all(map(_possible_ip, parts))
    return _possible_card(span) if kind == 2 else _possible_phone(span)


def _holds(places, start: int, end: int) -> bool:
    """Whether one of the sorted, disjoint places lies within a span."""
    k = bisect.bisect_left(places, (start, 0))
    return k < len(places) and places[k][1] <= end


def model_spans(model, texts: list[str], windows=promising_windows) -> list[list[tuple[int, int, int, float]]]:
    """What the model alone finds in each text and is possible there, reconciled over all windows."""
    places = [windows(t) for t in texts]
    unique = sorted({t[a:b] for t, p in zip(texts, places) for a, b, _, _ in p}, key=lambda w: (len(w), w))
    known = {}
    for at in range(0, len(unique), BATCH_WINDOWS):
        block = unique[at: at + BATCH_WINDOWS]
        known.update(zip(block, decode(model, block)))
    out = []
    for text, read in zip(texts, places):
        found, at = [], signs(text) if read else []
        for a, b, cut_left, cut_right in read:
            for start, kind, end, score in known[text[a:b]]:
                whole = not (cut_left and start == 0) and not (cut_right and end == b - a)
                if whole and possible(text[a + start: a + end], kind) and (kind or _holds(at, a + start, a + end)):
                    found.append((a + start, kind, a + end, score))
        out.append(reconciled(found))
    return out


def added_spans(base, proposed, text: str, sure: float = SURE):
    """Proposed spans that are sure and possible and touch no span of the rules."""
    taken = sorted((s, e) for s, _, e in base)
    reach = np.maximum.accumulate([e for _, e in taken]).tolist() if taken else []
    out = []
    for start, kind, end, score in proposed:
        k = bisect.bisect_left(taken, (end,))
        if score >= sure and not (k and reach[k - 1] > start) and possible(text[start:end], kind):
            out.append((start, kind, end, score))
    return out


SPANS = "array<struct<kind: string, start: int, `end`: int, base: boolean, score: double>>"


def find(docs: DataFrame, model, sure: float = SURE) -> DataFrame:
    """doc_id, text (null as empty) and ``spans`` (kind, start, end, base, score) by start, then kind."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())]))

    def run(batches):
        known = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            base = [rule_spans(t) for t in texts]
            told = range(len(texts)) if known is not None else []
            more = dict(zip(told, model_spans(known, [texts[k] for k in told])))
            out = []
            for k, text in enumerate(texts):
                spans = [(s, kd, e, True, 1.0) for s, kd, e in base[k]]
                spans += [(s, kd, e, False, p) for s, kd, e, p in added_spans(base[k], more.get(k, ()), text, sure)]
                out.append([{"kind": KINDS[kd], "start": s, "end": e, "base": b, "score": p} for s, kd, e, b, p in sorted(spans)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind)], names=["doc_id", "text", "spans"])

    return slim.mapInArrow(run, f"doc_id long, text string, spans {SPANS}")


def masked(docs: DataFrame, model=None, sure: float = SURE) -> DataFrame:
    """doc_id, text with every span replaced by its kind in angle brackets; of overlapping spans the first names the whole."""
    found = find(docs, fit(docs) if model is None else model, sure)

    def run(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                at, pieces, open_end = 0, [], -1
                for s in spans:
                    if s["start"] >= open_end:
                        pieces += [text[at:s["start"]], f"<{s['kind']}>"]
                    open_end = max(open_end, s["end"])
                    at = open_end
                out.append("".join(pieces) + text[at:])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    return found.mapInArrow(run, "doc_id long, text string")


def _listed(spans) -> str:
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)


def personal_report(docs: DataFrame, per_kind: int = PER_KIND, sure: float = SURE) -> DataFrame:
    """Per document: counts of the rules' spans, the digest of their list, and the list of all spans."""
    found = find(docs, fit(docs.select("doc_id", "text"), per_kind), sure).select("doc_id", "spans")

    def run(batches):
        for batch in batches:
            counts, digests, lists = [[] for _ in KINDS], [], []
            for spans in batch.column(1).to_pylist():
                base = [s for s in spans if s["base"]]
                for name, out in zip(KINDS, counts):
                    out.append(sum(s["kind"] == name for s in base))
                digests.append(hashlib.sha256(_listed(base).encode()).hexdigest())
                lists.append(_listed(spans))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(lists, pa.string())],
                                             names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return found.mapInArrow(run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")
