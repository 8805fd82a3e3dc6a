"""Personal data by candidate gradient boosting.

High-recall generators propose overlapping spans; boosted trees score each by format and context features; calibrated
thresholds by kind select the redactions. Four base patterns with fixed meaning always stay in the result.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store

# The base patterns and the order of kinds.
KINDS = ("email", "ip", "card", "phone", "iban", "key", "ssn")
BASE_KINDS = KINDS[:4]
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Generators of further candidates (kind, pattern); patterns overlap each other and the base ones.
GENERATORS = [(k, re.compile(p)) for k, p in (
    ("email", r"(?<![A-Za-z0-9._+-])[A-Za-z0-9._+-]{1,64}\s?(?:\[at\]|\(at\)| at )\s?[A-Za-z0-9-]{1,63}(?:\s?(?:\[dot\]|\(dot\)| dot |\.)\s?[A-Za-z]{2,24}){1,3}(?![A-Za-z])"),
    ("ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    ("card", r"(?<![0-9.])3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}(?![0-9.])"),
    ("phone", r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9A-Za-z.-])"),
    ("phone", r"(?<![0-9A-Za-z+.-])0[1-9](?:[ .-]?[0-9]{2,4}){3,4}(?![0-9A-Za-z.-])"),
    ("iban", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])"),
    ("key", r"(?<![0-9A-Za-z])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36})(?![0-9A-Za-z])"),
    ("key", r"(?i:password|passwd|secret|token|api_?key|access_?key|credentials?)[\"']?[ \t]*(?:[:=]|=>|:=)[ \t]*[\"']?(?P<value>[A-Za-z0-9+/_.=!#$%^&*~-]{6,}+)(?!@)"),
    ("key", r"(?<![A-Za-z0-9+/_=.-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{24,}+={0,2}(?![@.][A-Za-z0-9])"),
    ("ssn", r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z.-])"),
)]
_WORTH = re.compile(r"[0-9@]|(?i:passw|secret|token|api_?key|access_?key|credential)|AKIA|gh[pousr]_|:[0-9A-Fa-f]{1,4}:|[ \[(]at[ \])]")
#: Common ends of host names.
ENDINGS = frozenset("com org net edu gov info io co de fr es it nl uk us eu ch at be".split())
CONTEXT = re.compile(r"call|phone|tel|mobile|fax|e-?mail|mail|contact|write|reach|card|visa|pay|ssn|social|iban|account|bank|ip|host|server|key|secret|token|passw|credential", re.I)
_ISSUED = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}")
_ASSIGNED = re.compile(r"[:=]>?[ \t]*[\"']?\Z")
AGAINST = re.compile(r"(?<![^\W\d_])(?:order|invoice|version|isbn|serial|ticket|part|page|chapter|item|build|lot|ref|commit|revision|checksum|digest)s?(?![^\W\d_])", re.I)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str | None) -> list[Span]:
    """(kind, start, end) of the base patterns, leftmost and non-overlapping by kind, in order of kind and start.

    email: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+ is found from each @ outward, so time is linear even in
    long runs of letters; the others are linear as written, since no match can start inside a run of digits.
    """
    if not text:
        return []
    out: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and _LOCAL_END.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
        done = max(m.end() if m else 0, at + 1)
        at = text.find("@", at + 1 if not m else m.end())
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 40:
            digits = re.sub("[ -]", "", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(map(str.isdigit, m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def candidates(text: str | None) -> list[Span]:
    """Distinct spans of the further generators; they may overlap. Of an assignment, the span is the value."""
    if not text or not _WORTH.search(text):
        return []
    return list(dict.fromkeys((kind, *m.span("value" if pattern.groupindex else 0)) for kind, pattern in GENERATORS for m in pattern.finditer(text)))


def _iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


_CHANGE = re.compile(r"(?<=[a-z])[^a-z\W_]|(?<=[A-Z])[^A-Z\W_]|(?<=[0-9])[^0-9\W_]")


def randomness(s: str) -> list[float]:
    """How a string is made: bits a character, share of vowels among its letters, changes between lower case, upper case and digits
    as a share of its length, longest run of letters, whether all of it is hexadecimal, share of other characters."""
    n = max(len(s), 1)
    counts = np.unique(np.frombuffer(s.encode("utf-32-le"), np.uint32), return_counts=True)[1] / n
    letters = re.findall("[A-Za-z]+", s)
    plain = sum(map(len, letters))
    vowels = sum(s.count(c) for c in "aeiouAEIOU")
    return [float(-(counts * np.log2(counts)).sum()), vowels / max(plain, 1), len(_CHANGE.findall(s)) / n, max(map(len, letters), default=0), float(not re.search("[^0-9A-Fa-f]", s)), len(re.findall("[^A-Za-z0-9]", s)) / n]


def features(text: str, span: Span) -> list[float]:
    """Format and context features of a candidate."""
    kind, a, b = span
    s = text[a:b]
    digits = re.sub("[^0-9]", "", s)
    before, after = text[max(0, a - 40) : a], text[b : b + 24]
    groups = [len(g) for g in re.findall("[0-9]+", s)]
    valid = {"card": luhn(digits) if digits else False, "iban": kind == "iban" and _iban_ok(s), "ssn": digits[:3] not in ("000", "666") and digits[:1] != "9" and digits[3:5] != "00" and digits[5:] != "0000"}.get(kind, True)
    return [KINDS.index(kind), b - a, len(digits), len(set(digits)), len(groups), max(groups, default=0), float(valid), s.count("-"), s.count(" "), s.count("."), s.count("("), float("[at]" in s or "(at)" in s), float("dot" in s), sum(map(str.isalpha, s)), float(a == 0 or text[a - 1].isspace()), float(b == len(text) or text[b].isspace() or text[b] in ".,;:"), float(bool(CONTEXT.search(before))), float(bool(AGAINST.search(text, max(0, a - 40), a))), float(bool(CONTEXT.search(after))), float(digits[:1] == "0"), float(digits[:3] == "555" or digits[3:6] == "555"), float(re.split(r"[\s.)\]]+", s.lower())[-1] in ENDINGS), float(bool(_ASSIGNED.search(text, max(0, a - 24), a))), float(bool(_ISSUED.match(s))), *randomness(s)]


@dataclass
class BoostedTrees:
    """Depth-limited regression trees on the logistic loss. A tree: arrays of feature, cut, and leaf values."""

    start: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.start)
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            z += leaf[node - (2**self.depth - 1)]
        return z


def fit_boosted(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.2, l2: float = 1.0) -> BoostedTrees:
    p = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
    model = BoostedTrees(float(np.log(p / (1 - p))), [], depth)
    z = np.full(len(x), model.start)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, 24))) for j in range(x.shape[1])] if len(x) else []
    for _ in range(trees if len(x) else 0):
        q = 1 / (1 + np.exp(-z))
        g, h = y - q, q * (1 - q)
        inner = 2**depth - 1
        feature, cut, node = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(len(x), int)
        for n in range(inner):
            rows = np.flatnonzero(node == n)
            if len(rows) > 4:
                gs, hs = g[rows].sum(), h[rows].sum()
                best = gs * gs / (hs + l2) + 1e-6
                for j, options in enumerate(cuts):
                    over = x[rows, j][:, None] > options
                    gr, hr = g[rows] @ over, h[rows] @ over
                    gain = gr**2 / (hr + l2) + (gs - gr) ** 2 / (hs - hr + l2)
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, feature[n], cut[n] = gain[k], j, options[k]
            node[rows] = 2 * n + 1 + (x[rows, feature[n]] > cut[n])
        at = node - inner
        leaf = rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + l2)
        model.trees.append((feature, cut, leaf))
        z += leaf[at]
    return model


@dataclass
class PiiModel:
    """thresholds: least calibrated probability of each kind; held_out: (precision, recall) at it on held-out examples."""

    trees: BoostedTrees
    thresholds: dict[str, float]
    steps: tuple[np.ndarray, np.ndarray]  # margins and probabilities of the calibration, both ascending
    held_out: dict[str, tuple[float, float]]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.trees.margin(x), *self.steps)


def isotonic(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Margins and calibrated probabilities: the non-decreasing fit to y (pooled adjacent violators), each pool's mean
    margin. Pools are drawn to a half by one example."""
    order = np.lexsort([y, z])
    pools: list[list[float]] = []
    for margin, label in zip(z[order], y[order], strict=True):
        pools.append([1.0, float(label), float(margin)])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            n, good, total = pools.pop()
            pools[-1] = [pools[-1][0] + n, pools[-1][1] + good, pools[-1][2] + total]
    if not pools:
        return np.zeros(1), np.full(1, 0.5)
    n, good, total = np.array(pools).T
    return total / n, np.maximum.accumulate((good + 0.5) / (n + 1))


def labelled_examples(n: int = 2400, seed: int = 3) -> list[tuple[str, Span, int]]:
    """Texts with a candidate or two of one label, made from templates by a rule; the same on every call."""
    rng = random.Random(seed)
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(3, 9)))

    def amex(ok: bool) -> str:
        while True:
            s = rng.choice(("34", "37")) + num(13)
            if luhn(s) == ok:
                gap = rng.choice(("", " ", "-"))
                return f"{s[:4]}{gap}{s[4:10]}{gap}{s[10:]}"

    def iban(ok: bool) -> str:
        land, body = rng.choice(("DE", "GB", "NL", "ES", "IT")), num(rng.choice((14, 18, 20)))
        check = 98 - int(body + "".join(str(int(c, 36)) for c in land) + "00") % 97 if ok else rng.randint(2, 98)
        s = f"{land}{check:02d}{body}"
        return " ".join(s[i : i + 4] for i in range(0, len(s), 4)) if rng.random() < 0.4 else s

    local = lambda: word() + rng.choice(("", "", f".{word()}", f"_{word()}", num(2)))
    spoken = lambda: f"{local()} at {word()}.{rng.choice(sorted(ENDINGS))}"
    good = [spoken, spoken, lambda: f"{local()}{rng.choice([' [at] ', '[at]', ' (at) '])}{word()}{rng.choice([' [dot] ', '[dot]', ' (dot) '])}com", lambda: f"({num(3)}) {rng.choice(('555', num(3)))}-{num(4)}", lambda: f"{rng.randint(201, 989)}-{num(3)}-{num(4)}", lambda: amex(True), lambda: iban(True), lambda: "AKIA" + "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZ234567") for _ in range(16)), lambda: f"{rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}", lambda: ":".join(f"{rng.getrandbits(16):x}" for _ in range(8)), lambda: f"0{rng.randint(1, 9)} {num(2)} {num(2)} {num(2)} {num(2)}"]
    bad = [lambda: f"{word()} at {word()}. {word()}", lambda: f"{word()} at {word()}.{word()}", lambda: f"{num(3)}.{num(3)}.{num(4)}", lambda: f"{num(3)} {num(3)} {num(4)}", lambda: amex(False), lambda: iban(False), lambda: f"000-{num(2)}-{num(4)}", lambda: f"0{rng.randint(1, 9)}{num(8)}"]
    hints, noise = ("call ", "contact ", "my card ", "email ", "account ", "phone: ", "reach me: "), ("order ", "invoice no ", "version ", "part ", "serial ", "item ")
    out = []
    for i in range(n):
        y = int(i % 2 == 0)
        s = rng.choice(good if y else bad)()
        lead = rng.choice((hints if rng.random() < 0.6 else ("",)) if y else (noise if rng.random() < 0.5 else ("",)))
        if rng.random() < 0.15:  # words that say the other thing
            lead = rng.choice(noise if y else hints)
        text = f"{word()} {word()} {lead}{s} {word()} {word()}."
        for span in candidates(text):
            out.append((text, span, y))
    return out + _credential_examples(rng, n // 2, word)


def _credential_examples(rng: random.Random, n: int, word: Callable[[], str]) -> list[tuple[str, Span, int]]:
    """Assigned and bare credentials, and what looks like them: words, names of variables, slugs, paths, hashes of versions."""
    some = lambda alphabet, k: "".join(rng.choice(alphabet) for _ in range(k))
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    mixed, hexes = lower + lower.upper() + digits, digits + "abcdef"
    name = lambda: rng.choice(("password", "passwd", "secret", "token", "api_key", "apikey", "access_key", "credential", "db_password", "AUTH_TOKEN"))

    def assigned(value: str) -> str:
        quote = rng.choice(("", "'", '"'))
        return f"{name()}{rng.choice((' = ', '=', ': ', ':', ' := '))}{quote}{value}{quote}"

    def random_key() -> str:
        while True:
            s = some(mixed + rng.choice(("", "+/", "_-")), rng.randint(24, 64))
            if re.search("[0-9]", s) and s[0].isalnum() and s[-1].isalnum():
                return s

    good = [
        lambda: assigned(some(hexes, rng.choice((24, 32, 40, 64)))), lambda: assigned(random_key()), lambda: assigned(some(mixed, rng.randint(8, 20))),
        lambda: assigned(word().capitalize() + some(digits, rng.randint(2, 4)) + rng.choice(("", "!", "#", "$"))), lambda: f"{word()} {random_key()}",
        lambda: f"{word()} gh{rng.choice('pousr')}_{some(rng.choice((mixed, lower)), 36)}", lambda: f"{word()} AKIA{some('ABCDEFGHJKLMNPQRSTUVWXYZ234567', 16)}",
    ]
    bad = [
        lambda: assigned(word() + word()), lambda: assigned(f"{word()}_{word()}"), lambda: assigned(f"{word()}.{word()}.{word()}"), lambda: assigned(rng.choice(("required", "optional", "hidden", "string", "nothing", "missing"))),
        lambda: f"{rng.choice(('commit', 'revision', 'checksum', 'digest'))} {some(hexes, rng.choice((32, 40, 64)))}", lambda: "-".join([*(word() for _ in range(5)), some(digits, 4)]), lambda: "/".join(["", *(word() for _ in range(4)), word() + some(digits, 1), word()]),
        lambda: "_".join([word(), word(), some(digits, 1), word(), word(), word()]), lambda: "-".join(some(hexes, k) for k in (8, 4, 4, 4, 12)), lambda: some(digits, rng.randint(24, 30)),
    ]
    out = []
    for i in range(n):
        y = int(i % 2 == 0)
        text = f"{word()} {word()} {rng.choice(good if y else bad)()} {word()} {word()}."
        out += [(text, span, y) for span in candidates(text) if span[0] == "key"]
    return out


def least_cut(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The least probability of at least 0.5 that reaches the precision, or else the best one; 0.5 without such a score."""
    cuts = np.unique(p[p >= 0.5])
    reached = [min(float(y[p >= c].mean()), precision) for c in cuts]
    return float(cuts[int(np.argmax(reached))]) if reached else 0.5


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id", sample: int = 3000, precision: float = 0.99) -> PiiModel:
    """Boosted trees on made examples and on weakly labelled candidates of about sample texts with digits.

    A corpus candidate inside a base span is a positive (credentials are learned from made examples alone), one next to a word of the AGAINST list a negative; others take
    no part; above about 10 * sample candidates, a share of them is taken by a hash of key and span. Two thirds train; the
    rest calibrates margins to probabilities and sets each kind's threshold: the least probability that reaches the
    precision there, or else the best precision there is, halfway to the next lower score (at least 0.5). Null and empty texts and an empty table give no example; repeated
    rows count as often as they are given.
    """
    store.small_batches(docs.sparkSession)
    rich = docs.where(F.col(text).rlike("[0-9]{3}|@"))
    part = min(1.0, sample / max(1, rich.count()))

    def weak(batches: Iterator) -> Iterator:
        for b in batches:
            out = []
            for k, t in zip(b["key"], b["text"], strict=True):
                base = base_spans(t)
                for c in candidates(t):
                    if c[0] != "key" and any(s <= c[1] and c[2] <= e for _, s, e in base):
                        out.append((f"{k}:{c}", [*map(float, features(t, c))], 1))
                    elif AGAINST.search(t, max(0, c[1] - 12), c[1]):
                        out.append((f"{k}:{c}", [*map(float, features(t, c))], 0))
                if len(out) >= 1000:
                    yield pd.DataFrame(out, columns=["span", "x", "y"])
                    out = []
            yield pd.DataFrame(out, columns=["span", "x", "y"])

    seen = store.pinned(rich.where(store.share(F.col(key), part)).select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInPandas(weak, "span string, x array<double>, y int"))
    seen = seen.where(store.share(F.col("span"), min(1.0, 10 * sample / max(1, seen.count())))).select("x", "y").toPandas()
    made = labelled_examples()
    x = np.array([features(t, s) for t, s, _ in made] + [list(v) for v in seen["x"]], float)
    y = np.array([v for _, _, v in made] + seen["y"].tolist(), float)
    order = np.lexsort([*x.T[::-1], y])
    x, y = x[order], y[order]
    test = np.arange(len(x)) % 3 == 0
    trees = fit_boosted(x[~test], y[~test])
    model = PiiModel(trees, {}, isotonic(trees.margin(x[test]), y[test]), {})
    p = model.probability(x[test])
    for i, kind in enumerate(KINDS):
        mine = x[test][:, 0] == i
        own, truth = p[mine], y[test][mine]
        cut = least_cut(own, truth, precision)
        model.thresholds[kind] = max(0.5, (cut + own[own < cut].max(initial=0.0)) / 2)  # between scores: the same choice here
        taken = truth[own >= cut]
        model.held_out[kind] = (float(taken.mean()) if taken.size else 1.0, float(taken.sum() / max(1, truth.sum())))
    return model


def all_spans(text: str | None, model: PiiModel) -> tuple[list[Span], list[Span]]:
    """Base spans, and all: base ones and the selected candidates that overlap none of them nor a better candidate."""
    base = base_spans(text)
    found = candidates(text)
    if not found:
        return base, base
    z = model.probability(np.array([features(text, c) for c in found], float))
    taken = [(s, e) for _, s, e in base]
    extra = []
    for i in np.argsort(-z, kind="stable"):
        kind, s, e = found[i]
        if z[i] >= model.thresholds[kind] and all(e <= a or b <= s for a, b in taken):
            taken.append((s, e))
            extra.append(found[i])
    return base, sorted(base + extra, key=lambda v: (KINDS.index(v[0]), v[1], v[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redacted(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span replaced by its kind in brackets; overlapping spans are replaced as one."""
    if not text or not spans:
        return text
    out, at = [], 0
    for k, s, e in sorted(spans, key=lambda v: (v[1], -v[2])):
        if s >= at:
            out += [text[at:s], f"[{k.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def detect(docs: DataFrame, model: PiiModel, text: str = "text", redact: bool = False) -> Column:
    """Struct (base, spans: arrays of kind, start, end; digest; redacted) of each whole text.

    Offsets are code points, end exclusive. Null and empty texts have no span; redacted is null unless asked for.
    """
    store.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = "array<struct<kind:string,start:int,end:int>>"

    @F.pandas_udf(f"base {span}, spans {span}, base_sha256 string, joined string, redacted string")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        as_rows = lambda spans: [{"kind": k, "start": s, "end": e} for k, s, e in spans]
        for texts in batches:
            out = []
            for t in texts:
                base, every = all_spans(t, shared.value)
                out.append((as_rows(base), as_rows(every), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), redacted(t, every) if redact else None))
            yield pd.DataFrame(out, columns=["base", "spans", "base_sha256", "joined", "redacted"])

    return find(F.col(text))
