"""Secrets by grammar inference: probabilistic automata of credential formats.

The labelled credentials of a format make a prefix tree with counts. States are merged where a Hoeffding bound finds their
endings and next characters, and those of their successors, compatible; what remains is a deterministic automaton with
probabilities. Every candidate of a text, a long run of the characters that credentials are made of, is scored by its
likelihood under the best format against a model of the corpus's ordinary characters. Three base patterns with fixed meaning
always stay in the result.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import log, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store

# The base patterns and the order of kinds.
BASE_KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{24,}")  # as the longer runs of [0-9a-f]+
_KEYWORD = re.compile("(?i:pass|secret|token|api_?key)", re.ASCII)
_RUN = re.compile("[A-Za-z0-9+/_.=-]{16,}")
_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_ALNUM = _LOWER + _UPPER + _DIGIT
# Published formats of credentials as prefixes, alphabet and length of the rest.
FORMATS: dict[str, tuple[tuple[str, ...], str, int]] = {
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), _ALNUM, 36),
    "slack": (("xoxb-", "xoxp-", "xoxa-", "xoxr-"), _DIGIT + _LOWER, 48),
    "stripe": (("sk_live_", "rk_live_", "sk_test_"), _ALNUM, 24),
    "google": (("AIza",), _ALNUM + "_-", 35),
    "gitlab": (("glpat-",), _ALNUM + "_-", 20),
    "npm": (("npm_",), _ALNUM, 36),
    "jwt": (("eyJhbGciOi",), _ALNUM + "_-.", 120),
    "sendgrid": (("SG.",), _ALNUM + "_-.", 66),
    "aws": (("ASIA", "AKIA", "AROA", "AIDA"), _UPPER + "234567", 16),
    "base64": (("",), _ALNUM + "+/", 40),
    "hexupper": (("",), _DIGIT + "ABCDEF", 40),
}
KINDS = (*BASE_KINDS, *FORMATS)

Span = tuple[str, int, int]


def _by_start(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def base_spans(text: str | None) -> list[Span]:
    """(kind, start, end) of the base patterns, leftmost and non-overlapping by kind, in order of start and kind.

    A match of assign counts with a value of 6 or more characters, of access with 20 or more, of hex with 24 or more; a
    failing match is dropped whole. Keywords match in either case of the letters a to z alone.
    """
    if not text:
        return []
    out: list[Span] = []
    if _KEYWORD.search(text):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(out, key=_by_start)


def candidates(text: str | None) -> list[tuple[int, int]]:
    """Spans of runs of 16 or more characters of credentials, without punctuation at their ends but a closing =."""
    out = []
    for m in _RUN.finditer(text or ""):
        run = m[0].rstrip("._-/+").lstrip("._-/+=")
        start = m.start() + len(m[0]) - len(m[0].lstrip("._-/+="))
        if len(run) >= 16:
            out.append((start, start + len(run)))
    return out


@dataclass
class Automaton:
    """A deterministic automaton with counts: next[s] maps a character to (state, count); seen[s] and ends[s] count visits
    and endings. State 0 is the start."""

    next: list[dict[str, tuple[int, int]]]
    seen: list[int]
    ends: list[int]
    _logs: list[dict[str, tuple[int, float]]] = field(default_factory=list, repr=False)

    def __post_init__(self) -> None:
        # one more than the character set shares one pseudo-count, so that an unseen character is unlikely but possible
        self._spare = [log(1 / (CHARACTERS * (n + 1))) for n in self.seen]
        self._logs = [{c: (to, log((k + 1 / CHARACTERS) / (self.seen[s] + 1))) for c, (to, k) in moves.items()} for s, moves in enumerate(self.next)]

    def loglik(self, word: str) -> float:
        """Natural logarithm of the chance that the automaton emits the word and ends there. After a character that its state
        has not seen, each further one has the chance of any character."""
        s, total = 0, 0.0
        for i, c in enumerate(word):
            move = self._logs[s].get(c)
            if move is None:
                return total + self._spare[s] + (len(word) - i) * -log(CHARACTERS)
            s, step = move
            total += step
        return total + log((self.ends[s] + 1 / CHARACTERS) / (self.seen[s] + 1))


#: Characters of candidates and one for the end.
CHARACTERS = 69


class _Graph:
    """Prefix trees under merge: kids[s] maps a character to [state, count]; red states are those that stay."""

    def __init__(self, alpha: float = 0.05) -> None:
        self.kids: list[dict[str, list[int]]] = [{}]
        self.seen, self.ends, self.red = [0], [0], [0]
        self.bound = sqrt(0.5 * log(2 / alpha))

    def add(self, at: int, word: str, n: int, ended: int) -> None:
        """A state for a word below state `at`, seen n times and ended so often; its prefixes are added before it."""
        for c in word[:-1]:
            at = self.kids[at][c][0]
        self.kids[at][word[-1]] = [len(self.kids), n]
        self.kids.append({})
        self.seen.append(n)
        self.ends.append(ended)

    def compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.seen[a], self.seen[b]
            far = self.bound * (n**-0.5 + m**-0.5)
            if far >= 1:
                continue  # shares differ by 1 at most; successors are seen no more often in a tree
            if abs(self.ends[a] / n - self.ends[b] / m) > far:
                return False
            for c in self.kids[a].keys() | self.kids[b].keys():
                x, y = self.kids[a].get(c), self.kids[b].get(c)
                if abs((x[1] if x else 0) / n - (y[1] if y else 0) / m) > far:
                    return False
                if x and y:
                    todo.append((x[0], y[0]))
        return True

    def fold(self, a: int, b: int) -> None:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.seen[a] += self.seen[b]
            self.ends[a] += self.ends[b]
            for c, (to, k) in self.kids[b].items():
                if c in self.kids[a]:
                    self.kids[a][c][1] += k
                    todo.append((self.kids[a][c][0], to))
                else:
                    self.kids[a][c] = [to, k]

    def merge(self) -> None:
        red = self.red
        while True:
            place = set(red)
            blue = [(-self.seen[to], i, c, to) for i, s in enumerate(red) for c, (to, _) in self.kids[s].items() if to not in place]
            if not blue:
                return
            _, i, c, to = min(blue)
            parent = red[i]
            for r in [parent, *(s for s in reversed(red) if s != parent)]:
                if self.compatible(r, to):
                    self.kids[parent][c][0] = r
                    self.fold(r, to)
                    break
            else:
                red.append(to)

    def moves(self) -> dict[int, dict[str, int]]:
        return {s: {c: to for c, (to, _) in self.kids[s].items()} for s in self.red}

    def automaton(self) -> Automaton:
        place = {s: i for i, s in enumerate(self.red)}
        return Automaton([{c: (place[to], k) for c, (to, k) in sorted(self.kids[s].items())} for s in self.red], [self.seen[s] for s in self.red], [self.ends[s] for s in self.red])


def learn(words: Iterable[str], alpha: float = 0.05) -> Automaton:
    """The automaton of the words' prefix tree after merging compatible states (ALERGIA, red and blue states).

    The blue state seen most often is tried against the red ones, its parent and what was made last before others, so that
    states with few visits join the state they follow; without a compatible one it becomes red. Two states are compatible if
    the shares of their endings and of each next character differ by no more than sqrt(log(2 / alpha) / 2) * (n ** -.5 +
    m ** -.5), and so do their successors. Words count as often as they are given; no words give one state without moves.
    """
    words = list(words)
    graph, ended = _Graph(alpha), Counter(words)
    graph.seen[0], graph.ends[0] = len(words), ended[""]
    for w, n in Counter(w[:i] for w in words for i in range(1, len(w) + 1)).items():
        graph.add(0, w, n, ended[w])
    graph.merge()
    return graph.automaton()


def _walked(moves: dict[int, dict[str, int]], word: str) -> Iterator[tuple[int, str, int]]:
    """(state, character, place) of each step, up to and with the first one that has no move."""
    s = 0
    for i, c in enumerate(word):
        yield s, c, i
        if c not in moves[s]:
            return
        s = moves[s][c]
    yield s, "", len(word)


def learn_all(values: DataFrame, kinds: dict[str, int], depth: int = 64, few: int = 20, alpha: float = 0.05, nodes: int = 100_000) -> dict[str, Automaton]:
    """The automata of all values (kind, value; pinned) by kind, as learn has them, without the values on the driver.

    kinds: characters of all values of a kind. Prefixes and their counts come from Spark. Those seen at least c times reach the
    driver, c being the characters over `nodes`, so that there are no more than that; with c = 1 the tree is whole. Values
    that leave the automaton, which tells `depth` characters a round at most, do so in a state with a rest: rests are the
    next round's prefix trees below these states. A move seen by fewer than `few` values or c stays in the state it
    leaves. The last pass counts every value's moves and endings.
    """
    graphs = {k: _Graph(alpha) for k in kinds}
    least = {k: max(1, -(-chars // nodes)) for k, chars in kinds.items()}
    first = True

    def run(make, schema: str) -> DataFrame:
        shared = values.sparkSession.sparkContext.broadcast({k: g.moves() for k, g in graphs.items()})

        def each(batches: Iterator) -> Iterator:
            for b in batches:
                rows = [r for k, v in zip(b["kind"], b["value"], strict=True) for r in make(k, list(_walked(shared.value[k], v)), v)]
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

        return values.where(F.col("kind").isin(list(kinds))).mapInPandas(each, schema)

    def rests(kind: str, steps: list, value: str) -> list:
        s, c, i = steps[-1]
        rest = value[i : i + depth]
        return [(kind, s, rest[:n], int(i + n == len(value))) for n in range(1, len(rest) + 1)] if c else []

    while True:
        need = F.create_map(*[F.lit(x) for k, n in least.items() for x in (k, n if first else max(n, few))])[F.col("kind")]
        found = run(rests, "kind string, s int, prefix string, ended int").groupBy("kind", "s", "prefix").agg(F.count("*").alias("n"), F.sum("ended").alias("e"))
        rows = found.where((F.col("n") >= need) | (F.length("prefix") == 1)).collect()  # at most `nodes` a kind and one a move
        if not rows:
            break
        for r in sorted(rows, key=lambda r: (r["kind"], r["s"], len(r["prefix"]), r["prefix"])):
            g = graphs[r["kind"]]
            if len(r["prefix"]) == 1 and r["n"] < (least[r["kind"]] if first else max(least[r["kind"]], few)):
                g.kids[r["s"]][r["prefix"]] = [r["s"], r["n"]]
            else:
                g.add(r["s"], r["prefix"], r["n"], r["e"])
            if first and len(r["prefix"]) == 1:
                g.seen[0] += r["n"]
        for g in graphs.values():
            g.merge()
        first = False
    counted = run(lambda kind, steps, value: [(kind, s, c) for s, c, _ in steps], "kind string, s int, c string").groupBy("kind", "s", "c").agg(F.count("*").alias("n"))
    for g in graphs.values():
        g.seen, g.ends = [0] * len(g.seen), [0] * len(g.ends)
        for s in g.red:
            g.kids[s] = {c: [to, 0] for c, (to, _) in g.kids[s].items()}
    for r in counted.collect():  # a row for each move of the automata
        g = graphs[r["kind"]]
        g.seen[r["s"]] += r["n"]
        if r["c"]:
            g.kids[r["s"]][r["c"]][1] = r["n"]
        else:
            g.ends[r["s"]] = r["n"]
    return {k: g.automaton() for k, g in graphs.items()}


@dataclass
class Model:
    """formats: automata by kind. ordinary: log chances of a character of a run after the one before it (69 x 69; the last
    row starts a run, the last column ends it). threshold: least log odds of a secret. held_out: (precision, recall) there."""

    formats: dict[str, Automaton]
    ordinary: np.ndarray
    threshold: float = 0.0
    held_out: tuple[float, float] = (1.0, 1.0)

    def odds(self, run: str) -> tuple[float, str]:
        """Log odds of the likeliest format against ordinary text, and the format."""
        at = np.array([CHARACTERS - 1, *map(INDEX.__getitem__, run), CHARACTERS - 1])
        plain = float(self.ordinary[at[:-1], at[1:]].sum())
        return max(((a.loglik(run) - plain, k) for k, a in self.formats.items()), default=(-np.inf, ""))


INDEX = {c: i for i, c in enumerate(_ALNUM + "+/_.=-")}


def made(name: str, n: int, seed: int = 5) -> list[str]:
    """n labelled credentials of a format, made by its rule; the same on every call."""
    rng = random.Random(f"{seed}:{name}")
    prefixes, alphabet, length = FORMATS[name]
    return [rng.choice(prefixes) + "".join(rng.choice(alphabet) for _ in range(length)) for _ in range(n)]


def ordinary_runs(n: int = 600, seed: int = 7) -> list[str]:
    """Labelled runs that are no credentials, made by a rule: words, names, paths, hosts, numbers, dates, versions."""
    rng = random.Random(seed)
    syllable = lambda: rng.choice("bcdfghlmnprst") + rng.choice("aeiou") + rng.choice(["", "n", "r", "s", "t"])
    word = lambda: "".join(syllable() for _ in range(rng.randint(2, 5)))
    num = lambda k: "".join(rng.choice(_DIGIT) for _ in range(k))
    kinds = [
        lambda: "".join(word() for _ in range(4)), lambda: "-".join(word() for _ in range(4)), lambda: "_".join(word() for _ in range(4)), lambda: word() + "".join(word().title() for _ in range(3)),
        lambda: f"{word()}.{word()}{num(1)}.example.com", lambda: "/".join(word() for _ in range(4)) + ".html", lambda: num(rng.randint(16, 24)), lambda: f"20{num(2)}-{num(2)}-{num(2)}T{num(2)}-{num(2)}-{num(2)}.{num(6)}",
        lambda: f"{word()}-{word()}-{num(1)}.{num(2)}.{num(1)}-{word()}", lambda: rng.choice("=-_.") * rng.randint(16, 40), lambda: "".join(word() for _ in range(4)).upper(), lambda: f"{word()}_{word()}={num(3)}_{word()}",
    ]
    return [r for i in range(n) if len(r := kinds[i % len(kinds)]()) >= 16]


def _chances(pairs: Counter) -> np.ndarray:
    counts = np.full((CHARACTERS, CHARACTERS), 0.5)
    for (a, b), n in pairs.items():
        counts[a, b] += n
    return np.log(counts / counts.sum(1, keepdims=True))


def _pairs(run: str) -> Iterator[tuple[int, int]]:
    at = [CHARACTERS - 1, *map(INDEX.__getitem__, run), CHARACTERS - 1]
    return zip(at, at[1:], strict=False)


_CODES = np.full(256, CHARACTERS - 1, dtype=np.uint8)
_CODES[[ord(c) for c in INDEX]] = list(INDEX.values())


def _text_pairs(texts: list[str]) -> np.ndarray:
    """Counts of the pairs of characters in the texts' words, as _pairs has them (69 x 69)."""
    at = _CODES[np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-8", "replace"), dtype=np.uint8)].astype(np.int32)
    got = np.bincount(at[:-1] * CHARACTERS + at[1:], minlength=CHARACTERS**2)
    got[-1] = 0
    return got


def fit(docs: DataFrame, text: str = "text", examples: int = 300) -> Model:
    """Automata of all credentials that the base patterns label in the documents, and of made ones.

    Every document is read and every different value counts once; `examples` are made of each format; a third of both, by hash,
    is held out. Ordinary characters are counted over all words outside base spans and over made runs; the threshold is the
    least log odds above 0 that leaves precision 0.99 on the held-out third of all. Null and empty texts give nothing; an
    empty table leaves the made examples alone.
    """
    store.small_batches(docs.sparkSession)

    def labelled(batches: Iterator) -> Iterator:
        pairs = np.zeros(CHARACTERS**2, dtype=np.int64)
        for b in batches:
            out, plain = [], []
            for t in b["text"]:
                spans = base_spans(t)
                for kind, s, e in spans:
                    value = _ASSIGN.fullmatch(t, s, e)[1] if kind == "assign" else t[s:e]
                    if len(value) >= 16:
                        out.append((kind, value, 1))
                at = 0
                for _, s, e in [*sorted(spans, key=lambda v: v[1]), ("", len(t), len(t))]:
                    plain.append(t[at:s])
                    at = max(at, e)
            pairs += _text_pairs(plain)
            yield pd.DataFrame(out, columns=["kind", "value", "n"])
        yield pd.DataFrame([("", f"{i // CHARACTERS} {i % CHARACTERS}", int(pairs[i])) for i in np.flatnonzero(pairs)], columns=["kind", "value", "n"])

    rows = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"))
    rows = store.pinned(rows.mapInPandas(labelled, "kind string, value string, n long").groupBy("kind", "value").agg(F.sum("n").alias("n")))
    pairs = Counter({tuple(map(int, r["value"].split())): r["n"] for r in rows.where("kind = ''").collect()})  # 69 x 69 at most
    held = lambda w: hashlib.md5(w.encode()).digest()[0] % 3 == 0
    held_row = F.conv(F.substring(F.md5("value"), 1, 2), 16, 10).cast("int") % 3 == 0
    values = rows.where("kind <> ''").select("kind", "value")
    train, test = values.where(~held_row), values.where(held_row)
    sizes = {r["kind"]: r for r in train.groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.length("value")).alias("chars")).collect()}
    words = {k: made(k, examples) for k in FORMATS}
    plain = ordinary_runs()
    scale = max(1, sum(pairs.values()) // (40 * 20 * len(plain)))  # made runs are about a fortieth of the characters
    for w in plain:
        if not held(w):
            for p in _pairs(w):
                pairs[p] += scale
    kinds = {k: sizes[k]["chars"] for k in BASE_KINDS if k in sizes and sizes[k]["n"] >= 20}
    formats = learn_all(train, kinds) if kinds else {}
    model = Model(formats | {k: learn(w for w in v if not held(w)) for k, v in words.items() if sum(not held(w) for w in v) >= 20}, _chances(pairs))
    bad = np.sort([model.odds(w)[0] for w in plain if held(w)])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator) -> Iterator:
        for b in batches:
            odds = np.array([shared.value.odds(w)[0] for w in b["value"]], dtype=float)
            yield pd.DataFrame({"odds": odds, "below": np.searchsorted(bad, odds)})

    # good and bad runs meet by the number of bad ones below: of equal ones the lowest is the first to pass
    test = store.pinned(test.mapInPandas(scored, "odds double, below int"))
    own = np.array([model.odds(w)[0] for v in words.values() for w in v if held(w)])
    parts: dict[int, list[float]] = {}
    found = test.groupBy("below").agg(F.min(F.when(F.col("odds") > 0, F.col("odds"))).alias("low"), F.max("odds").alias("high"), F.count("*").alias("n"))
    for below, low, high, n in [*(tuple(r) for r in found.collect()), *((int(np.searchsorted(bad, x)), float(x) if x > 0 else None, float(x), 1) for x in own)]:
        parts.setdefault(below, []).append((low, high, n))
    count = lambda cut: int((own >= cut).sum()) + test.where(F.col("odds") >= float(cut)).count()
    lows = sorted((min(lo for lo, _, _ in v if lo is not None), k) for k, v in parts.items() if any(lo is not None for lo, _, _ in v))
    model.threshold = next((lo for lo, k in lows if (good := count(lo)) >= 0.99 * (good + len(bad) - k)), max((h for v in parts.values() for _, h, _ in v if h > 0), default=float("inf")))
    taken, total = count(model.threshold), len(own) + sum(r["n"] for r in found.select("n").collect())
    model.held_out = (taken / max(1, taken + int((bad >= model.threshold).sum())), taken / max(1, total))
    return model


def all_spans(text: str | None, model: Model) -> tuple[list[Span], list[Span]]:
    """Base spans, and all: base ones and the runs above the threshold that overlap none of them."""
    base = base_spans(text)
    extra, ends, at, last = [], sorted((a, b) for _, a, b in base), 0, 0
    for s, e in candidates(text):
        while at < len(ends) and ends[at][0] < e:
            last = max(last, ends[at][1])
            at += 1
        if last <= s:
            odds, kind = model.odds(text[s:e])
            if odds >= model.threshold:
                extra.append((kind, s, e))
    return base, sorted(base + extra, key=_by_start)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Struct (base, spans: arrays of kind, start, end; base_sha256; joined) of each whole text.

    Offsets are code points, end exclusive. Null and empty texts have no span; each row is scanned by its text alone, repeated
    or not, whatever the other columns are.
    """
    store.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = "array<struct<kind:string,start:int,end:int>>"

    @F.pandas_udf(f"base {span}, spans {span}, base_sha256 string, joined string")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        as_rows = lambda spans: [{"kind": k, "start": s, "end": e} for k, s, e in spans]
        for texts in batches:
            out = []
            for t in texts:
                base, every = all_spans(t, shared.value)
                out.append((as_rows(base), as_rows(every), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            yield pd.DataFrame(out, columns=["base", "spans", "base_sha256", "joined"])

    return find(F.col(text))
