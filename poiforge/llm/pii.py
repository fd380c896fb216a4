"""Personal data: rule-based base spans, and further spans chosen by gradient-boosted trees.

Base spans are exact: email, ip, card and phone by their patterns and checks. Beyond them, high-recall generators propose overlapping
candidates: every stretch of up to six neighbouring groups of digits with as many digits as a phone or a card (so also what the
base pattern loses where two numbers stand side by side), dotted quads with any brackets around the dots, and addresses
with the @ or the dots written out. Boosted trees over format and context features score them, the scores are calibrated per
kind by isotonic regression, and candidates that reach their kind's threshold are added, best first, where they overlap no other
span. Base spans always stay.

The trees are trained here, on a bounded sample of documents. Positive rows are the documents' own base spans, in their context, as they are
and rewritten into other forms; all candidates that a rewritten form sets off with other borders are negative. So are candidates of the
documents that fail their kind's check (numbers like cards without the check digit, quads beyond 255), and look-alikes
put between the documents' words: dates, times, versions, order and account numbers, book numbers, amounts. One document in four
calibrates: a kind's threshold is the lowest probability from which at least `PRECISION` of its calibrating candidates were right;
a kind without `LEAST_POSITIVES` of them adds nothing.

Edge cases: a null text is empty and has no spans; documents are judged one by one, so repeated rows get equal results; extra
columns are ignored; with an empty table, or a sample without both classes, only base spans are returned. Of overlapping candidates the most
probable one wins, then the longer, then the first, then by kind as listed. Patterns use possessive repetition or bounds, so long
runs of one character class take linear time.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poiforge.llm.common import blocks, released, string_parts, table

KINDS = ("email", "ip", "card", "phone")
#: The trees' sample: about so many documents (by hashed key), and at most so many candidates of them.
SAMPLE_DOCUMENTS, SAMPLE_CANDIDATES = 40_000, 20_000
#: Share of right candidates, among those that calibrate a kind, from its threshold on; and right ones that it takes.
PRECISION, LEAST_POSITIVES = 0.95, 5

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_RUN = re.compile(r"(?<![0-9A-Za-z])(?:\+|\()?[0-9]++(?:[ ().,/-]{1,2}[0-9]++)*+(?![0-9A-Za-z])")
_GROUP = re.compile("[0-9]+")
_QUAD = re.compile(r"(?<![0-9A-Za-z.])(?=([0-9]{1,4}(?: ?[\[({]?(?:\.|dot)[\])}]? ?[0-9]{1,4}){3})(?![0-9A-Za-z]))")
_WRITTEN = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?: ?[\[({](?:at|@)[\])}] ?| at | @ ?|@ )[A-Za-z0-9-]{1,63}+(?:(?: ?[\[({](?:dot|\.)[\])}] ?| dot |\.| \. )[A-Za-z0-9-]{1,63}+){1,5}", re.I)
#: What every written-out address without an @ has.
_AT = re.compile(r"[ \[({]at[ \])}]", re.I)
#: Groups of digits that a candidate spans at most.
_GROUPS = 6
_CUES = {"phone": r"phone|tel|call|fax|mobile|dial|contact", "card": r"card|visa|credit|debit|master|pay", "ip": r"\bip\b|server|host|addr", "email": r"mail|contact|write|reach"}
_CUES = {k: re.compile(v, re.I) for k, v in _CUES.items()}
_OTHER_CUES = re.compile(r"order|invoice|ref|version|\bv\b|date|isbn|account|number|\bno\b|\bid\b|since|until|total", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by start, then kind as listed."""
    found, end = [], 0
    for m in _DOMAIN.finditer(text):
        lo = m.start()
        while lo > end and _LOCAL.match(text[lo - 1]):
            lo -= 1
        if lo < m.start():
            found.append((lo, 0, m.end()))
            end = m.end()
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(x := part.lstrip("0")) <= 3 and int(x or 0) <= 255 for part in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
    found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return [(KINDS[k], lo, hi) for lo, k, hi in sorted(found)]


FEATURES = (
    "kind", "digits", "length", "groups", "longest group", "shortest group", "first group", "last group", "spaces", "dots", "dashes", "slashes", "brackets", "different separators", "written at",
    "check digit", "small parts", "first digit", "distinct digits", "year in front", "plus in front", "digits go on before", "digits go on behind", "word before", "word behind", "cue", "other cue",
)


def features(text: str, kind: str, lo: int, hi: int) -> list[float]:
    """Format of the span and of its context of 30 characters to the left."""
    s = text[lo:hi]
    d = digits_of(s)
    groups = _GROUP.findall(s)
    sizes = [len(g) for g in groups] or [0]
    before, after, left = text[max(0, lo - 3) : lo], text[hi : hi + 3], text[max(0, lo - 30) : lo]
    signs = re.sub("[0-9A-Za-z]", "", s)
    return [
        KINDS.index(kind), len(d), hi - lo, len(groups), max(sizes), min(sizes), sizes[0], sizes[-1], s.count(" "), s.count("."), s.count("-"), s.count("/"), s.count("(") + s.count("["),
        len(set(signs) - set("()[]+")), float(bool(re.search(r"\bat\b", s, re.I))), float(bool(d) and luhn(d)), float(bool(groups) and all(len(g) <= 3 and int(g) <= 255 for g in groups)), float(d[:1] or -1),
        len(set(d)), float(s[:2] in ("19", "20") and sizes[0] == 4), float(s[:1] == "+" or before[-1:] == "+"), float(bool(re.search("[0-9][^0-9A-Za-z]{0,2}$", before))), float(bool(re.match("[^0-9A-Za-z]{0,2}[0-9]", after))),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(bool(_CUES[kind].search(left))), float(bool(_OTHER_CUES.search(left))),
    ]


def candidates(text: str) -> list[tuple[str, int, int]]:
    out = []
    for m in _RUN.finditer(text):
        if m.end() - m.start() < 7:
            continue
        groups = [(g.start() + m.start(), g.end() + m.start()) for g in _GROUP.finditer(m[0])]
        for i, (lo, _) in enumerate(groups):
            n = 0
            for a, hi in groups[i : i + _GROUPS]:
                n += hi - a
                if n > 19:
                    break
                # a plus or bracket in front belongs to a phone
                own = lo - 1 if lo > m.start() and text[lo - 1] in "+(" else lo
                if 7 <= n <= 15:
                    out.append(("phone", own, hi))
                if 13 <= n:
                    out.append(("card", lo, hi))
    out += [("ip", m.start(1), m.end(1)) for m in _QUAD.finditer(text)]
    if "@" in text or _AT.search(text):
        out += [("email", m.start(), m.end()) for m in _WRITTEN.finditer(text)]
    return out


def forms(kind: str, s: str, rnd: random.Random) -> list[tuple[str, str, str]]:
    """(in front, span, behind): a base span as it is, and written in other ways; some stand beside another number."""
    d = digits_of(s)
    number = str(rnd.randrange(10**15, 10**16))
    if kind == "phone":
        own = re.sub(r"^\+[0-9]{1,3}[ .-]?", "", s)
        n = digits_of(own)
        cut = [n[:-7], n[-7:-4], n[-4:]] if len(n) > 7 else [n[:-4], n[-4:]]
        out = [("", s, ""), ("", own, ""), ("", "00" + d, ""), ("", rnd.choice("-. ").join(cut), ""), ("", s, " " + number), ("", s, f" {rnd.randrange(1, 255)}.{rnd.randrange(255)}.{rnd.randrange(255)}")]
    elif kind == "card":
        parts = [d[i : i + 4] for i in range(0, len(d), 4)]
        out = [("", d, ""), ("", rnd.choice(" -").join(parts), ""), ("", ".".join(parts), ""), ("", "/".join(parts), ""), ("", d, " " + number), (number + " ", d, ""), ("", "  ".join(parts), "")]
    elif kind == "ip":
        out = [("", s, ""), *(("", s.replace(".", dot), "") for dot in ("[.]", "(.)", " . ", " dot "))]
    else:
        name, _, host = s.partition("@")
        out = [("", s, ""), *(("", name + at + host.replace(".", dot), "") for at, dot in ((" at ", " dot "), ("[at]", "[dot]"), (" (at) ", " (dot) "), (" @ ", "."), (" [at] ", "."), (" at ", ".")))]
    cue = rnd.choice({"phone": ("phone: ", "call ", "tel. "), "card": ("card ", "visa: ", "pay with "), "ip": ("ip ", "server ", "host: "), "email": ("mail ", "contact: ", "write to ")}[kind])
    return [(rnd.choice(("", "", cue)) + a, x, b) for a, x, b in out]


def lookalike(rnd: random.Random) -> str:
    """Numbers and words that are no personal data, close in format."""
    n = lambda k: str(rnd.randrange(10 ** (k - 1), 10**k))
    year, month, day = str(rnd.randrange(1900, 2100)), f"{rnd.randrange(1, 13):02}", f"{rnd.randrange(1, 29):02}"
    sign = rnd.choice("-./")
    wrong = n(15)
    wrong += rnd.choice([c for c in "0123456789" if not luhn(wrong + c)])
    plain = [
        sign.join((year, month, day)), sign.join((day, month, year)), f"{year}{month}{day}", f"{year}-{month}-{day} {rnd.randrange(24):02}.{rnd.randrange(60):02}", f"{year}-{int(year) + 1}",
        f"{rnd.randrange(30)}.{rnd.randrange(30)}.{rnd.randrange(300, 9999)}.{rnd.randrange(30)}", f"{rnd.randrange(10)}.{rnd.randrange(30)}.{rnd.randrange(9999)}", n(rnd.randrange(7, 13)), f"{n(3)}-{n(rnd.randrange(5, 8))}-{n(2)}",
        f"978-{n(1)}-{n(2)}-{n(6)}-{n(1)}", f"978{n(10)}", wrong, rnd.choice(" -./").join(wrong[i : i + 4] for i in range(0, 16, 4)), f"{n(2)} {n(3)} {n(3)}", f"{n(3)},{n(3)},{n(3)}.{n(2)}", f"{n(4)}.{n(5)}",
    ]
    words = [f"stay at {rnd.choice(('home', 'night', 'work'))} dot {rnd.choice(('the', 'and', 'line'))}", f"look at this. {rnd.choice(('Then', 'Now', 'Here'))}", f"{n(2)} at {n(2)}. {n(2)}"]
    label = rnd.choice(("", "", "order ", "ref. ", "version ", "since ", "invoice no. ", "account ", "isbn ", "total "))
    return label + rnd.choice(plain if rnd.random() < 0.85 else words)


def valid(kind: str, s: str) -> bool:
    """Whether the kind's check, as far as it has one, lets a span be one."""
    d = digits_of(s)
    return luhn(d) if kind == "card" else all(int(g) <= 255 for g in _GROUP.findall(s)) if kind == "ip" else True


def labelled(text: str, most: int = 8) -> list[tuple[list[float], int]]:
    """Training rows of a document, from at most so many of its base spans."""
    base, out = base_spans(text), []
    rnd = random.Random(zlib.crc32(text.encode("utf-8", "replace")))
    for kind, lo, hi in candidates(text):
        if not any(lo < h and l < hi for _, l, h in base) and not valid(kind, text[lo:hi]):
            out.append((features(text, kind, lo, hi), 0))
    out = out[:most]

    def judged(left: str, span: str, right: str, kind: str | None) -> None:
        whole, at = left + span + right, len(left)
        for k, lo, hi in candidates(whole):
            if kind is None and not (at < hi and lo < at + len(span)):
                continue
            good = kind is not None and k == kind and lo == at and hi == at + len(span)
            # the same span without the plus or bracket in front is the same find
            near = kind == "phone" and k == kind and hi == at + len(span) and at < lo <= at + 2
            if good or not near:
                out.append((features(whole, k, lo, hi), int(good)))

    for kind, lo, hi in base[:most]:
        left, right = text[max(0, lo - 40) : lo], text[hi : hi + 20]
        for before, span, behind in forms(kind, text[lo:hi], rnd):
            judged(left + before, span, behind + right, kind)
        # as many look-alikes as forms, between words of the document
        for _ in range(6):
            at = text.find(" ", rnd.randrange(len(text))) + 1
            judged(text[max(0, at - 40) : at], lookalike(rnd), " " + text[at : at + 20], None)
    return out


@dataclass
class BoostedTrees:
    """Depth-limited regression trees on the logistic loss; splits at 31 quantiles of a feature, found from sums per bin."""

    rounds: int = 60
    depth: int = 4
    rate: float = 0.3
    trees: list = field(default_factory=list)
    bias: float = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.bias = float(np.log(p / (1 - p)))
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 33)[1:-1])) for j in range(x.shape[1])]
        bins = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
        score = np.full(len(y), self.bias)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(bins, y - p, p * (1 - p), np.arange(len(y)), cuts, self.depth)
            self.trees.append(tree)
            score += self._value(tree, x)
        return self

    def _grow(self, bins, g, h, rows, cuts, depth):
        g_, h_ = g[rows], h[rows]
        total_g, total_h = g_.sum(), h_.sum()
        best = (1e-6, None, None)
        for j in range(len(cuts)) if depth else ():
            b, n = bins[rows, j], len(cuts[j]) + 1
            many = np.cumsum(np.bincount(b, minlength=n))[:-1]
            gl, hl = (np.cumsum(np.bincount(b, weights=w, minlength=n))[:-1] for w in (g_, h_))
            gain = gl**2 / (hl + 1.0) + (total_g - gl) ** 2 / (total_h - hl + 1.0) - total_g**2 / (total_h + 1.0)
            gain[(many == 0) | (many == len(rows))] = 0
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), j, int(gain.argmax()))
        if best[1] is None:
            return self.rate * total_g / (total_h + 1.0)
        _, j, c = best
        left = bins[rows, j] <= c
        return j, cuts[j][c], self._grow(bins, g, h, rows[left], cuts, depth - 1), self._grow(bins, g, h, rows[~left], cuts, depth - 1)

    def _value(self, tree, x: np.ndarray) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        j, c, low, high = tree
        return np.where(x[:, j] <= c, self._value(low, x), self._value(high, x))

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.bias + sum((self._value(t, x) for t in self.trees), np.zeros(len(x)))


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (scores from which a level holds, share of positives there)."""
    pools: list[list[float]] = []  # lowest score, positives, rows
    for s, label in sorted(zip(score.tolist(), y.tolist(), strict=True)):
        if pools and pools[-1][0] == s:
            pools[-1][1] += label
            pools[-1][2] += 1
        else:
            pools.append([s, label, 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            s_, p_, n_ = pools.pop()
            pools[-1][1] += p_
            pools[-1][2] += n_
    return np.array([p[0] for p in pools]), np.array([p[1] / p[2] for p in pools])


def threshold(probability: np.ndarray, y: np.ndarray) -> float:
    """The lowest probability from which PRECISION of the rows are positive; 2 (never) without enough of them."""
    order = np.argsort(-probability, kind="stable")
    p, right = probability[order], np.cumsum(y[order])
    last = np.append(p[1:] != p[:-1], True) if len(p) else np.zeros(0, bool)
    fine = last & (right >= PRECISION * np.arange(1, len(p) + 1)) & (right >= LEAST_POSITIVES)
    return float(p[np.flatnonzero(fine)[-1]]) if fine.any() else 2.0


@dataclass
class Model:
    trees: BoostedTrees
    levels: dict[int, tuple[np.ndarray, np.ndarray]]
    thresholds: dict[int, float]

    def probability(self, x: np.ndarray) -> np.ndarray:
        score = self.trees.score(x)
        out = np.zeros(len(x))
        for kind, (at, level) in self.levels.items():
            mine = x[:, 0] == kind
            place = np.searchsorted(at, score[mine], "right") - 1
            # between two levels, the way from one to the other
            s, k = score[mine], np.maximum(place, 0)
            up = np.minimum(k + 1, len(at) - 1)
            part = np.where(up > k, (s - at[k]) / np.where(up > k, at[up] - at[k], 1), 0)
            out[mine] = np.where(place >= 0, level[k] + part * (level[up] - level[k]) * 0.5, 0.0)
        return out

    def chosen(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability, whether it reaches its kind's threshold)."""
        p = self.probability(x)
        return p, p >= np.array([self.thresholds.get(int(k), 2.0) for k in x[:, 0]])


def train(rows: list[tuple[list[float], int, bool]]) -> Model | None:
    """rows: features, label, whether it calibrates. None where a part lacks a class."""
    if not rows:
        return None
    x, y, held = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float), np.array([r[2] for r in rows], bool)
    if len(set(y[~held])) < 2 or not held.any():
        return None
    trees = BoostedTrees().fit(x[~held], y[~held])
    score = trees.score(x[held])
    kinds = x[held][:, 0]
    model = Model(trees, {int(k): isotonic(score[kinds == k], y[held][kinds == k]) for k in np.unique(kinds)}, {})
    p = model.probability(x[held])
    model.thresholds = {int(k): threshold(p[kinds == k], y[held][kinds == k]) for k in np.unique(kinds)}
    return model


#: Bytes before and after a written-out @ (see _WRITTEN).
_OPEN, _CLOSE = (np.isin(np.arange(256), list(signs)) for signs in (b" [({", b" ])}"))


def _suspects(part: pa.RecordBatch, column: str) -> np.ndarray:
    """Rows that can have any span or candidate: with a digit, an @, or an "at" in letters of any case between blanks or brackets."""
    flat, at, _ = string_parts(part.column(column))
    total = np.concatenate([[0], np.cumsum(((flat >= 48) & (flat <= 57)) | (flat == 64))])
    if len(flat) > 3:
        written = ((flat[1:-2] | 32) == 97) & ((flat[2:-1] | 32) == 116) & _OPEN[flat[:-3]] & _CLOSE[flat[3:]]
        total[4:] += np.cumsum(written)
    return np.flatnonzero(total[at[1:]] > total[at[:-1]])


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Model | None:
    n = docs.count()
    bound = min(1_000_000, 1_000_000 * SAMPLE_DOCUMENTS // max(1, n) + 1)
    sample = docs.select(key, text).where(F.pmod(F.xxhash64(F.col(key)), F.lit(1_000_000)) < bound)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, text):
                for i in _suspects(part, text).tolist():
                    rows = labelled(part.column(1)[i].as_py())
                    if rows:
                        keys = pa.array([part.column(0)[i].as_py()] * len(rows), part.column(0).type)
                        yield pa.RecordBatch.from_arrays([keys, pa.array(range(len(rows)), pa.int32()), pa.array([r[0] for r in rows], pa.list_(pa.float64())), pa.array([r[1] for r in rows], pa.int32())], names=["k", "i", "x", "y"])

    kind = dict(docs.dtypes)[key]
    rows = sample.mapInArrow(released(run), f"k {kind}, i int, x array<double>, y int").withColumn("h", F.xxhash64("k"))
    rows = rows.orderBy("h", "k", "i", "x").limit(SAMPLE_CANDIDATES)
    return train([(r["x"], r["y"], r["h"] % 4 == 3) for r in rows.collect()])


def find_spans(texts: list[str], model: Model | None) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    offered = [(i, k, lo, hi) for i, t in enumerate(texts) for k, lo, hi in candidates(t) if not any(lo < h and l < hi for _, l, h in base[i])] if model else []
    added: dict[int, list] = {}
    if offered:
        p, fine = model.chosen(np.array([features(texts[i], k, lo, hi) for i, k, lo, hi in offered]))
        best = lambda q, o: (-q, o[2] - o[3], o[2], KINDS.index(o[1]))
        for *_, (i, k, lo, hi) in sorted((*best(q, o), o) for q, f, o in zip(p.tolist(), fine.tolist(), offered, strict=True) if f):
            if not any(lo < h and l < hi for _, l, h in added.get(i, [])):
                added.setdefault(i, []).append((k, lo, hi))
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    return [(b, sorted(b + added.get(i, []), key=order)) for i, b in enumerate(base)]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{lo}:{hi}" for k, lo, hi in spans)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Replace each run of overlapping spans by the kind of its first one, like <EMAIL>."""
    out, at = [], 0
    for kind, lo, hi in spans:
        if lo >= at:
            out += [text[at:lo], f"<{kind.upper()}>"]
        at = max(at, hi)
    return "".join(out) + text[at:]


def detect(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, base and all spans (arrays of struct kind, start, end) and their joined texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, text):
                found = [([], [])] * part.num_rows
                at = _suspects(part, text).tolist()
                for i, f in zip(at, find_spans([part.column(1)[i].as_py() for i in at], shared.value), strict=True):
                    found[i] = f
                rows = lambda j: pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in f[j]] for f in found], span)
                yield pa.RecordBatch.from_arrays([part.column(0), rows(0), rows(1), pa.array([joined(f[0]) for f in found]), pa.array([joined(f[1]) for f in found])], names=[key, "base", "all", "base_text", "spans"])

    kind = dict(docs.dtypes)[key]
    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    return docs.select(key, text).mapInArrow(released(run), f"{key} {kind}, base {spans}, all {spans}, base_text string, spans string")


def redacted(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The documents, all columns kept, with every span of their text replaced; a null text stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"c{i}" for i in range(len(docs.columns))]  # any names pass, also such with dots
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, names[at]):
                hits = _suspects(part, names[at]).tolist()
                new = {}
                if hits:
                    own = [part.column(at)[i].as_py() for i in hits]
                    new = {i: redact(t, spans) for i, t, (_, spans) in zip(hits, own, find_spans(own, shared.value), strict=True) if spans}
                if new:
                    column = pa.array([new.get(i, x) for i, x in enumerate(part.column(at).to_pylist())], pa.string())
                    part = pa.RecordBatch.from_arrays([column if j == at else c for j, c in enumerate(part.columns)], names=names)
                yield part

    plain = docs.toDF(*names)
    return plain.mapInArrow(released(run), plain.schema).toDF(*docs.columns)


def _is(kind: str):
    return lambda s: s["kind"] == kind


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = detect(docs, fit(docs))
    count = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *count, F.sha2(F.col("base_text"), 256).alias("base_sha256"), "spans")


def digest(spans: list[tuple[str, int, int]]) -> str:
    """The contract's hash in Python, for tests."""
    return hashlib.sha256(joined(spans).encode()).hexdigest()
