"""SentencePiece encoding by sampling distinct segmentations, and decoding.

All segmentations of a text into pieces form a lattice, with weights from the public model's piece ranks. Adding Gumbel noise to the
log-probability of every whole path and taking the k largest draws k distinct segmentations without replacement. The search
is top-down (A-star over regions of the lattice): a region is a prefix with some arcs excluded; its bound is the exact largest
perturbed value in it, drawn from a Gumbel truncated by its parent's. Following the arcs by their conditional probabilities keeps a
region's largest value, and every decision on the way leaves behind the region of its other arcs. The best region is opened
next. With kappa the best value left, a segmentation's inclusion score is the probability of beating kappa:
log(1 - exp(-exp(log p - kappa))).

Exact conditional probabilities come from backward sums over the lattice. Pieces have blanks only at their beginning, so the lattice
falls apart at blanks; backward sums are taken once per distinct word of a block, and all words of a block are walked in lockstep. The
noise is a hash of the row's key and the decision's place, so a row's samples don't depend on partitions, batches or retries.

Texts are encoded as the model does: a blank goes in front, blanks become U+2581, a character without a piece becomes its
UTF-8 bytes; so does a text's own U+2581, which makes decoding exact for every text.

Edge cases: a null or empty text has one segmentation, without pieces. A text with fewer than k segmentations
gives all of them. Rows are encoded one by one, so equal keys and texts give equal samples; a null key is a key of its own;
extra columns can be kept, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poiforge.llm.common import blocks, mix64, Powers, released, table

SAMPLES = 2
#: Piece weights are (rank + ZIPF) ** -SHARPNESS, ranks by the model's scores.
ZIPF, SHARPNESS = 10.0, 1.0
BLANK = 0x2581
#: Stands for a text's own U+2581, beyond all characters, so that no piece has it.
PLAIN = 0x110000
MOST = 16  # characters of the longest piece
ROWS = 1 << 16  # arc rows that are looked at together
#: Bytes of text that are sampled together; they set a worker's memory (about 100 times as much).
TEXT = 3 << 18
_POW = Powers(0x8CB92BA72F3D8DD7)
_PHI = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 19  # bits


class Pieces:
    """The vocabulary, hashed for vectorised lookup."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.byte = np.full(256, -1, np.int32)
        texts: dict[str, int] = {}
        out: list[bytes] = [b""] * n
        weight = np.full(n, -np.inf)
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                out[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                texts[piece] = i
                out[i] = piece.replace(chr(BLANK), " ").encode()
                weight[i] = -SHARPNESS * np.log(min(-sp.get_score(i), n) + ZIPF)
        # id n: a character without a piece, as its bytes; the last entry, id -1: no arc
        self.weight = np.concatenate([weight, [-SHARPNESS * np.log(n) - 10.0, -np.inf]])
        self.none = n
        self.length = np.fromiter(map(len, out), np.int64, n)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(out), np.uint8)
        # a tree of the beginnings of pieces; node 0 is its root, and stands for none where a node is looked for
        texts |= dict.fromkeys({t[:i] for t in texts for i in range(1, len(t))} - texts.keys(), -1)
        node = {t: i for i, t in enumerate(["", *texts])}
        self.id = np.array([-1, *texts.values()], np.int32)
        up = np.fromiter((node[t[:-1]] for t in texts), np.int64, len(texts))
        last = np.fromiter((ord(t[-1]) for t in texts), np.int64, len(texts))
        self.edge = np.concatenate([[-1], up << 21 | last])  # into each node, from its parent by a character
        self.more = np.zeros(len(node), bool)
        self.more[up] = True
        self.first = np.zeros(PLAIN + 1, np.int32)
        self.first[last[up == 0]] = np.flatnonzero(up == 0) + 1
        slot = self._slot(self.edge)
        self.ways: list[np.ndarray] = []
        left = np.flatnonzero(up) + 1
        while len(left):
            way = np.zeros(1 << _SLOTS, np.int32)
            way[slot[left]] = left  # the last one of a slot stays, the others go to the next way
            self.ways.append(way)
            left = left[way[slot[left]] != left]

    @staticmethod
    def _slot(edge: np.ndarray) -> np.ndarray:
        return (edge.view(np.uint64) * _PHI >> np.uint64(64 - _SLOTS)).view(np.int64)

    def step(self, node: np.ndarray, point: np.ndarray) -> np.ndarray:
        """The node to which a character leads from each node, 0: none."""
        edge = node.astype(np.int64) << 21 | point
        slot = self._slot(edge)
        found = self.ways[0].take(slot)
        open_ = np.flatnonzero(self.edge.take(found) != edge)
        for way in self.ways[1:]:
            open_ = open_.take(np.flatnonzero(found.take(open_)))  # an empty slot ends the search
            found[open_] = other = way.take(slot.take(open_))
            open_ = open_.take(np.flatnonzero(self.edge.take(other) != edge.take(open_)))
        found[open_] = 0
        return found


def prefix_hash(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = _POW.get(len(points) + 1)
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(mix64(points.astype(np.uint64) + _PHI) * up[: len(points)], out=total[1:])
    return total, down


class Lattice:
    """Distinct words of a block: piece ids and conditional probabilities of the arcs, per place and length."""

    def __init__(self, pieces: Pieces, points: np.ndarray, start: np.ndarray, size: np.ndarray):
        """points: all characters; start, size: words, which have no blank but at their beginning."""
        total, down = prefix_hash(points)
        key = mix64((total[start + size] - total[start]) * down[start] + size.astype(np.uint64))
        _, first, self.word = np.unique(key, return_index=True, return_inverse=True)
        lo, n = start[first], size[first]
        self.begin = np.cumsum(n) - n  # of each distinct word in `own`
        self.size = n
        own = np.repeat(lo - self.begin, n) + np.arange(int(n.sum()))
        self.points = points[own]
        left = np.repeat(self.begin + n, n) - np.arange(len(own))
        self.ids = np.full((len(own), MOST), -1, np.int16 if pieces.none < 2**15 else np.int32)
        self.far = np.zeros(len(own), bool)  # places with a long arc
        arcs = np.zeros(len(own), np.int8)
        code = self.points.astype(np.int64)
        node = pieces.first.take(code)
        at = np.flatnonzero(node)
        node = node.take(at)
        for length in range(1, MOST + 1):
            self.ids.ravel()[at * MOST + (length - 1)] = found = pieces.id.take(node)
            arcs[at] += found >= 0
            if length > MOST // 2:
                self.far[at] |= found >= 0
            on = np.flatnonzero(pieces.more.take(node) & (left.take(at) > length))
            if not len(on):
                break
            at = at.take(on)
            node = pieces.step(node.take(on), code.take(at + length))
            on = np.flatnonzero(node)
            at, node = at.take(on), node.take(on)
        bare = np.flatnonzero(self.ids[:, 0] < 0)
        self.rest = np.where(arcs + (self.ids[:, 0] < 0) > 1, np.nan, 0.0)  # of an arc that all but exhausts its place, the others together: 0 for a lone arc, nan for what is not yet known
        one = self.points[bare] < 128
        self.bytes = not one.all()  # whether any character has no piece and more than one byte
        self.ids[bare, 0] = np.where(one, pieces.byte[np.minimum(self.points[bare], 255)], pieces.none)
        weight = pieces.weight.copy()
        weight[pieces.byte[:128]] = weight[pieces.none]
        self.prob = np.zeros((len(own), MOST), np.float32)
        # backward sums scaled by a constant per character, which cancels; words that leave the range are done again by logarithms
        with np.errstate(under="ignore", over="ignore", invalid="ignore", divide="ignore"):
            sums = self._backward(weight, self.begin + n, n, np.argsort(-n, kind="stable"), False)
        odd = np.flatnonzero(~((sums > 1e-280) & (sums < 1e280)))
        if len(odd):
            self._backward(weight, self.begin + n, n, odd[np.argsort(-n[odd], kind="stable")], True)
        self.running = self.prob[:, : MOST // 2].copy()  # once a place, however many walks come by
        for k in range(1, MOST // 2):
            self.running[:, k] += self.running[:, k - 1]

    def _backward(self, weight: np.ndarray, end: np.ndarray, n: np.ndarray, order: np.ndarray, logs: bool) -> np.ndarray:
        """Fill the arcs' conditional probabilities of the words in `order` (longest first); the sums at their beginnings."""
        beta = np.zeros(len(self.points) + MOST + 1)
        longest, span = -n[order], np.arange(1, MOST + 1)
        scaled = weight if logs else np.exp(weight)
        grow = np.exp(2.0 * span)
        half = MOST // 2
        row = np.dtype((np.void, 4 * half))
        rows = self.prob[:, :half].view(row)[:, 0]
        for d in range(1, int(-longest[0] if len(longest) else 0) + 1):
            every = end[order[: np.searchsorted(longest, -d, "right")]] - d
            long = self.far[every] if d > half else np.zeros(len(every), bool)
            # few places have arcs of more than half the length
            for at, k in ((every[~long], min(d, half)), (every[long], min(d, MOST))):
                if not len(at):
                    continue
                x = scaled.take(self.ids.take(at, axis=0)[:, :k], mode="wrap")
                after = beta.take(at[:, None] + span[:k])
                if d <= k:  # a word's own end, whatever stands there in the next word
                    after[:, d - 1] = 0.0 if logs else 1.0
                if logs:
                    x = x + after
                    top = x.max(1)
                    x = np.exp(x - top[:, None])
                    total = x.sum(1)
                    beta[at] = np.log(total) + top
                else:
                    x *= after
                    x *= grow[:k]
                    total = np.einsum("ij->i", x)  # row by row, whatever the other rows
                    beta[at] = total
                x /= total[:, None]
                if k <= half:  # rows of a fixed size are moved as one value
                    wide = np.zeros((len(at), half), np.float32)
                    wide[:, :k] = x
                    rows[at] = wide.view(row)[:, 0]
                else:
                    self.prob[at, :k] = x
        first = np.zeros(len(end))
        first[order] = beta[(end - n)[order]]
        return first

    def _pick(self, place: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The first arc at which the running sum of probabilities exceeds u; most are among the short ones."""
        below = self.running.take(place, axis=0) <= u[:, None]  # eight flags, counted as one word
        arc = np.bitwise_count(below.view(np.uint64).ravel()).astype(np.int64)
        far = np.flatnonzero(arc == MOST // 2)
        arc[far] = (np.cumsum(self.prob[place[far]], axis=1) <= u[far, None]).sum(1)
        return arc

    def walk(self, noise: np.ndarray, place: np.ndarray, end: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Follow arcs by their probabilities from each place to its word's end, all at once.

        noise: a hash per walk, step: decisions already made in its word. Returns (walk, place, arc) in the order of walks."""
        active = np.flatnonzero(place < end)
        place, begun, step = place.copy(), step, step.copy()
        logs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(active):
            p, s = place[active], step[active]
            u = uniform(noise[active] + s.astype(np.uint64) * _PHI)
            arc = np.concatenate([self._pick(p[i : i + ROWS], u[i : i + ROWS].astype(np.float32)) for i in range(0, len(p), ROWS)])
            if (bad := np.flatnonzero(arc >= MOST)).size:  # rounding: the likeliest
                arc[bad] = self.prob[p[bad]].argmax(1)
            logs.append((active, p, arc))
            place[active] = p + arc + 1
            step[active] = s + 1
            active = active[place[active] < end[active]]
        steps = step - begun
        first = np.cumsum(steps) - steps
        walk = np.repeat(np.arange(len(steps)), steps)
        at, arcs = np.empty(len(walk), np.int64), np.empty(len(walk), np.int64)
        for n, (active, p, arc) in enumerate(logs):
            to = first[active] + n
            at[to], arcs[to] = p, arc
        return walk, at, arcs

    def log_probability(self, place: np.ndarray, arc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the arcs taken, and of all other arcs together."""
        p = self.prob.take(place * MOST + arc).astype(np.float64)
        rest = 1 - p
        near = np.flatnonzero(p > 0.9999)
        at = place.take(near)
        new = near.take(np.flatnonzero(np.isnan(self.rest.take(at))))
        last = np.empty(len(self.rest), np.int32)
        last[place.take(new)] = np.arange(len(new))
        new = new.take(np.flatnonzero(last.take(place.take(new)) == np.arange(len(new))))  # every place once
        for i in range(0, len(new), ROWS):
            some = new[i : i + ROWS]
            row = self.prob.take(place[some], axis=0).astype(np.float64)
            row[np.arange(len(some)), arc[some]] = 0
            self.rest[place[some]] = row.sum(1)
        rest[near] = self.rest.take(at)
        with np.errstate(divide="ignore"):
            return np.log(p), np.log(rest)


def uniform(x: np.ndarray) -> np.ndarray:
    """Hashes to numbers inside (0, 1)."""
    return ((mix64(x) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def gumbel(x: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(uniform(x)))


def truncated(noise: np.ndarray, location: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Gumbel at the location given that it is below the bound."""
    return -np.logaddexp(-bound, -(location + noise))


class Path:
    """A segmentation of one text: decisions (word number, place, arc), their conditional log-probabilities and those of the other arcs,
    the log-probability before each, and the perturbed values of the regions that the decisions from its start on left behind. These values
    are below `value` as truncation leaves them in their order; only the largest is truncated."""

    def __init__(self, word, place, arc, own, other, before, regions, value):
        self.word, self.place, self.arc, self.own, self.other, self.before, self.regions, self.value = word, place, arc, own, other, before, regions, value
        self.log_p = float(own.sum())

    def best(self) -> tuple[float, int]:
        """The bound of the best region, and its decision."""
        if not len(self.regions):
            return -np.inf, 0
        i = int(self.regions.argmax())
        free = self.regions[i]
        return (-float(np.logaddexp(-self.value, -free)) if np.isfinite(free) else -np.inf), i


def sample_block(pieces: Pieces, texts: list[str], seeds: np.ndarray, samples: int) -> list[list[tuple[np.ndarray, float, float]]]:
    """Per text its samples, best first: (ids, log-probability, log inclusion score)."""
    chars = [np.frombuffer((" " + t if t else "").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    at = np.concatenate([[0], np.cumsum([len(c) for c in chars])]).astype(np.int64)
    points = np.concatenate(chars) if chars else np.zeros(0, np.uint32)
    points = np.where(points == 0x20, np.uint32(BLANK), np.where(points == BLANK, np.uint32(PLAIN), points))
    blank = points == BLANK
    begin = np.ones(len(points), bool)
    begin[1:] = blank[1:] & ~blank[:-1]
    begin[at[:-1][at[:-1] < len(points)]] = True
    start = np.flatnonzero(begin)
    size = np.diff(np.append(start, len(points)))
    first = np.searchsorted(start, at)  # words of each text
    lattice = Lattice(pieces, points, start, size)
    entry, stop = lattice.begin[lattice.word], (lattice.begin + lattice.size)[lattice.word]
    text_of = np.repeat(np.arange(len(texts)), np.diff(first))
    ordinal = (np.arange(len(start)) - first[:-1][text_of]).astype(np.uint64)
    seeds = mix64(seeds.view(np.uint64) ^ _PHI)

    def noises(which: np.ndarray, turn: int) -> np.ndarray:
        return mix64(seeds[text_of[which]] + mix64((ordinal[which] << np.uint64(8)) + np.uint64(turn + 1)))

    def hashes(of: np.ndarray, *what: int | np.ndarray) -> np.ndarray:
        x = seeds[of]
        for w in what:
            x = mix64(x + np.atleast_1d(w).astype(np.uint64) * _PHI + _PHI)
        return x

    def paths(owners: np.ndarray, cut: np.ndarray, turn: int, word, place, arc, own, other, value: np.ndarray, begun: np.ndarray) -> list[Path]:
        """Paths of the texts `owners`, laid end to end; value: their perturbed values, begun: the first decision of their own."""
        sizes = np.diff(cut)
        nth = np.arange(cut[-1]) - np.repeat(cut[:-1], sizes)
        total = np.concatenate([[0.0], np.cumsum(own)])
        before = total[:-1] - np.repeat(total[cut[:-1]], sizes)
        some = np.isfinite(other) & (nth >= np.repeat(begun, sizes))
        free = np.full(len(own), -np.inf)
        noise = gumbel(np.repeat(mix64(seeds[owners] + np.array([turn + 77], np.uint64) * _PHI), sizes)[some] + nth[some].astype(np.uint64) * _PHI)
        free[some] = (before + other)[some] + noise
        return [Path(*(x[a:b] for x in (word, place, arc, own, other, before, free)), v) for a, b, v in zip(cut[:-1].tolist(), cut[1:].tolist(), value.tolist(), strict=True)]

    walks = np.arange(len(start))
    walk, place, arc = lattice.walk(noises(walks, 0), entry, stop, np.zeros(len(start), np.int64))
    everyone = np.arange(len(texts))
    cut = np.searchsorted(text_of[walk], np.arange(len(texts) + 1))
    found = [[p] for p in paths(everyone, cut, 0, walk, place, arc, *lattice.log_probability(place, arc), gumbel(mix64(seeds + _PHI)), np.zeros(len(texts), np.int64))]
    # regions that were opened before: (bound, path, decision, arcs excluded), beside the paths' own
    rest: list[list[tuple[float, int, int, frozenset]]] = [[] for _ in texts]
    kappa = np.full(len(texts), -np.inf)
    for turn in range(1, samples + 1):
        opened: list[tuple[int, Path, int, int, float]] = []
        chosen_regions: list[tuple[int, tuple]] = []
        for t, mine in enumerate(found):
            if len(mine) < turn:
                continue
            (bound, i), k = max(((p.best(), k) for k, p in enumerate(mine)), key=lambda b: b[0][0])
            best = (bound, k, i, frozenset(mine[k].arc[i : i + 1].tolist()))
            best = max([best, *rest[t]], key=lambda r: r[0])
            kappa[t] = best[0]
            if turn < samples and np.isfinite(best[0]):
                chosen_regions.append((t, best))
        of, decision = np.array([t for t, _ in chosen_regions], np.int64), np.array([b[2] for _, b in chosen_regions], np.int64)
        draws, falls = uniform(hashes(of, turn, 5, decision)).tolist(), gumbel(hashes(of, turn, 9, decision))
        for n, (t, best) in enumerate(chosen_regions):
            value, k, i, out = best
            parent = found[t][k]
            if best in rest[t]:
                rest[t].remove(best)
            else:
                parent.regions[i] = -np.inf
            arcs = lattice.prob[parent.place[i]].astype(np.float64)
            arcs[list(out)] = 0
            running = np.cumsum(arcs)
            chosen = int(np.searchsorted(running, draws[n] * running[-1], "right"))
            chosen = min(chosen, int(np.flatnonzero(arcs > 0)[-1]))
            arcs[chosen] = 0
            if arcs.sum() > 0:  # what is left at this decision
                location = parent.before[i] + np.log(arcs.sum())
                bound = truncated(falls[n : n + 1], np.array([location]), np.array([value]))[0]
                rest[t].append((float(bound), k, i, out | {chosen}))
            opened.append((t, parent, i, chosen, value))
        if turn == samples or not opened:
            break
        which, entries, steps, owner = [], [], [], []
        for n, (t, parent, i, chosen, _) in enumerate(opened):
            w = int(parent.word[i])
            later = np.arange(w, first[t + 1])
            e = entry[later].copy()
            e[0] = int(parent.place[i]) + chosen + 1
            s = np.zeros(len(later), np.int64)
            s[0] = i - int(np.searchsorted(parent.word, w)) + 1
            which.append(later)
            entries.append(e)
            steps.append(s)
            owner.append(np.full(len(later), n))
        which, entries, steps, owner = map(np.concatenate, (which, entries, steps, owner))
        walk, place, arc = lattice.walk(noises(which, turn), entries, stop[which], steps)
        cut = np.searchsorted(owner[walk], np.arange(len(opened) + 1))
        own, other = lattice.log_probability(place, arc)
        at_own, at_other = lattice.log_probability(np.array([int(p.place[i]) for _, p, i, _, _ in opened]), np.array([c for _, _, _, c, _ in opened]))
        parts: list[list[np.ndarray]] = [[], [], [], [], []]
        for n, (_, parent, i, chosen, _) in enumerate(opened):
            s = slice(cut[n], cut[n + 1])
            parts[0] += [parent.word[: i + 1], which[walk[s]]]
            parts[1] += [parent.place[: i + 1], place[s]]
            parts[2] += [parent.arc[:i], np.array([chosen]), arc[s]]
            parts[3] += [parent.own[:i], at_own[n : n + 1], own[s]]
            parts[4] += [parent.other[:i], at_other[n : n + 1], other[s]]
        sizes = [i + 1 + int(cut[n + 1] - cut[n]) for n, (_, _, i, _, _) in enumerate(opened)]
        owners = np.array([t for t, *_ in opened])
        fresh = paths(owners, np.concatenate([[0], np.cumsum(sizes)]), turn, *map(np.concatenate, parts), np.array([v for *_, v in opened]), np.array([i + 1 for _, _, i, _, _ in opened]))
        for t, path in zip(owners.tolist(), fresh, strict=True):
            found[t].append(path)
    out = []
    for t, mine_ in enumerate(found):
        mine = []
        for p in mine_:
            ids = lattice.ids.take(p.place * MOST + p.arc).astype(np.int32)
            if lattice.bytes and (ids == pieces.none).any():
                ids = _with_bytes(pieces, ids, lattice.points[p.place])
            mine.append((ids, p.log_p, log_inclusion(p.log_p, float(kappa[t]))))
        out.append(mine)
    return out


def _with_bytes(pieces: Pieces, ids: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Put the UTF-8 bytes of each character without a piece in its place."""
    out, last = [], 0
    for i in np.flatnonzero(ids == pieces.none).tolist():
        character = chr(BLANK if points[i] == PLAIN else int(points[i]))
        out += [ids[last:i], pieces.byte[np.frombuffer(character.encode("utf-8", "replace"), np.uint8)]]
        last = i + 1
    return np.concatenate([*out, ids[last:]]).astype(np.int32)


def log_inclusion(log_p: float, kappa: float) -> float:
    """log(1 - exp(-exp(log_p - kappa))): 0 where nothing is left out."""
    if kappa == -np.inf:
        return 0.0
    d = log_p - kappa
    return float(d) if d < -30 else float(np.log(-np.expm1(-np.exp(min(d, 50.0)))))


def decode_block(pieces: Pieces, ids: list[np.ndarray]) -> list[str]:
    """Texts of id sequences; control ids have no text, a blank in front is dropped."""
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    length = pieces.length[flat]
    total = np.concatenate([[0], np.cumsum(length)])
    data = pieces.bytes[np.repeat(pieces.start[flat] - total[:-1], length) + np.arange(total[-1])].tobytes()
    cut = total[np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)]
    texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
    return [t[1:] if t.startswith(" ") else t for t in texts]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Pieces:
    return Pieces(path)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, samples: int = SAMPLES, key: str = "doc_id", text: str = "text", model: str | None = None, decoded: bool = False) -> DataFrame:
    """A row per sample: key, sample (from 1, best first), ids (little-endian unsigned 32-bit), log_p, log_inclusion; and, if asked, the
    text that decoding the ids gives, in the same pass."""
    path = model or default_model()
    source = docs.select(F.col(key), F.xxhash64(key).alias("_seed"), F.coalesce(text, F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = vocabulary(path)
        for batch in batches:
            for part in blocks(batch, "_text", TEXT):
                found = sample_block(p, part.column(2).to_pylist(), np.asarray(part.column(1)), samples)
                at = np.repeat(np.arange(len(found)), [len(f) for f in found])
                rows = [r for f in found for r in f]
                cols = [pa.array([n + 1 for f in found for n in range(len(f))], pa.int32()), pa.array([r[0].astype("<u4").tobytes() for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.float64())]
                names = [key, "sample", "ids", "log_p", "log_inclusion"]
                if decoded:
                    cols.append(pa.array(decode_block(p, [r[0].astype(np.int64) for r in rows]), pa.string()))
                    names.append("text")
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at)), *cols], names=names)

    kind = dict(docs.dtypes)[key]
    return source.mapInArrow(released(run), f"{key} {kind}, sample int, ids binary, log_p double, log_inclusion double" + ", text string" * decoded)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """The rows with `ids` replaced by `text`."""
    path, names = model or default_model(), encoded.columns
    at = names.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = vocabulary(path)
        for batch in batches:
            for part in blocks(batch, "ids", TEXT):
                texts = decode_block(p, [np.frombuffer(x, "<u4").astype(np.int64) for x in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns[:at], pa.array(texts, pa.string()), *part.columns[at + 1 :]], names=[n if n != "ids" else "text" for n in names])

    schema = ", ".join(f"`{c}` {t}" if c != "ids" else "text string" for c, t in encoded.dtypes)
    return encoded.mapInArrow(released(run), schema)


def op4_piece_sampling(spark: SparkSession, sf_dir: str, samples: int = SAMPLES) -> DataFrame:
    """Per document and sample: doc_id, sample, n_pieces, ids_crc32, log_p, log_inclusion, text_sha256 (of the decoded ids)."""
    rows = encode(table(spark, sf_dir, "documents"), samples, decoded=True)
    digest = rows.withColumn("n_pieces", (F.length("ids") / 4).cast("long")).withColumn("ids_crc32", F.crc32("ids"))
    return digest.select("doc_id", "sample", "n_pieces", "ids_crc32", "log_p", "log_inclusion", F.sha2("text", 256).alias("text_sha256"))
