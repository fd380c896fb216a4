"""Language identification by cross-parsing entropy.

For every language a suffix automaton of a bounded sample of labelled text is built. A text is parsed, per language, into the
longest phrases that occur in that language's sample; the language that needs the fewest phrases per letter wins.
Samples have the same length for all languages, so the counts compare without further weights.

The automata become transition tables, and all blocks of a batch of texts step through them in lockstep, one character
at a time. Texts longer than `BLOCK` characters are parsed in blocks (a phrase ends at a block's border), every block counts.

The pipeline's filter rejects texts that need many more phrases a character than labelled text does: `SLACK` times the rate
that all but a hundredth of the sample's unused documents stay under. Texts below `SHORT` characters are never rejected for that.

Edge cases: a null or empty text, or one without any letter, is `und` with score 0. A language needs a non-null label and
a letter in its sample; without any such row every text is `und`. Ties go to the smaller label. Rows are
judged one by one, so repeated rows get equal results; extra columns may have any names, also those of the results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from poiforge.llm.common import free_name, released, table

#: The sample that the automata are fit on: at most so many normalised characters of all languages together, of one language,
#: and of one document. Languages beyond the most frequent MAX_LANGUAGES would get less than a document each and aren't learned.
#: All samples are as long as the shortest one, but for languages with less than a quarter of their share, which don't shorten the others.
SAMPLE_TOTAL, SAMPLE_LANGUAGE, SAMPLE_DOCUMENT, MAX_LANGUAGES = 160_000, 32_000, 800, 200
#: Characters that a lane parses before it starts anew.
BLOCK = 1024
#: The filter's limit is SLACK times the rate of labelled text, MOST_PHRASES without any left to measure; shorter texts pass.
SLACK, MOST_PHRASES, SHORT = 1.8, 0.5, 24

_OTHER = 1  # class of letters that no sample has; 0 is a border (anything but a letter)


def normalise(text: str) -> str:
    """Lower-case letters, each run of anything else as one space."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the root."""
    step: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return step


class CrossParser:
    """Automata of all languages as one transition table over character classes."""

    def __init__(self, samples: dict[str, str]):
        """samples: normalised text by language."""
        self.languages = sorted(k for k, v in samples.items() if v.strip())
        letters = sorted({c for k in self.languages for c in samples[k]} - {" "})
        self.width = len(letters) + 2
        self.classes = {c: i + 2 for i, c in enumerate(letters)} | {" ": 0}
        tables, self.roots, at = [], [], 0
        for k in self.languages:
            steps = suffix_automaton(samples[k])
            t = np.full((len(steps), self.width), -1, np.int32)
            for state, edges in enumerate(steps):
                for c, to in edges.items():
                    t[state, self.classes[c]] = (to + at) * self.width
            tables.append(t)
            self.roots.append(at * self.width)
            at += len(steps)
        # a state is kept as the place where its row starts in the flat table; -1: no such phrase
        self.table = np.concatenate([*tables, np.full((1, self.width), -1, np.int32)]).ravel()
        self.dead = np.int32(at * self.width)  # the last row: the next character begins a phrase
        self.roots = np.array(self.roots, np.int32)
        self.lookup: np.ndarray | None = None
        #: phrases a character from which the filter takes a text for gibberish
        self.limit = MOST_PHRASES

    def measure(self, texts: dict[str, list[str]]) -> None:
        """Sets the limit by labelled texts that the automata weren't built from."""
        rates = []
        for k, own in texts.items():
            if k in self.languages and own:
                count, size = self.phrases(own)
                rates += (count[:, self.languages.index(k)] / np.maximum(size, 1))[size >= SHORT].tolist()
        if rates:
            self.limit = SLACK * float(np.quantile(rates, 0.99))

    def _class_of(self, points: np.ndarray) -> np.ndarray:
        if self.lookup is None:
            lookup = np.zeros(0x110000, np.uint8 if self.width < 256 else np.uint16)
            lookup[[c for c in range(0x110000) if chr(c).isalpha()]] = _OTHER
            for c, i in self.classes.items():
                if c != " ":
                    lookup[ord(c)] = i
            self.lookup = lookup
        return self.lookup[points]

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(phrases per text and language, normalised characters per text, 0 without a letter)."""
        n, k = len(texts), len(self.languages)
        count, size = np.zeros((n, k), np.int64), np.zeros(n, np.int64)
        points = [np.frombuffer(t.lower().encode("utf-32-le", "replace"), np.uint32) for t in texts]
        ends = np.cumsum([len(p) + 1 for p in points])
        flat = np.zeros(ends[-1] if n else 0, np.int32)
        for p, e in zip(points, ends, strict=True):
            flat[e - 1 - len(p) : e - 1] = self._class_of(p)
        owner = np.repeat(np.arange(n, dtype=np.int32), np.diff(ends, prepend=0))
        # runs of borders shrink to one; a text's leading and closing ones go
        first = np.zeros(len(flat), bool)
        first[np.concatenate([[0], ends[:-1]]).astype(np.int64)] = True
        previous = np.zeros(len(flat), np.int32)
        previous[1:] = flat[:-1]
        keep = (flat > 0) | ((previous > 0) & ~first)
        flat, owner = flat[keep], owner[keep]
        size = np.bincount(owner, minlength=n)
        if not len(flat) or not k:
            return count, np.maximum(size - 1, 0)
        begin = np.cumsum(size) - size
        blocks = -(-size // BLOCK)
        lane_owner = np.repeat(np.arange(n), blocks)
        nth = np.arange(len(lane_owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        lo = begin[lane_owner] + nth * BLOCK
        length = np.minimum(BLOCK, size[lane_owner] - nth * BLOCK)
        order = np.argsort(-length, kind="stable")
        lo, length, lane_owner = lo[order], length[order], lane_owner[order]
        state = np.full((len(lo), k), self.dead)
        lane_count = np.zeros((len(lo), k), np.int32)
        alive = np.searchsorted(-length, -np.arange(int(length[0])), "left")  # lanes longer than i come first
        for i in range(int(length[0])):
            m = alive[i]
            c = flat[lo[:m] + i][:, None]
            to = self.table[state[:m] + c]
            lost = to < 0
            lane_count[:m] += lost
            again = self.table[self.roots + c]
            state[:m] = np.where(lost, np.where(again < 0, self.dead, again), to)
        np.add.at(count, lane_owner, lane_count)
        return count, np.maximum(size - 1, 0)  # without the closing border


def fit(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id") -> CrossParser:
    """Automata of a bounded sample of the labelled rows: per language the documents of smallest hashed key, each up to
    SAMPLE_DOCUMENT characters, until SAMPLE_LANGUAGE characters (or an equal share of SAMPLE_TOTAL) are reached."""
    counts = docs.where(F.col(label).isNotNull()).groupBy(label).count().orderBy(F.desc("count"), label).limit(MAX_LANGUAGES).collect()
    share = min(SAMPLE_LANGUAGE, SAMPLE_TOTAL // max(1, len(counts)))
    most = 4 * share // SAMPLE_DOCUMENT + 1
    # hashed keys under a language's bound let about 4 * most rows through, however many it has; no reducer gets more
    bound = F.lit(0)
    for k, n in counts:
        bound = F.when(F.col(label) == k, F.lit(min(1_000_000, 4_000_000 * most // n + 1))).otherwise(bound)
    few = Window.partitionBy(label).orderBy("_h", key)
    rows = docs.withColumn("_h", F.xxhash64(F.col(key))).where(F.pmod(F.col("_h"), F.lit(1_000_000)) < bound)
    picked = rows.select(label, key, "_h", F.substring(text, 1, 2 * SAMPLE_DOCUMENT).alias("_t")).where(F.length("_t") > 0).withColumn("_n", F.row_number().over(few)).where(F.col("_n") <= most)
    samples: dict[str, str] = {}
    rest: dict[str, list[str]] = {}
    for r in sorted(picked.collect(), key=lambda r: (r[label], r["_n"])):
        have = samples.get(r[label], "")
        if len(have) < share:
            samples[r[label]] = (have + " " + normalise(r["_t"])[:SAMPLE_DOCUMENT])[:share]
        else:
            rest.setdefault(r[label], []).append(r["_t"][:SAMPLE_DOCUMENT])
    least = min((len(s) for s in samples.values() if s.strip()), default=0)
    parser = CrossParser({k: s[: max(least, share // 4)] for k, s in samples.items()})
    parser.measure(rest)
    return parser


def result_names(kept: list[str]) -> list[str]:
    return [free_name(c, kept) for c in ("lang_pred", "score", "phrase_rate")]


def identify(docs: DataFrame, parser: CrossParser, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default: all) with lang_pred, score and phrase_rate, lengthened by underscores where a kept column has the name: score (1 - best / second-best phrase count; 1 with one language),
    phrase_rate (phrases per normalised character under the winner; null for `und`)."""
    keep = docs.columns if keep is None else keep
    results = result_names(keep)
    plain = [f"c{i}" for i in range(len(keep))]  # any names pass, also such with dots
    source = docs.select(*(F.col(f"`{c}`").alias(p) for c, p in zip(keep, plain, strict=True)), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(parser)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from poiforge.llm.common import blocks

        p: CrossParser = shared.value
        names = np.array([*p.languages, "und"], object)
        for batch in batches:
            for part in blocks(batch, "text", 3 << 19):
                count, size = p.phrases([t or "" for t in part.column(len(keep)).to_pylist()])
                if p.languages:
                    best = count.argmin(1)
                    fewest = count.min(1)
                    second = np.partition(count, 1, axis=1)[:, 1] if count.shape[1] > 1 else np.full(len(best), np.inf)
                    score = 1 - fewest / np.maximum(second, 1)
                else:
                    best, fewest, score = np.zeros(len(size), int), np.zeros(len(size)), np.zeros(len(size))
                none = (size == 0) | (not p.languages)
                best = np.where(none, len(p.languages), best)
                rate = np.where(none, np.nan, fewest / np.maximum(size, 1))
                extra = [pa.array(names[best], pa.string()), pa.array(np.where(none, 0.0, score)), pa.array(rate, from_pandas=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *extra], names=[*plain, "lang", "score", "rate"])

    kinds = dict(docs.dtypes)
    schema = ", ".join([f"{p} {kinds[c]}" for c, p in zip(keep, plain, strict=True)] + ["lang string, score double, rate double"])
    return source.mapInArrow(released(run), schema).toDF(*keep, *results)


def held_out(key: str = "doc_id") -> F.Column:
    return F.crc32(F.col(key).cast("string")) % 4 == 2


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    parser = fit(docs.where(~F.coalesce(held_out(), F.lit(False))))
    found = identify(docs.select("doc_id", "text"), parser, keep=["doc_id"])
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "phrase_rate")


def keep_languages(docs: DataFrame, parser: CrossParser) -> DataFrame:
    """The rows with a language: some letter, and phrases that aren't gibberish for the winner. Columns stay, whatever their names."""
    lang, _, rate = result_names(docs.columns)
    found = identify(docs, parser)
    short = F.length("text") < SHORT
    return found.where((F.col(lang) != "und") & (short | (F.col(rate) <= parser.limit))).select(*(F.col(f"`{c}`") for c in docs.columns))


def crc_mod(key: int) -> int:
    """The contract's remainder in Python, for tests."""
    return zlib.crc32(str(key).encode()) % 4
