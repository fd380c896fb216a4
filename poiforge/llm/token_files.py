"""Token-id files with a minimal perfect hash index.

File format, one shard per range of document keys, keys ascending within and across shards:

* ``ids-K.bin``: 32-byte header (magic ``PFIDS001``, then little-endian u64 id width in bytes, documents, ids), then the ids
  of all documents end to end, little-endian, 2 bytes each where the vocabulary fits, else 4.
* ``ids-K.idx``: magic ``PFIDX002`` and the byte lengths of eight sections (little-endian u64), then the sections: the minimal perfect hash
  of the shard's keys (sizes of its levels, first word of each, bit words, and the rank of each word), per slot the key's fingerprint (u32),
  first document and number of documents, and the documents' start offsets (documents + 1, u64).

A key hashes to one slot in constant time; the slot's fingerprint rejects keys that were never stored (but for one in
2**32); its document numbers give the payload range. Shards are found from the manifest. A single lookup reads a few words of the index by
their places, whatever its size; only bulk lookups load it.

Writing is repeatable: a task writes under a name of its own and renames, so a lost or doubled task leaves one whole file.

Edge cases: a null or empty text has only the end id. Rows with a null key come first, under the key -2**63, and are returned with a
null key. Repeated keys are stored one after another (by the hash of their texts), over several shards if they are many; a lookup
returns all of a shard's. Extra columns are ignored. An empty table writes no shard and returns no rows.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poiforge.llm.common import blocks, mix64, new_path, released, stored, table

MAGIC, INDEX_MAGIC = b"PFIDS001", b"PFIDX002"
HEADER = 32
#: Sections of an index, with their types.
SECTIONS = (("sizes", "<i8"), ("base", "<i8"), ("words", "<u8"), ("rank", "<i8"), ("fingerprint", "<u4"), ("first", "<i8"), ("count", "<i8"), ("starts", "<u8"))
#: The key that stands for null, and bytes of a shard's texts at most, about (as Spark estimates them), with as many shards as shuffle partitions at least.
NO_KEY, SHARD_BYTES = -(2**63), 512 << 20
#: Entries of the word -> ids cache of a Python worker; it is emptied when full.
CACHE_WORDS = 800_000


#: Letters whose case and composition any Unicode library treats alike, then signs that start no contraction or special token.
_LETTERS = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!\"#$%&()*,./:;=?@^_`{}~-]*)")


class MinimalPerfectHash:
    """Levels of bit sets: a key rests on the first level where no other key falls on its bit; its slot is the rank of that bit."""

    GAMMA = 2.0

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.base = np.concatenate([[0], np.cumsum((sizes + 63) // 64)]).astype(np.int64)
        ones = np.bitwise_count(words).astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(ones)])

    @staticmethod
    def _hash(keys: np.ndarray, level: int) -> np.ndarray:
        return mix64(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64))

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalPerfectHash:
        """keys: distinct u64."""
        sizes, words, left = [], [np.zeros(0, np.uint64)], keys
        while len(left):
            size = max(64, int(cls.GAMMA * len(left)))
            at = (cls._hash(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            once = np.bincount(at, minlength=size) == 1
            bits = np.zeros((size + 63) // 64 * 64, np.uint8)
            bits[:size] = once
            words.append(np.packbits(bits, bitorder="little").view(np.uint64))
            sizes.append(size)
            left = left[~once[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(words))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level has its bit."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = (self._hash(keys[left], level) % np.uint64(size)).astype(np.int64)
            word = self.base[level] + (at >> 6)
            bit = (at & 63).astype(np.uint64)
            on = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[on]] = (self.rank[word] + np.bitwise_count(below))[on]
            left = left[~on]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys ^ np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)).astype(np.uint32)


def build_index(keys: np.ndarray, starts: np.ndarray) -> bytes:
    """keys: ascending int64, one per document, repeats allowed."""
    distinct, first, count = np.unique(keys.astype(np.int64), return_index=True, return_counts=True)
    distinct = distinct.view(np.uint64)
    mph = MinimalPerfectHash.build(distinct)
    slot = mph.slots(distinct)
    put = np.argsort(slot)
    parts = {"sizes": mph.sizes, "base": mph.base, "words": mph.words, "rank": mph.rank, "fingerprint": fingerprints(distinct)[put], "first": first[put], "count": count[put], "starts": starts}
    raw = [np.ascontiguousarray(parts[name], kind).tobytes() for name, kind in SECTIONS]
    return INDEX_MAGIC + np.array([len(r) for r in raw], "<u8").tobytes() + b"".join(raw)


class Shard:
    """Keyed access to one shard. Sections of the index are read when a bulk lookup needs them; a single lookup reads single entries."""

    def __init__(self, folder: str, number: int):
        self.fs, path = pafs.FileSystem.from_uri(folder)
        self.index = self.fs.open_input_file(f"{path}/ids-{number}.idx")
        head = self.index.read(8 + 8 * len(SECTIONS))
        self.file = self.fs.open_input_file(f"{path}/ids-{number}.bin")
        ids = self.file.read(HEADER)
        if ids[:8] != MAGIC or head[:8] != INDEX_MAGIC:
            raise ValueError(f"not a token-id shard: ids-{number}")
        self.width = int.from_bytes(ids[8:16], "little")
        lengths = np.frombuffer(head[8:], "<u8").astype(np.int64)
        at = len(head) + np.cumsum(lengths) - lengths
        self.place = {name: (int(a), int(n), np.dtype(kind)) for (name, kind), a, n in zip(SECTIONS, at, lengths, strict=True)}
        self.read_bytes = len(head)
        self.levels = [(int(size), int(base)) for size, base in zip(self._section("sizes"), self._section("base"), strict=False)]

    def _section(self, name: str, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Entries lo to hi of a section."""
        at, n, kind = self.place[name]
        hi = n // kind.itemsize if hi is None else hi
        self.index.seek(at + lo * kind.itemsize)
        raw = self.index.read((hi - lo) * kind.itemsize)
        self.read_bytes += len(raw)
        return np.frombuffer(raw, kind)

    def __getattr__(self, name: str) -> np.ndarray:
        if name in ("fingerprint", "first", "count", "starts"):
            setattr(self, name, self._section(name))
            return self.__dict__[name]
        if name == "mph":
            self.mph = MinimalPerfectHash(self._section("sizes"), self._section("words"))
            return self.mph
        raise AttributeError(name)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of int64 keys; -1: not stored."""
        keys = keys.astype(np.int64).view(np.uint64)
        slot = self.mph.slots(keys)
        known = slot >= 0
        known[known] = self.fingerprint[slot[known]] == fingerprints(keys[known])
        return np.where(known, slot, -1)

    def slot(self, key: int) -> int:
        """The slot of one key, -1 if it isn't stored: a word and a rank for each level that it passes, and a fingerprint."""
        one = np.array([key], np.int64).view(np.uint64)
        for level, (size, base) in enumerate(self.levels):
            at = int(MinimalPerfectHash._hash(one, level)[0] % np.uint64(size))
            word = int(self._section("words", base + at // 64, base + at // 64 + 1)[0])
            if word >> at % 64 & 1:
                slot = int(self._section("rank", base + at // 64, base + at // 64 + 1)[0]) + (word & ((1 << at % 64) - 1)).bit_count()
                return slot if self._section("fingerprint", slot, slot + 1)[0] == fingerprints(one)[0] else -1
        return -1

    def read(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo to hi of the shard."""
        self.file.seek(HEADER + lo * self.width)
        return np.frombuffer(self.file.read((hi - lo) * self.width), f"<u{self.width}")

    def documents(self, key: int) -> list[np.ndarray]:
        slot = self.slot(key)
        if slot < 0:
            return []
        first, count = (int(self._section(name, slot, slot + 1)[0]) for name in ("first", "count"))
        starts = self._section("starts", first, first + count + 1).astype(np.int64).tolist()
        return [self.read(lo, hi) for lo, hi in zip(starts, starts[1:], strict=False)]


class WordEncoder:
    """Ids of whole texts by the tokenizer, which is asked once per distinct piece between blanks, where it treats blanks and line feeds only
    as borders and drops them, so that a text's ids are those of its pieces end to end; and once per distinct run of letters, where it
    lower-cases and parts letters from signs. Both are tried on `PROBES` first. Any other tokenizer gets whole pieces, or whole texts."""

    PROBES = ("Hello, World! it's THE end.", "a b  c\nd\n\n e ", " lead", "ÀÉ straße (x) y-z ok?!", "MixedCase CamelWords, ABC.", "one\ntwo THREE", "l'Été, m\u00fcde... Niño")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.vocabulary = self.tokenizer.get_vocab_size()
        # lower-case letters need no normaliser or pre-tokenizer: the model itself takes them, as byte characters, if it agrees on a sample
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        self.byte_character = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in plain)}
        sample = ["a", "zebra", "word", "\u00e9t\u00e9", "stra\u00dfe", "\u00fc\u00ed\u00f1", "thntblere"]
        self.direct = [self._by_model(w) for w in sample] == [e.ids for e in self.tokenizer.encode_batch(sample, add_special_tokens=False)]
        self.pieces = self.parts = True
        whole = [e.ids for e in self.tokenizer.encode_batch(list(self.PROBES), add_special_tokens=False)]
        if not self._agrees(whole):
            self.parts = False
            self.pieces = self._agrees(whole)
        self._reset()

    def _agrees(self, whole: list[list[int]]) -> bool:
        self._reset()
        ids, n = self.encode(list(self.PROBES), 0)
        return [x[:-1].tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == whole

    def _by_model(self, word: str) -> list[int]:
        text = word if word.isascii() else word.encode().decode("latin-1").translate(self.byte_character)
        return [t.id for t in self.model.tokenize(text)]

    def _reset(self) -> None:
        self.number = {"": 0}
        self.start, self.length, self.ids, self.used = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32), 0

    def _put(self, words: list[str], lengths: np.ndarray, flat: np.ndarray) -> None:
        n, total = len(self.number), self.used + len(flat)
        while len(self.start) < n + len(words):
            self.start, self.length = np.resize(self.start, 2 * len(self.start)), np.resize(self.length, 2 * len(self.length))
        while len(self.ids) < total:
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.start[n : n + len(words)] = self.used + np.cumsum(lengths) - lengths
        self.length[n : n + len(words)] = lengths
        self.ids[self.used : total] = flat
        self.used = total
        self.number.update(zip(words, range(n, n + len(words)), strict=True))

    def _ask(self, words: list[str], letters: bool = False) -> None:
        """Ids of pieces that the cache doesn't have, by the tokenizer (lower-case letters: by its model)."""
        for lo in range(0, len(words), 20_000):
            part = words[lo : lo + 20_000]
            got = [self._by_model(w) for w in part] if letters and self.direct else [e.ids for e in self.tokenizer.encode_batch(part, add_special_tokens=False)]
            lengths = np.fromiter(map(len, got), np.int64, len(got))
            self._put(words[lo : lo + 20_000], lengths, np.array(list(chain.from_iterable(got)), np.uint32))

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of cache entries end to end, their running lengths from 0)."""
        length = self.length.take(at)
        total = np.concatenate([[0], np.cumsum(length)])
        return self.ids.take(np.arange(total[-1]) + np.repeat(self.start.take(at) - total[:-1], length)), total

    def _add(self, words: list[str]) -> None:
        """The pre-tokenizer parts a run of letters from a run of signs, and the normaliser lower-cases, so a piece of letters and closing
        signs has the ids of its lower-cased letters and those of the signs; only other pieces are asked for whole."""
        simple = [(w, m[1].lower(), m[2]) for w in words if (m := _LETTERS.fullmatch(w))] if self.parts else []
        rest = set(words).difference(w for w, _, _ in simple)
        cores = {core for _, core, _ in simple if core not in self.number}
        rest.update(signs for _, _, signs in simple if signs not in self.number)
        self._ask(list(rest - cores))
        self._ask(list(cores), letters=True)
        simple = [x for x in simple if x[0] not in self.number]
        if simple:
            at = np.array([(self.number[core], self.number[signs]) for _, core, signs in simple])
            flat, total = self._gather(at.ravel())
            self._put([w for w, _, _ in simple], np.diff(total[::2]), flat)

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, each followed by end_id; ids per text)."""
        if len(self.number) > CACHE_WORDS:
            self._reset()
        if not self.pieces:
            got = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            return np.array([i for ids in got for i in (*ids, end_id)], np.uint32), np.fromiter((len(ids) + 1 for ids in got), np.int64, len(got))
        # Arrow splits and numbers the pieces; only distinct ones are looked up
        pieces = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " "), " ")
        coded = pieces.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        get = self.number.get
        number = np.array([get(w, -1) for w in words], np.int64)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            fresh = [words[i] for i in missing.tolist()]
            self._add(fresh)
            number[missing] = [self.number[w] for w in fresh]
        at = number.take(coded.indices.to_numpy())
        ids, total = self._gather(at)
        borders = total[np.cumsum(pieces.value_lengths().to_numpy())]
        return np.insert(ids, borders, np.uint32(end_id)), np.diff(borders, prepend=0) + 1


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str, key: str = "doc_id", text: str = "text", end_id: int = 2) -> DataFrame:
    """Write shards of token ids under the folder; returns the stored manifest: key, shard, nth (of a repeated key's documents in the shard), n_tokens."""
    estimate = int(str(docs.select(text)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(estimate // SHARD_BYTES, 100_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, out, keys, counts = TaskContext.get().partitionId(), None, [], []
        fs, path = pafs.FileSystem.from_uri(folder)
        enc = encoder(tokenizer_path)
        width = 2 if max(enc.vocabulary - 1, end_id) < 2**16 else 4
        own = f"{path}/tmp-{shard}-{uuid.uuid4().hex}"
        for batch in batches:
            for part in blocks(batch, text):
                ids, n = enc.encode([t or "" for t in part.column(1).to_pylist()], end_id)
                out = out or fs.open_output_stream(f"{own}.ids")
                out.write(ids.astype(f"<u{width}").tobytes())
                keys.append(np.asarray(part.column(0).cast(pa.int64())))
                counts.append(n)
        if out is None:
            return
        out.close()
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.uint64)
        with fs.open_output_stream(f"{own}.bin") as f, fs.open_input_stream(f"{own}.ids") as ids:
            f.write(MAGIC + b"".join(int(x).to_bytes(8, "little") for x in (width, len(keys), starts[-1])))
            while chunk := ids.read(1 << 22):
                f.write(chunk)
        with fs.open_output_stream(f"{own}.idx") as f:
            f.write(build_index(keys, starts))
        fs.delete_file(f"{own}.ids")
        for kind in ("bin", "idx"):
            fs.move(f"{own}.{kind}", f"{path}/ids-{shard}.{kind}")
        nth = np.arange(len(keys)) - np.searchsorted(keys, keys)
        for lo in range(0, len(keys), 50_000):
            part = slice(lo, lo + 50_000)
            cols = (keys[part], np.full(len(keys[part]), shard), nth[part], counts[part])
            yield pa.RecordBatch.from_arrays(list(map(pa.array, cols)), names=[key, "shard", "nth", "n_tokens"])

    _make_dir(folder)
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias(key), F.col(text).alias(text))
    # a key with very many rows is dealt over several shards
    order = [F.col(key), F.xxhash64(text)]
    rows = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order, text)
    return stored(rows.mapInArrow(released(run), f"{key} long, shard long, nth long, n_tokens long"), "manifest")


def _make_dir(folder: str) -> None:
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)


def read_ids(manifest: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """Look up every key of the manifest in the files: key, start (ids of all documents before it), n_tokens, ids_crc32."""
    totals = manifest.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()  # a row per file
    before, total = {}, 0
    for r in totals:
        before[r["shard"]] = total
        total += r["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard_at = lru_cache(maxsize=2)(lambda k: Shard(folder, k))
        for batch in batches:
            keys, at, nth = (np.asarray(c) for c in batch.columns)
            order = np.lexsort((nth, keys, at))
            keys, at, nth = keys[order], at[order], nth[order]
            for k in np.unique(at):
                shard, mine = shard_at(int(k)), keys[at == k]
                slot = shard.find(mine)
                if (slot < 0).any():
                    raise KeyError(f"{mine[slot < 0][0]} isn't in shard {k}")
                doc = shard.first[slot] + nth[at == k]
                lo, hi = shard.starts[doc].astype(np.int64), shard.starts[doc + 1].astype(np.int64)
                crc = np.zeros(len(mine), np.int64)
                run_at = 0
                while run_at < len(mine):  # neighbours are read together, up to about a million ids
                    end = run_at + 1
                    while end < len(mine) and lo[end] == hi[end - 1] and hi[end] - lo[run_at] <= 1 << 20:
                        end += 1
                    ids = shard.read(int(lo[run_at]), int(hi[end - 1])).astype("<u4")
                    for i in range(run_at, end):
                        crc[i] = zlib.crc32(ids[lo[i] - lo[run_at] : hi[i] - lo[run_at]])
                    run_at = end
                yield pa.RecordBatch.from_arrays([pa.array(mine), pa.array(lo + before[int(k)]), pa.array(hi - lo), pa.array(crc)], names=[key, "start", "n_tokens", "ids_crc32"])

    found = manifest.select(key, "shard", "nth").mapInArrow(released(run), f"{key} long, start long, n_tokens long, ids_crc32 long")
    return found.withColumn(key, F.nullif(F.col(key), F.lit(NO_KEY)))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_token_files(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    folder = new_path(spark, "token-ids")
    manifest = write_ids(table(spark, sf_dir, "documents"), folder, tokenizer_path or default_tokenizer())
    return read_ids(manifest, folder)
