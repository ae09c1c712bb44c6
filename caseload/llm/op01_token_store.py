"""Token-ID / binary output with a minimal perfect hash index.

``write_tokens`` encodes every whole text, appends an end id and writes the ids of all documents,
in ascending doc_id order, as raw little-endian integers into shard files. Beside each shard lies
an index: a minimal perfect hash from document key to slot, and for each slot the key's
fingerprint, the offset of its ids in the shard and their number. ``TokenStore.get`` reads one
document with one hash and one ranged read; ``read_tokens`` reads all of them back as a DataFrame.

Shards come from a range partitioning of doc_id (ties by text), so shard order is key order. A
task writes its shard under a name of its own and then moves it into place: a task that runs again
on another executor puts the same bytes there. Files go through pyarrow's file systems into the
shared folder. The driver sees one row for each shard.

Defined cases: a null text is empty and gets the end id only; a null doc_id sorts first and is
kept in the payload but has no index entry; rows that repeat a doc_id stand side by side, ordered
by text, and share one index entry that covers all of them in turn; an empty table gives no shard.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import fresh_path
from .common import blocks, in_arrow, mix, on_leave, partitions, ship, texts_of

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
CACHE_BYTES = 48 << 20  # encoded chunks of a generation, of two; a matter of memory and speed only
ENTRY_BYTES = 150  # what a chunk takes besides its characters and ids
BLOCK_BYTES = 8 << 20  # texts that are cut into chunks together, if they are more than one
PIECE_CHUNKS = 2_000_000  # chunks that are put together at once
# ASCII marks, letters, marks; an apostrophe may belong to the letters behind it
MARKED = re.compile(r"([!-&(-/:;=-@\[-`{-~]*)([a-z]+)([!-&(-/:;=-@\[-`{-~]*)")
GAMMA = 2.0  # bits of a level for each key that is still without a slot
MAGIC = b"TOKMPH01"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# -- encoding ---------------------------------------------------------------------------------


@lru_cache(2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Ids of whole texts as bytes.

    White space always ends a token of this vocabulary and leaves no id itself, so a text's ids
    are the ids of its space-separated chunks one after another, and a chunk met before need not
    be encoded again. Texts are cut and their different chunks numbered in Arrow, their ids put
    together in numpy, so Python sees each chunk once a block. New chunks go to the library many at a time: words of letters as one text,
    cut behind the ids that end a word; others as one text with a special token between them.
    """

    def __init__(self, path: str, dtype: str):
        self.tokenizer, self.dtype = _tokenizer(path), dtype
        self.new, self.old, self.held = {"": b""}, {}, 0
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.mark = next((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), None)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def _cut(self, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
        raw, ends = ids.tobytes(), (at * ids.itemsize).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _words(self, words: list[str]) -> list[bytes]:
        ids = self._ids(" ".join(words))
        found = self._cut(ids, np.flatnonzero(self.ends[ids]) + 1)
        return found if len(found) == len(words) else self._chunks(words)

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        if self.mark is None or any("<|" in c or self.mark in c for c in chunks):
            return [self._ids(c).tobytes() for c in chunks]
        ids = self._ids(self.mark.join(chunks))
        special = ids == self.tokenizer.token_to_id(self.mark)
        inner = np.flatnonzero(special) - np.arange(int(special.sum()))
        return self._cut(ids[~special], np.append(inner, int((~special).sum())))

    def _learn(self, chunks: list[str]) -> None:
        """Encode chunks that neither generation holds; when the newer one is full it becomes the
        older one."""
        if self.held > CACHE_BYTES:
            self.new, self.old, self.held = {"": b""}, self.new, 0
        new, old = self.new, self.old
        kept = {c: old.pop(c) for c in chunks if c in old}
        todo, marked = [], []
        for c in chunks:
            if c not in kept:
                # letters and marks are tokens of their own: only letters with no mark beside them are learned
                if c.isalpha() or not (m := MARKED.fullmatch(c)):
                    todo.append(c)
                else:
                    marked.append((c, m.groups()))
        known = kept
        for part in {x for _, found in marked for x in found}:
            if part and part not in known and not (got := new.get(part) or old.get(part)):
                todo.append(part)
            elif part and part not in known:
                known[part] = got
        todo = list(dict.fromkeys(todo))
        words = [c for c in todo if c.isascii() and c.isalpha()]
        for some, encode in ((words, self._words), ([c for c in todo if not (c.isascii() and c.isalpha())], self._chunks)):
            for low in range(0, len(some), 5000):
                part = some[low : low + 5000]
                known.update(zip(part, encode(part)))
        known[""] = b""
        for c, (before, letters, behind) in marked:
            kept[c] = known[before] + known[letters] + known[behind]
        new.update(kept)
        self.held += sum(map(len, kept)) + sum(map(len, kept.values())) + ENTRY_BYTES * len(kept)

    def _known(self, chunks: list[str]) -> list[bytes]:
        """Ids of different chunks. The vocabulary ignores case, so A-Z are folded here already and
        fewer chunks are new; not beside other characters, whose composition comes before the folding."""
        folded = [c.lower() if c.isascii() and "<|" not in c else c for c in chunks]
        missing = list(dict.fromkeys(c for c in folded if c not in self.new))
        if missing:
            self._learn(missing)
        new, old = self.new, self.old
        # what was known may have become the older generation just now
        return [new[c] if c in new else old[c] for c in folded]

    def encode(self, texts: pa.Array, end_id: int) -> Iterator[tuple[bytes, np.ndarray]]:
        """(ids, count of ids of each text that ends in them) of texts, block by block; every text
        ends with ``end_id``. Texts are strings without null. A piece has ``PIECE_CHUNKS`` chunks."""
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        flat = pc.list_flatten(split)
        ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64))
        width, low, open_ids = np.dtype(self.dtype).itemsize, 0, 0
        while low < len(flat):
            high = min(len(flat), low + PIECE_CHUNKS)
            coded = flat.slice(low, high - low).dictionary_encode()
            pieces = [*self._known(coded.dictionary.to_pylist()), np.array([end_id], self.dtype).tobytes()]
            inside = ends[(ends > low) & (ends <= high)] - low
            code = np.insert(coded.indices.to_numpy(), inside, len(pieces) - 1)
            sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // width
            ids, n = np.frombuffer(b"".join(pieces), self.dtype), sizes[code]
            upto = np.cumsum(n)
            kind = np.int32 if max(len(ids), int(upto[-1])) < 1 << 31 else np.int64
            at = np.repeat(((np.cumsum(sizes) - sizes)[code] - (upto - n)).astype(kind), n)
            del code, n
            at += np.arange(len(at), dtype=kind)
            done = upto[inside + np.arange(len(inside))]  # ids up to and with each end
            counts = np.diff(done, prepend=-open_ids)
            open_ids = int(upto[-1] - (done[-1] if len(done) else -open_ids))
            yield ids[at].tobytes(), counts
            low = high

    def __call__(self, text: str) -> bytes:
        """Ids of one text, without an end."""
        found = b"".join(raw for raw, _ in self.encode(pa.array([text]), 0))
        return found[: -np.dtype(self.dtype).itemsize]


@lru_cache(2)
def _encoder(path: str, dtype: str) -> Encoder:
    """A worker process keeps what it has encoded from task to task, until it does other work."""
    return Encoder(path, dtype)


def _forget() -> None:
    _encoder.cache_clear()
    _tokenizer.cache_clear()


on_leave(__name__, _forget)


def id_type(path: str) -> str:
    """Two bytes for each id where the vocabulary allows it, else four."""
    return "<u2" if max(_tokenizer(path).get_vocab().values(), default=0) < 1 << 16 else "<u4"


# -- minimal perfect hash ---------------------------------------------------------------------


def _hash(keys: np.ndarray, level: int) -> np.ndarray:
    return mix(keys.view(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_hash(keys, 1000) >> np.uint64(32)).astype("<u4")


class PerfectHash:
    """Levels of bits: a key owns the bit it hits alone on the first level where that happens.
    Its slot is the number of bits set before its own."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        flat = np.unpackbits(bits, bitorder="little")[: self.starts[-1]]
        self.flat, self.rank = flat, np.concatenate([[0], np.cumsum(flat, dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys``: distinct 64-bit integers."""
        sizes, levels, left = [], [], keys.astype(np.int64)
        while len(left):
            size = max(64, int(GAMMA * len(left)) // 64 * 64)
            at = (_hash(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[at]]
        flat = np.concatenate(levels) if levels else np.zeros(0, bool)
        return cls(sizes, np.packbits(flat, bitorder="little"))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for keys that surely are not among those it was built from."""
        keys = np.asarray(keys, np.int64)
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = (_hash(keys[open_], level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            hit = self.flat[at] == 1
            out[open_[hit]] = self.rank[at[hit]]
            open_ = open_[~hit]
        return out


# -- files ------------------------------------------------------------------------------------


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _put(files: pafs.FileSystem, path: str, parts: Iterable[bytes]) -> None:
    own = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
    files.move(own, path)


def _index_bytes(keys: np.ndarray, starts: np.ndarray, counts: np.ndarray, dtype: str) -> bytes:
    """Header, bits, then for each slot: fingerprint u4, first row u8, rows u4; then row ends."""
    distinct, first, rows = np.unique(keys["key"][keys["known"]], return_index=True, return_counts=True)
    first = first + int((~keys["known"]).sum())
    perfect = PerfectHash.build(distinct)
    slots = perfect.slots(distinct)
    entry = np.zeros(len(distinct), [("fingerprint", "<u4"), ("first", "<u8"), ("rows", "<u4")])
    entry["fingerprint"][slots], entry["first"][slots], entry["rows"][slots] = fingerprints(distinct), first, rows
    place = np.zeros(len(starts), [("start", "<u8"), ("n", "<u8")])
    place["start"], place["n"] = starts, counts
    header = json.dumps({
        "dtype": dtype, "levels": perfect.sizes, "bits": len(perfect.bits), "slots": len(distinct), "rows": len(starts),
    }).encode()
    return b"".join([
        MAGIC, len(header).to_bytes(8, "little"), header, perfect.bits.tobytes(), entry.tobytes(), place.tobytes(),
        keys.tobytes(),
    ])


KEY = np.dtype([("key", "<i8"), ("known", "?")])


class Shard:
    """One shard: its index in memory, its ids on the store."""

    def __init__(self, files: pafs.FileSystem, path: str):
        self.files, self.path = files, path
        with files.open_input_file(f"{path}.idx") as f:
            raw = f.read()
        if raw[:8] != MAGIC:
            raise ValueError(f"not a token index: {path}.idx")
        size = int.from_bytes(raw[8:16], "little")
        head = json.loads(raw[16 : 16 + size])
        at = 16 + size
        self.dtype = head["dtype"]

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        self.perfect = PerfectHash(head["levels"], take(np.uint8, head["bits"]))
        self.entry = take(np.dtype([("fingerprint", "<u4"), ("first", "<u8"), ("rows", "<u4")]), head["slots"])
        self.place = take(np.dtype([("start", "<u8"), ("n", "<u8")]), head["rows"])
        self.keys = take(KEY, head["rows"])

    def rows_of(self, key: int) -> range:
        """Row numbers of a document: one hash, one fingerprint. Empty if it is not here."""
        keys = np.array([key], np.int64)
        slot = int(self.perfect.slots(keys)[0])
        if slot < 0 or self.entry["fingerprint"][slot] != fingerprints(keys)[0]:
            return range(0)
        first = int(self.entry["first"][slot])
        # fingerprints of 32 bits may agree by chance; the stored key settles it
        return range(first, first + int(self.entry["rows"][slot])) if self.keys["key"][first] == key else range(0)

    def ids(self, row: int) -> np.ndarray:
        width, (start, n) = np.dtype(self.dtype).itemsize, self.place[row]
        with self.files.open_input_file(f"{self.path}.bin") as f:
            f.seek(int(start) * width)
            return np.frombuffer(f.read(int(n) * width), self.dtype)


class TokenStore:
    """Keyed access to a written store."""

    def __init__(self, path: str):
        self.files, self.root = _store(path)
        with self.files.open_input_file(f"{self.root}/manifest.json") as f:
            self.manifest = json.loads(f.read())
        self._open: dict[int, Shard] = {}

    def shard(self, n: int) -> Shard:
        if n not in self._open:
            self._open[n] = Shard(self.files, f"{self.root}/{self.manifest['shards'][n]['name']}")
        return self._open[n]

    def get(self, key: int) -> list[np.ndarray]:
        """Ids of each row with this doc_id; an empty list if there is none."""
        out = []
        for n, s in enumerate(self.manifest["shards"]):
            if s["low"] is not None and s["low"] <= key <= s["high"]:
                shard = self.shard(n)
                out += [shard.ids(r) for r in shard.rows_of(key)]
        return out


# -- Spark jobs -------------------------------------------------------------------------------


def _write_shard(root: str, vocabulary: str, dtype: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        files, base = _store(root)
        number = TaskContext.get().partitionId()
        name, encode = f"shard-{number:06d}", _encoder(vocabulary, dtype).encode
        keys, known, counts = [], [], []

        def payload() -> Iterator[bytes]:
            for batch in batches:
                _, offsets = texts_of(batch.column(1))
                for low, high in blocks(offsets, BLOCK_BYTES, 1 << 14):
                    texts = pc.fill_null(batch.column(1).slice(low, high - low), "").cast(pa.large_string())
                    for raw, ended in encode(texts, end_id):
                        counts.append(ended)
                        yield raw
                keys.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
                known.append(batch.column(0).is_valid().to_numpy(zero_copy_only=False))

        rows = payload()
        first = next(rows, None)
        if first is None:
            return
        _put(files, f"{base}/{name}.bin", chain([first], rows))
        n = np.concatenate(counts)
        key = np.zeros(len(n), KEY)
        key["key"], key["known"] = np.concatenate(keys), np.concatenate(known)
        _put(files, f"{base}/{name}.idx", [_index_bytes(key, np.cumsum(n) - n, n, dtype)])
        real = key["key"][key["known"]]
        yield pa.RecordBatch.from_pydict({
            "shard": [number], "name": [name], "docs": [len(n)], "tokens": [int(n.sum())],
            "low": pa.array([int(real[0]) if len(real) else None], pa.int64()),
            "high": pa.array([int(real[-1]) if len(real) else None], pa.int64()),
        })

    return write


def write_tokens(
    docs: DataFrame, path: str | None = None, vocabulary: str | None = None, end_id: int = END_ID,
) -> str:
    """Write the store of (doc_id, text); returns its path, below the shared folder by default."""
    spark = docs.sparkSession
    ship(spark)
    path = path or fresh_path(spark, "tokens")
    vocabulary = vocabulary or vocabulary_path()
    files, root = _store(path)
    files.create_dir(root, recursive=True)
    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange(partitions(spark), "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", "text")
    )
    shards = ordered.transform(in_arrow, 
        _write_shard(path, vocabulary, id_type(vocabulary), end_id),
        "shard long, name string, docs long, tokens long, low long, high long",
    ).collect()  # one row for each shard
    start, listed = 0, []
    for s in sorted(shards, key=lambda s: s.shard):
        listed.append({"name": s.name, "docs": s.docs, "tokens": s.tokens, "low": s.low, "high": s.high, "start": start})
        start += s.tokens
    manifest = {"dtype": id_type(vocabulary), "end_id": end_id, "tokens": start, "shards": listed}
    _put(files, f"{root}/manifest.json", [json.dumps(manifest).encode()])
    return path


def _read_shard(root: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _store(root)
        for batch in batches:
            for name, start in zip(*[c.to_pylist() for c in batch.columns]):
                shard = Shard(files, f"{base}/{name}")
                yield from _rows(shard, start)

    return read


def _rows(shard: Shard, start: int, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Every row of a shard, found by its key where it has one."""
    width = np.dtype(shard.dtype).itemsize
    at = np.arange(len(shard.place))
    known = shard.keys["known"]
    slots = shard.perfect.slots(shard.keys["key"][known])
    found = shard.entry["first"][slots].astype(np.int64)
    real = shard.keys["key"][known]
    # rows that repeat a key follow the first of them
    again = np.arange(len(real)) - np.searchsorted(real, real)
    at[known] = found + again
    if (shard.entry["fingerprint"][slots] != fingerprints(real)).any():
        raise ValueError(f"index and payload differ: {shard.path}")
    with shard.files.open_input_file(f"{shard.path}.bin") as f:
        for low in range(0, len(at), rows):
            part = shard.place[at[low : low + rows]]
            crc = []
            for begin, n in zip(part["start"].tolist(), part["n"].tolist()):
                f.seek(begin * width)
                crc.append(zlib.crc32(np.frombuffer(f.read(n * width), shard.dtype).astype("<u4").tobytes()))
            keys = shard.keys[low : low + rows]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(keys["key"].astype(np.int64), mask=~keys["known"]),
                "start": pa.array(part["start"].astype(np.int64) + start),
                "n_tokens": pa.array(part["n"].astype(np.int64)),
                "ids_crc32": pa.array(crc, pa.int64()),
            })


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files."""
    ship(spark)
    store = TokenStore(path)
    shards = [(s["name"], s["start"]) for s in store.manifest["shards"]]
    listed = spark.createDataFrame(shards, "name string, start long")
    return listed.repartition(max(1, min(len(shards), partitions(spark)))).transform(in_arrow, _read_shard(path), READ)
