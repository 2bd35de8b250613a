"""Token-id files with a minimal perfect hash index: raw ids, keyed access in constant time."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from hydrolake.llm.common import keyed, parts, slices, text_bytes, written
from hydrolake.llm.encode import encoder
from hydrolake.session import scratch_path

MAGIC, VERSION = b"HLTOKENS", 1
#: Text bytes of one sorted part; tokens after which a file is closed; keys of a hash bucket.
PART_BYTES, FILE_TOKENS, LOAD = 16 << 20, 16 << 20, 4
#: Displacements tried at once.
TRIES = 64
_FIXED = np.uint32(1 << 31)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(ids: np.ndarray, known: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """64 bits of a key: an id (or none) and which of its repeated rows is meant."""
    return _mix(_mix(ids.astype(np.int64).view(np.uint64)) + nth.astype(np.uint64) * np.uint64(2) + known.astype(np.uint64))


class PerfectHash:
    """Compress, hash, displace: keys fall into small buckets; each bucket keeps the first
    displacement that sends all its keys to free slots, a bucket of one key its slot itself."""

    def __init__(self, displaced: np.ndarray, n: int):
        self.displaced, self.n = displaced, n

    def bucket(self, h: np.ndarray) -> np.ndarray:
        return ((h >> np.uint64(32)) * np.uint64(len(self.displaced)) >> np.uint64(32)).astype(np.int64)

    def slots(self, h: np.ndarray, d: np.ndarray) -> np.ndarray:
        moved = (_mix(h + d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(max(1, self.n))).astype(np.int64)
        return np.where(d >= _FIXED, (d & ~_FIXED).astype(np.int64), moved)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        return self.slots(h, self.displaced[self.bucket(h)])

    @classmethod
    def build(cls, h: np.ndarray) -> PerfectHash:
        made = cls(np.zeros(max(1, -(-len(h) // LOAD)), np.uint32), len(h))
        where = made.bucket(h)
        order = np.argsort(where, kind="stable")
        counts = np.bincount(where, minlength=len(made.displaced))
        ends, free = np.cumsum(counts), np.ones(len(h), bool)
        for b in np.argsort(-counts, kind="stable"):
            if counts[b] < 2:
                break
            keys, d = h[order[ends[b] - counts[b]:ends[b]]], 0
            while True:  # some displacements at a time; late buckets need many
                s = np.sort(made.slots(keys, np.arange(d, d + TRIES, dtype=np.uint32)[:, None]), axis=1)
                fits = np.flatnonzero(free[s].all(axis=1) & (s[:, 1:] != s[:, :-1]).all(axis=1))
                if len(fits):
                    free[s[fits[0]]], made.displaced[b] = False, d + fits[0]
                    break
                d += TRIES
        single = np.flatnonzero(counts == 1)
        made.displaced[single] = np.flatnonzero(free)[:len(single)].astype(np.uint32) | _FIXED
        return made


def pack_file(ids: list[int | None], tokens: list[bytes], width: int) -> bytes:
    """One file: header, displacements, per slot fingerprint and document, per document id, whether
    it has one, which repetition it is, and start; then the raw ids, 2 or 4 bytes each."""
    known = np.array([i is not None for i in ids], bool)
    keys = np.array([i or 0 for i in ids], np.int64)
    nth = np.zeros(len(ids), np.uint32)
    for i in range(1, len(ids)):
        if keys[i] == keys[i - 1] and known[i] == known[i - 1]:
            nth[i] = nth[i - 1] + 1
    h = key_hash(keys, known, nth)
    index = PerfectHash.build(h)
    doc = np.empty(len(ids), np.uint32)
    doc[index(h)] = np.arange(len(ids))
    prints = _mix(h + np.uint64(1)).astype(np.uint32)[doc]
    starts = np.concatenate([[0], np.cumsum([len(t) // 4 for t in tokens])]).astype(np.uint64)
    payload = np.frombuffer(b"".join(tokens), "<u4").astype(f"<u{width}")
    head = np.array([VERSION, width, len(ids), starts[-1], len(index.displaced)], "<u8")
    return b"".join([MAGIC, *(a.tobytes() for a in (head, index.displaced, prints, doc, keys, known, nth, starts, payload))])


class TokenFile:
    """A file read back."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        version, width, n, total, buckets = np.frombuffer(data, "<u8", 5, 8).tolist()
        if version != VERSION:
            raise ValueError(f"version {version} is not known")
        at, out = 48, []
        for kind, count in (("<u4", buckets), ("<u4", n), ("<u4", n), ("<i8", n), ("?", n), ("<u4", n), ("<u8", n + 1), (f"<u{width}", total)):
            out.append(np.frombuffer(data, kind, count, at))
            at += out[-1].nbytes
        displaced, self.prints, self.doc, self.ids, self.known, self.nth, self.starts, self.payload = out
        self.index, self.n, self.total = PerfectHash(displaced, n), n, total

    def find(self, h: np.ndarray) -> np.ndarray:
        """Document numbers of key hashes, -1 where the stored fingerprint denies the key."""
        if not self.n:
            return np.full(len(h), -1)
        slot = self.index(h)
        return np.where(self.prints[slot] == _mix(h + np.uint64(1)).astype(np.uint32), self.doc[slot].astype(np.int64), -1)

    def tokens(self, number: int) -> np.ndarray:
        a, b = int(self.starts[number]), int(self.starts[number + 1])
        return self.payload[a:b].astype("<u4")

    def get(self, doc_id: int | None, nth: int = 0) -> np.ndarray | None:
        h = key_hash(np.array([doc_id or 0]), np.array([doc_id is not None]), np.array([nth]))
        number = int(self.find(h)[0])
        return None if number < 0 else self.tokens(number)


def _filesystem(uri: str):
    """File system and path of a folder or file named as Hadoop names it."""
    for scheme, known in (("s3a://", "s3://"), ("s3n://", "s3://"), ("dbfs:/", "/dbfs/")):
        if uri.startswith(scheme):
            uri = known + uri.removeprefix(scheme).lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(uri)


def _put(folder: str, name: str, data: bytes) -> str:
    """Written under a name of this attempt, then moved: a retried or doubled task leaves whole files."""
    fs, root = _filesystem(folder)
    fs.create_dir(root, recursive=True)
    path, mine = f"{root}/{name}", f"{root}/.{name}-{TaskContext.get().taskAttemptId()}"
    with fs.open_output_stream(mine) as f:
        f.write(data)
    fs.move(mine, path)
    return f"{folder}/{name}"


def _get(path: str) -> bytes:
    fs, at = _filesystem(path)
    with fs.open_input_stream(at) as f:
        return f.read()


class KeyedReader:
    """Keyed access to one file without reading it: a key takes the header, one displacement, one slot
    (fingerprint and document number), the document's own key and bounds, and its ids, by place."""

    def __init__(self, path: str):
        fs, at = _filesystem(path)
        self.file = fs.open_input_file(at)
        head = self.file.read_at(48, 0)
        if head[:8] != MAGIC:
            raise ValueError("not a token file")
        version, self.width, self.n, self.total, self.buckets = np.frombuffer(head, "<u8", 5, 8).tolist()
        if version != VERSION:
            raise ValueError(f"version {version} is not known")
        sizes = [4 * self.buckets, 4 * self.n, 4 * self.n, 8 * self.n, self.n, 4 * self.n, 8 * (self.n + 1)]
        self.displaced, self.prints, self.doc, self.ids, self.known, self.nth, self.starts, self.payload = (
            48 + np.concatenate([[0], np.cumsum(sizes)])).tolist()

    def _at(self, base: int, kind: str, i: int, n: int = 1) -> np.ndarray:
        size = np.dtype(kind).itemsize
        return np.frombuffer(self.file.read_at(n * size, base + i * size), kind)

    def get(self, doc_id: int | None, nth: int = 0) -> np.ndarray | None:
        """Token ids of a document, or None if the file does not hold it."""
        if not self.n:
            return None
        h = key_hash(np.array([doc_id or 0]), np.array([doc_id is not None]), np.array([nth]))
        one = PerfectHash(np.zeros(self.buckets, np.uint32), self.n)
        slot = int(one.slots(h, self._at(self.displaced, "<u4", int(one.bucket(h)[0])))[0])
        if self._at(self.prints, "<u4", slot)[0] != _mix(h + np.uint64(1)).astype(np.uint32)[0]:
            return None
        number = int(self._at(self.doc, "<u4", slot)[0])
        if (self._at(self.ids, "<i8", number)[0], self._at(self.known, "?", number)[0], self._at(self.nth, "<u4", number)[0]) != (
                doc_id or 0, doc_id is not None, nth):
            return None  # the fingerprints agree by chance
        a, b = self._at(self.starts, "<u8", number, 2).tolist()
        return self._at(self.payload, f"<u{self.width}", a, b - a).astype("<u4")

    def close(self) -> None:
        self.file.close()


def lookup(files: DataFrame, ids: list[int | None], nth: int = 0) -> list[np.ndarray | None]:
    """Token ids of some documents of a list of files (``write``), None for those it does not hold.

    One aggregation over the list finds for all ids the file each must lie in, that of the greatest
    first id not above it; of each file only the places of the key are read. For a handful of ids,
    which the caller holds anyway. Null asks for rows without id, ``nth`` for one of repeated rows.
    """
    if not ids:
        return []
    place = F.struct("known", "first", "seq", "path")
    # a file that starts with rows without id may hold the first ids too
    wanted = [F.max(F.when(~F.col("known") if i is None else ~F.col("known") | (F.col("first") <= i), place)).alias(f"f{k}") for k, i in enumerate(ids)]
    out = []
    for i, at in zip(ids, files.agg(*wanted).first()):
        reader = KeyedReader(at.path) if at else None
        out.append(reader.get(i, nth) if reader else None)
        if reader:
            reader.close()
    return out


FILES = "path string, known boolean, first long, seq int, n_docs long, n_tokens long"


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text",
          file_tokens: int = FILE_TOKENS, part_bytes: int = PART_BYTES) -> DataFrame:
    """Token files of all documents in ascending id order; returns the list of files.

    Texts are range-partitioned by id and sorted, tokenized where they land, and written as files
    of about ``file_tokens`` tokens, so neither a task nor a file grows with the table. Ids take two
    bytes where the vocabulary allows. The list (path, first id, documents, tokens) is itself
    written before it is used: a job that fails on the way writes the same files again.

    Null text: only the end id. Null ids come first. Repeated ids lie side by side, numbered. An
    empty table gives no file.
    """
    n = parts(text_bytes(docs, text), part_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        width = 2 if max(made.vocab - 1, end_id) < 1 << 16 else 4
        ids, tokens, size, seq = [], [], 0, 0

        def close() -> pa.RecordBatch:
            path = _put(folder, f"{TaskContext.get().partitionId():06d}-{seq:05d}.tok", pack_file(ids, tokens, width))
            row = [path, ids[0] is not None, ids[0] or 0, seq, len(ids), size]
            names = [x.split()[0] for x in FILES.split(", ")]
            kinds = [pa.string(), pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for b in slices(batches, "text"):
            for i, t in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                # a repeated id stays in its file, where its rows are numbered
                if size >= file_tokens and i != ids[-1]:
                    yield close()
                    ids, tokens, size, seq = [], [], 0, seq + 1
                ids.append(i)
                tokens.append(made.ids((t or b"").decode()) + end)
                size += len(tokens[-1]) // 4
        if ids:
            yield close()

    ranged = keyed(docs, doc_id, text).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    return written(ranged.mapInArrow(run, FILES), "token-files")


def read(files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files; start counts the
    ids of all documents before it. Each file is opened by one task; each document is looked up in
    its file's index, and what is found is checked against the file's own list.

    Only the list of files, one short row each, is put in order as a whole.
    """
    before = Window.orderBy("known", "first", "seq", "path").rowsBetween(Window.unboundedPreceding, -1)
    based = files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b["path"].to_pylist(), b["base"].to_pylist()):
                f = TokenFile(_get(path))
                number = f.find(key_hash(f.ids, f.known, f.nth))
                if not np.array_equal(number, np.arange(f.n)):
                    raise ValueError(f"{path}: the index does not lead to its documents")
                sums = [zlib.crc32(f.tokens(i)) for i in number.tolist()]
                starts = f.starts.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f.ids, mask=~f.known), pa.array(starts[:-1] + base), pa.array(np.diff(starts)), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, files.count())
    return based.select("path", "base").repartition(n, "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes the files to the shared scratch folder and reads them back."""
    return read(write(docs, tokenizer, scratch_path(docs.sparkSession, "tokens"), end_id))
