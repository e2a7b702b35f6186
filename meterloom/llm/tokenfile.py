"""Token ids in files of independent zstandard frames with a trailing seek table.

File: data frames, one index frame, then a skippable frame in the public seekable format of zstandard: for each frame
its compressed size, its plain size and the low 32 bits of the XXH64 of its plain bytes; then the number of frames, a
flag byte and a magic number.  Any zstandard tool can decompress such a file; a reader of some documents reads the seek
table and the index and decompresses only the frames it needs.

Plain bytes of a data frame, little-endian: uint32 number of documents; of each one byte (1: it has an id), int64 id and
uint32 number of ids; then all ids as uint32.  The index frame: for each data frame the int64 number of documents and of
ids before it, and its int64 first document id.

Documents are in ascending order of their id over all files, null ids first.  A file is the work of one task;
its name is new for each attempt, and the manifest lists those of the attempts that count.

Defined results: null text counts as empty and has only the end id; rows that repeat an id are written one after the other,
in the order of their texts' hash; an empty table gives an empty manifest; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm import store
from meterloom.llm.words import blocks

SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80
FRAME_BYTES = 1 << 18
# Words kept with their ids in a worker, some 200 bytes each, and words worked on at a time.
CACHED_WORDS = 900_000
HELD_WORDS = 400_000
END = 2
# Bytes of texts that are encoded together.
TEXT_BYTES = 1 << 22

_RUNS = re.compile(rb"[a-z]+|[0-9]|[^a-z0-9]+")

# Normal form, pattern and word end of the vocabularies whose words can be encoded apart.
BY_WORD = {
    "normalizer": ["NFC", r"\s+ to ' '", "Lowercase"],
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    "end": "</w>",
}


def _by_word(vocabulary: str) -> bool:
    """Whether a vocabulary works as :data:`BY_WORD` says."""
    parts = json.loads(vocabulary)
    steps = (parts.get("normalizer") or {}).get("normalizers") or []
    names = [f"{x['pattern'].get('Regex')} to '{x['content']}'" if x["type"] == "Replace" else x["type"] for x in steps]
    before = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    split = before[0].get("pattern", {}).get("Regex") if before[0].get("invert") else None
    whole = [x.get("type") for x in before[1:]] == ["ByteLevel"] and not before[1]["add_prefix_space"] and not before[1]["use_regex"]
    special = all(x["content"].startswith("<") and not any(x[k] for k in ("lstrip", "rstrip", "single_word")) for x in parts["added_tokens"])
    found = {"normalizer": names, "pattern": split, "end": parts["model"].get("end_of_word_suffix")}
    return found == BY_WORD and whole and special and not parts.get("post_processor")


def _letters_only(text: str) -> bool:
    """Letters in the form given, the composed and the lower-case one: the pattern takes these as one run."""
    if not text.isalpha():
        return False
    plain = unicodedata.normalize("NFC", text)
    return plain.isalpha() and plain.lower().isalpha()


class Encoder:
    """Ids of texts by a vocabulary of the tokenizers library.

    White space always ends a word of a vocabulary like :data:`BY_WORD`, so its words are encoded apart, and those seen before
    are not encoded again.  Runs of letters are handed to the library together: each of them ends with a piece that ends a
    word.  With any other vocabulary whole texts are encoded.
    """

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.by_word = _by_word(vocabulary)
        n = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(n)])
        self.words: dict[bytes, bytes] = {b"": b""}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32).tobytes() for e in found]

    def _letters(self, runs: dict[bytes, str]) -> None:
        """Learn runs of letters, a thousand at a time in one text."""
        keys = list(runs)
        for at in range(0, len(keys), 1000):
            group = keys[at : at + 1000]
            raw = self._ids([" ".join(runs[w] for w in group)])[0]
            cuts = ((np.flatnonzero(self.ends[np.frombuffer(raw, np.uint32)]) + 1) * 4).tolist()
            if len(cuts) != len(group):
                self.words.update(zip(group, self._ids([runs[w] for w in group]), strict=True))
                continue
            last = 0
            for w, cut in zip(group, cuts, strict=True):
                self.words[w] = raw[last:cut]
                last = cut

    def learn(self, words: list[bytes]) -> None:
        """Words of ASCII without apostrophes and ``<`` split into the runs that the vocabulary's pattern takes apart."""
        known, split, rest, runs, signs = self.words, {}, [], {}, set()
        for w in words:
            if w.isalpha() and w.islower():
                runs[w] = w.decode()
                continue
            if w.isascii() and b"'" not in w and b"<" not in w:
                parts = split[w] = _RUNS.findall(w.lower())
                for x in parts:
                    if x not in known:
                        if x.isalpha():
                            runs[x] = x.decode()
                        else:
                            signs.add(x)
                continue
            text = w.decode()
            stem = text[:-1] if text[-1] in ".," else text
            if not _letters_only(stem):
                rest.append(w)
                continue
            key = stem.encode()
            if key not in known:
                runs[key] = stem
            if stem is not text:
                split[w] = [key, text[-1].encode()]
                signs.add(split[w][1])
        self._letters(runs)
        rest += signs
        known.update(zip(rest, self._ids([w.decode() for w in rest]), strict=True))
        for w, parts in split.items():
            known[w] = b"".join(map(known.__getitem__, parts))

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Little-endian uint32 ids of each text.

        Arrow splits the texts and tells their words apart, so that only distinct words are looked up one by one.
        """
        array = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        array = array.fill_null("")
        if not self.by_word:
            return self._ids(array.to_pylist())
        split = pc.ascii_split_whitespace(array)
        words, ends = split.flatten(), np.diff(split.offsets.to_numpy()).cumsum()
        out: list[list[bytes]] = [[] for _ in range(len(array))]
        for at in range(0, len(words), HELD_WORDS):
            part = words.slice(at, HELD_WORDS)
            ids = self._lookup(part)
            # Texts with words in this part, and where they end in it.
            first, last = np.searchsorted(ends, [at, at + len(part) - 1], side="right")
            cuts = np.minimum(ends[first : last + 1] - at, len(part))
            places = np.frombuffer(ids.buffers()[1], np.int32)[: len(part) + 1][np.append(0, cuts)].tolist()
            raw = ids.buffers()[2].to_pybytes() if places[-1] else b""
            for i, (a, b) in enumerate(zip(places[:-1], places[1:], strict=True), first):
                out[i].append(raw[a:b])
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def _lookup(self, words: pa.Array) -> pa.Array:
        """Ids of each word, learned before if need be."""
        words = words.dictionary_encode()
        _, ends, data = words.dictionary.buffers()
        ends = np.frombuffer(ends, np.int32)[: len(words.dictionary) + 1].tolist()
        raw = data.to_pybytes() if data is not None else b""
        distinct = [raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        found = list(map(self.words.get, distinct))
        new = [i for i, ids in enumerate(found) if ids is None]
        if len(self.words) + len(new) > CACHED_WORDS:
            self.words = {b"": b""}
            new = [i for i, w in enumerate(distinct) if w]
        self.learn([distinct[i] for i in new])
        for i in new:
            found[i] = self.words[distinct[i]]
        return pa.array(found, pa.binary()).take(words.indices)


class Frame(NamedTuple):
    at: int
    packed: int
    plain: int
    checksum: int


def _checksum(plain: bytes) -> int:
    return xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF


class Writer:
    def __init__(self, sink, level: int = 3):
        self.sink, self.level = sink, level
        self.frames: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int, int]] = []
        self.docs = self.ids = 0
        self.held: list[tuple[int | None, bytes]] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.held.append((doc_id, ids))
        self.size += len(ids) + 13
        if self.size >= FRAME_BYTES:
            self.flush()

    def _frame(self, plain: bytes) -> None:
        packed = zstandard.ZstdCompressor(level=self.level).compress(plain)
        self.sink.write(packed)
        self.frames.append((len(packed), len(plain), _checksum(plain)))

    def flush(self) -> None:
        if not self.held:
            return
        self.index.append((self.docs, self.ids, self.held[0][0] or 0))
        head = b"".join(struct.pack("<BqI", i is not None, i or 0, len(x) // 4) for i, x in self.held)
        self._frame(struct.pack("<I", len(self.held)) + head + b"".join(x for _, x in self.held))
        self.docs += len(self.held)
        self.ids += sum(len(x) for _, x in self.held) // 4
        self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        self._frame(b"".join(struct.pack("<qqq", *x) for x in self.index))
        body = b"".join(struct.pack("<III", *x) for x in self.frames)
        body += struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(body)) + body)


class Reader:
    """Random access to one file."""

    def __init__(self, path: str):
        system, name = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(name)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE or not flags & CHECKSUMS:
            raise ValueError(f"{path} has no seek table with checksums")
        table = self.file.read_at(12 * n, size - 9 - 12 * n)
        self.frames, at = [], 0
        for entry in struct.iter_unpack("<III", table):
            self.frames.append(Frame(at, *entry))
            at += entry[0]
        self.index = list(struct.iter_unpack("<qqq", self.plain(n - 1)))

    def plain(self, k: int) -> bytes:
        frame = self.frames[k]
        packed = self.file.read_at(frame.packed, frame.at)
        plain = zstandard.ZstdDecompressor().decompress(packed, max_output_size=frame.plain)
        if len(plain) != frame.plain or _checksum(plain) != frame.checksum:
            raise ValueError(f"frame {k} is damaged")
        return plain

    def frame(self, k: int) -> Iterator[tuple[int | None, int, bytes]]:
        """Id, ids before it in the file, and ids of each document of a data frame."""
        plain = self.plain(k)
        (n,) = struct.unpack_from("<I", plain)
        heads = list(struct.iter_unpack("<BqI", plain[4 : 4 + 13 * n]))
        at, before = 4 + 13 * n, self.index[k][1]
        for known, doc_id, count in heads:
            yield (doc_id if known else None), before, plain[at : at + 4 * count]
            at += 4 * count
            before += count

    def documents(self, nth: list[int]) -> list[tuple[int | None, bytes]]:
        """The documents with these places in the file; only their frames are decompressed."""
        firsts = np.array([x[0] for x in self.index])
        frames = np.searchsorted(firsts, np.array(nth), side="right") - 1
        plain = {int(k): list(self.frame(int(k))) for k in set(frames.tolist())}
        found = [plain[k][n - int(firsts[k])] for n, k in zip(nth, frames.tolist(), strict=True)]
        return [(doc_id, ids) for doc_id, _, ids in found]

    def close(self) -> None:
        self.file.close()


def _uri(folder: str) -> str:
    return folder if "://" in folder else f"file://{folder.removeprefix('file:')}"


def write(docs: DataFrame, vocabulary_path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end: int = END) -> DataFrame:
    """Encode and write all rows below ``folder``; the stored manifest: ``part``, ``path``, ``n_docs``, ``n_ids``, ``first_id``."""
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = f.read()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    root = _uri(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, part = None, None, TaskContext.get().partitionId()
        path = f"{root}/ids-{part:06d}-{uuid.uuid4().hex}.zst"
        for batch in batches:
            if writer is None and batch.num_rows:
                encoder = encoder_of(vocabulary)
                system, name = fs.FileSystem.from_uri(path)
                system.create_dir(name.rpartition("/")[0], recursive=True)
                sink = system.open_output_stream(name, compression=None)
                writer = Writer(sink)
            for part_ in blocks(batch, size=TEXT_BYTES):
                ids = encoder.encode(part_.column(1))
                tail = struct.pack("<I", end)
                for doc_id, raw in zip(part_.column(0).to_pylist(), ids, strict=True):
                    writer.add(doc_id, raw + tail)
        if writer is not None:
            writer.close()
            sink.close()
            row = {"part": [part], "path": [path], "n_docs": [writer.docs], "n_ids": [writer.ids]}
            yield pa.RecordBatch.from_pydict(row)

    manifest = rows.mapInArrow(run, "part long, path string, n_docs long, n_ids long")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    return store.stored(manifest, "manifest").withColumn("ids_before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


_encoders: dict[int, Encoder] = {}


def encoder_of(vocabulary: str) -> Encoder:
    key = hash(vocabulary)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocabulary)
    return _encoders[key]


def read(manifest: DataFrame) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it) and ``ids`` (little-endian uint32) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch["path"].to_pylist(), batch["ids_before"].to_pylist(), strict=True):
                reader = Reader(path)
                for k in range(len(reader.index)):
                    found = list(reader.frame(k))
                    columns = [
                        pa.array([x[0] for x in found], pa.int64()),
                        pa.array([base + x[1] for x in found], pa.int64()),
                        pa.array([x[2] for x in found], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "ids"])
                reader.close()

    files = manifest.select("path", "ids_before")
    return files.repartition(F.col("path")).mapInArrow(run, "doc_id long, start long, ids binary")
