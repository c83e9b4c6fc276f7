"""Token ids as length-delimited binary records, with an offset index beside each file.

A record is framed as: length of the payload (u64), masked checksum of these eight bytes
(u32), payload, masked checksum of the payload (u32). The payload holds the width of an id
in bytes (u8), whether the document's id is null (u8), that id (i64), and the ids. All numbers
are little-endian; the checksum is CRC-32, rotated right by 15 bits plus 0xa282ead8, so that
checksums of data that holds checksums stay sound. The index has for each record its offset
and the number of ids before it in the file (u64 each), so any record can be read alone.
"""

from __future__ import annotations

import os
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import ordered_id, portions, ragged, stored, utf8, whole_text
from tillflow.session import scratch_dir

#: Bytes of text that a record file holds, about.
FILE_BYTES = 32 << 20
#: Records that are read together.
READ_TOGETHER = 512
_MARKS = ".,;:!?"

#: Distinct words a Python worker keeps, and their bytes; then those go that came in one block only.
KEPT_WORDS = 1_000_000
KEPT_BYTES = 64 << 20
#: Bytes of text that are encoded together.
BLOCK_BYTES = 8 << 20

ENTRY_BYTES = 16
_HEAD, _PAYLOAD = struct.Struct("<QI"), struct.Struct("<BBq")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def index_entry(offset: int, tokens: int) -> bytes:
    return struct.pack("<QQ", offset, tokens)


def framed(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    if len(ids) and int(ids.max()) >> 8 * width:
        raise ValueError(f"id {ids.max()} does not fit in {width} bytes")
    payload = _PAYLOAD.pack(width, doc_id is None, doc_id or 0) + ids.astype(f"<u{width}").tobytes()
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def unframed(data: memoryview, at: int) -> tuple[int | None, np.ndarray, int]:
    """The document's id, the token ids and the end of the record at ``at``; a bad checksum is an error."""
    size, check = _HEAD.unpack_from(data, at)
    payload = bytes(data[at + 12 : at + 12 + size])
    end = at + 12 + size + 4
    if masked(bytes(data[at : at + 8])) != check or masked(payload) != struct.unpack_from("<I", data, end - 4)[0]:
        raise ValueError(f"checksum of the record at {at}")
    width, null, doc_id = _PAYLOAD.unpack_from(payload)
    return None if null else doc_id, np.frombuffer(payload, f"<u{width}", offset=_PAYLOAD.size), end


def _plain(text: str) -> bool:
    """Letters alone, before and after NFC and lowering, which may part a letter from its mark."""
    return text.isalpha() and (text.isascii() or _whole(text))


def _whole(text: str) -> bool:
    composed = unicodedata.normalize("NFC", text)
    return composed.isalpha() and composed.lower().isalpha() and text.lower().isalpha()


class WordEncoder:
    """Encodes with a tokenizer whose tokens never cross white space, word by word, keeping what it saw.

    Letters without marks are one piece for the tokenizer, and its pieces end with ``end``.
    So many new words are encoded as one text and told apart by that ending. Known words are
    an Arrow array; place, number and values of their ids are numpy arrays.
    """

    def __init__(self, path: str, end: str = "</w>"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[i] = token.endswith(end)
        self.known = pa.array([], pa.binary())
        self.starts, self.n, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")
        self.again = np.zeros(0, bool)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.known) > KEPT_WORDS or self.known.nbytes > KEPT_BYTES:
            self._forget()
        split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
        coded = split.values.view(pa.binary()).dictionary_encode()
        which = self._places(coded.dictionary)[coded.indices.to_numpy()]
        lengths = self.n[which]
        ids = self.ids[ragged(self.starts[which], lengths)]
        ends = np.append(0, np.cumsum(lengths))[split.offsets.to_numpy()].tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def _forget(self) -> None:
        """Keep the words that came again; none if they are too many."""
        keep = self.again
        if keep.sum() > KEPT_WORDS // 2 or self.known.nbytes > KEPT_BYTES:
            keep = np.zeros_like(keep)
        ids, n = self.ids[ragged(self.starts[keep], self.n[keep])], self.n[keep]
        self.known = self.known.filter(pa.array(keep))
        self.starts, self.n, self.ids, self.again = np.cumsum(n) - n, n, ids, np.zeros(len(n), bool)

    def _add(self, words: pa.Array, n: np.ndarray, ids: np.ndarray) -> None:
        self.known = pa.concat_arrays([self.known, words])
        self.starts = np.append(self.starts, len(self.ids) + np.cumsum(n) - n)
        self.n, self.ids = np.append(self.n, n), np.append(self.ids, ids)
        self.again = np.append(self.again, np.zeros(len(n), bool))

    def _places(self, words: pa.Array) -> np.ndarray:
        """Places of ``words``, each of which comes once, among the known ones; new words are learnt."""
        at = pc.index_in(words, self.known)
        self.again[at.drop_null().to_numpy()] = True
        out = at.fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(out < 0)
        if len(new):
            out[new] = self._learn(words.take(pa.array(new)))
        return out

    def _learn(self, new: pa.Array) -> np.ndarray:
        stems = pc.ascii_rtrim(new.view(pa.string()), characters=_MARKS).view(pa.binary())
        plain = pc.ascii_is_alpha(stems.view(pa.string())).to_numpy(zero_copy_only=False)
        odd = np.flatnonzero(~plain)
        plain[odd] = [_plain(t.decode("utf-8", "replace")) for t in stems.take(pa.array(odd)).to_pylist()]
        # the tokenizer parts marks from letters that its NFC step leaves letters alone
        first = pc.if_else(pa.array(plain), stems, new)
        data, offs = utf8(new)
        cut = np.diff(offs) - pc.binary_length(first).to_numpy()
        ended = np.flatnonzero(cut)
        last = data[ragged(offs[1:][ended] - cut[ended], cut[ended])]
        ends = np.append(0, np.cumsum(cut[ended])).astype(np.int32)
        last = pa.Array.from_buffers(pa.binary(), len(ended), [None, pa.py_buffer(ends), pa.py_buffer(last)])
        coded = pa.concat_arrays([first, last]).dictionary_encode()
        parts, part_of = coded.dictionary, coded.indices.to_numpy()
        letters = np.zeros(len(parts), bool)
        letters[part_of[: len(new)][plain]] = True
        at = pc.index_in(parts, self.known).fill_null(-1).to_numpy().astype(np.int64)
        for some, kind in ((np.flatnonzero((at < 0) & letters), self._letters), (np.flatnonzero((at < 0) & ~letters), self._each)):
            words = parts.take(pa.array(some))
            at[some] = len(self.known) + np.arange(len(some))
            self._add(words, *kind([w.decode("utf-8", "replace") for w in words.to_pylist()]))
        out = at[part_of[: len(new)]]
        both = np.stack([out[ended], at[part_of[len(new) :]]], axis=1)
        out[ended] = len(self.known) + np.arange(len(ended))
        n = self.n[both]
        self._add(new.take(pa.array(ended)), n.sum(axis=1), self.ids[ragged(self.starts[both].ravel(), n.ravel())])
        return out

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number and values of the ids of plain words."""
        n, out = [np.zeros(0, np.int64)], [np.zeros(0, "<u4")]
        for at in range(0, len(words), 500):
            some = words[at : at + 500]
            ids = np.array(self._ids([" ".join(some)])[0], "<u4")
            lengths = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1) if len(ids) else n[0]
            if len(lengths) != len(some):
                lengths, ids = self._each(some)
            n.append(lengths)
            out.append(ids)
        return np.concatenate(n), np.concatenate(out)

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.zeros(0, "<u4"), *(np.array(ids, "<u4") for ids in self._ids(words))]
        return np.array([len(ids) for ids in found[1:]], np.int64), np.concatenate(found)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(1)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _target(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int, width: int = 2) -> DataFrame:
    """Write the token ids of every whole text, ``end_id`` last, in ascending order of ``doc_id``.

    Files follow each other in order: null ids first, equal ids by a hash of the text. Null
    texts are empty. A task writes its file under a name of its own attempt and renames it
    when it is whole, so a repeated task leaves the same file. ``folder``: a URI or path that
    all executors share; ``width``: bytes of an id; one that does not
    fit is an error. An empty table writes no file.

    Returns the list of files: ``part, n_records, n_tokens``.
    """
    text = whole_text()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        ordered_id().alias("ord"),
        F.xxhash64(text).alias("tid"),
        F.monotonically_increasing_id().alias("nth"),  # so that no run of equal rows is one key
        text.cast("binary").alias("text"),
    )
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-size // FILE_BYTES))
    dealt = rows.repartitionByRange(files, "ord", "tid", "nth").sortWithinPartitions("ord", "tid", "nth")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part = task.partitionId()
        use = word_encoder(tokenizer)
        store, root = _target(folder)
        store.create_dir(root)
        names = [f"{root}/part-{part:05d}.{kind}" for kind in ("records", "index")]
        drafts = [f"{root}/_{part:05d}-{task.taskAttemptId()}.{kind}" for kind in ("records", "index")]
        records = tokens = offset = 0
        out = None
        for batch in batches:
            data, offs = utf8(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            for i, _, part_data, at in portions(data, offs, BLOCK_BYTES):
                raw = part_data.tobytes()
                texts = [raw[a:b] for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]
                for j, found in enumerate(use.encode(texts), i):
                    if out is None:
                        out = [store.open_output_stream(d) for d in drafts]
                    record = framed(ids[j], np.append(found, np.uint32(end_id)), width)
                    out[0].write(record)
                    out[1].write(index_entry(offset, tokens))
                    offset, tokens, records = offset + len(record), tokens + len(found) + 1, records + 1
        if out is not None:
            for stream, draft, name in zip(out, drafts, names, strict=True):
                stream.close()
                store.move(draft, name)
            yield pa.record_batch([pa.array([part]), pa.array([records]), pa.array([tokens])], names=["part", "n_records", "n_tokens"])

    return stored(dealt.mapInArrow(emit, "part long, n_records long, n_tokens long"), "record_files")


def read_records(spark: SparkSession, folder: str, files: DataFrame, seed: int | None = None) -> DataFrame:
    """Read records back, a few hundred at a time in any task: ``doc_id, start, n_tokens, tokens``.

    ``tokens`` are little-endian 32-bit words; ``start`` counts the ids of all records before,
    over all files. ``seed`` shuffles the order in which groups of records are read.
    """
    before = "sum(n_tokens) over (order by part rows between unbounded preceding and 1 preceding)"
    placed = files.selectExpr("part", "n_records", f"coalesce({before}, 0) as before")  # a row for each file
    groups = placed.selectExpr("part", "n_records", "before", f"explode(sequence(0L, n_records - 1, {READ_TOGETHER}L)) as first")
    order = F.xxhash64("part", "first", F.lit(seed or 0))
    # dealt out by group, so that tasks take a like share of each file
    dealt = groups.withColumn("deal", order).repartition("deal").sortWithinPartitions("deal" if seed is not None else "part", "first")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _target(folder)
        for batch in batches:
            for part, n, base, first in zip(*(batch.column(c).to_pylist() for c in ("part", "n_records", "before", "first")), strict=True):
                count = min(READ_TOGETHER, n - first)
                with store.open_input_file(f"{root}/part-{part:05d}.index") as f:
                    f.seek(first * ENTRY_BYTES)
                    index = np.frombuffer(f.read((count + 1) * ENTRY_BYTES), "<u8").reshape(-1, 2)
                with store.open_input_file(f"{root}/part-{part:05d}.records") as f:
                    end = int(index[count, 0]) if len(index) > count else f.size()
                    f.seek(int(index[0, 0]))
                    data = memoryview(f.read(end - int(index[0, 0])))
                at, rows = 0, []
                for k in range(count):
                    doc_id, ids, at = unframed(data, at)
                    rows.append((doc_id, base + int(index[k, 1]), len(ids), ids.astype("<u4").tobytes()))
                cols = zip(*rows, strict=True)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "start", "n_tokens", "tokens"])

    return dealt.select("part", "n_records", "before", "first").mapInArrow(emit, "doc_id long, start long, n_tokens long, tokens binary")


def digest(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    spark = docs.sparkSession
    folder = scratch_dir(spark, "records")
    files = write_records(docs, folder, tokenizer, end_id)
    return read_records(spark, folder, files).select("doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))
